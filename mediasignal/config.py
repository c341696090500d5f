"""Settings of the three stages, as one frozen object.

Word tables (language profile, lexicon, polarity, gazetteer) may be given in
two forms: a plain Python mapping, which is small by nature and is written into
the expressions, or a DataFrame of any size, which is joined (see
``operators.lookup``).
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

# --- fixed values: search phrases -------------------------------------------
DEFAULT_KEYWORDS = (
    "Currency Devaluation",
    "Exchange Rate",
    "Foreign Reserves",
    "Trade Balance",
    "Central Bank Intervention",
    "Speculative Attack",
    "Capital Flight",
    "External Debt",
    "Market Volatility",
    "Currency Depreciation",
)

# --- fixed values: address of the public news search service ----------------
SEARCH_URL = "https://api.gdeltproject.org/api/v2/doc/doc"

# --- fixed values: names of the stage datasets -------------------------------
RAW_DATASET = "currency_devaluation_main"
ENRICHED_DATASET = "translation_summary"
ROLLUP_DATASET = "score_groupby"

# --- fixed values: FIPS 10-4 country codes by region ------------------------
REGION_CODES = {
    "americas": [
        "AC", "AR", "AA", "BF", "BB", "BH", "BD", "BL", "BR", "CA", "CJ", "CI", "CO", "CS", "CU", "DO",
        "DR", "EC", "ES", "GJ", "GT", "GY", "HA", "HO", "JM", "MX", "NU", "PM", "PA", "PE", "RQ", "NS",
        "TD", "US", "UY", "VE",
    ],
    "europe": [
        "UK", "AL", "AN", "AU", "BO", "BE", "BK", "BU", "HR", "CY", "EZ", "DA", "EN", "EU", "FO", "FI",
        "FR", "GM", "GR", "HU", "IC", "EI", "IM", "IT", "KV", "LG", "LS", "LH", "LT", "LU", "MT", "MD",
        "MN", "MJ", "MW", "NL", "MK", "NO", "PL", "PO", "RO", "RS", "LO", "SI", "SP", "SW", "SZ", "TU",
        "UP",
    ],
    "africa": [
        "AG", "AO", "BN", "BC", "UV", "BY", "CM", "CV", "CT", "CD", "CN", "CF", "DJ", "EG", "EK", "ER",
        "ET", "GB", "GA", "GH", "GV", "PU", "IV", "KE", "LT", "LI", "LY", "MA", "MI", "ML", "MR", "MP",
        "MO", "MZ", "WA", "NG", "NI", "CG", "RW", "TP", "SG", "SE", "SL", "SO", "SF", "OD", "SU", "WZ",
        "TZ", "TG", "TS", "UG", "ZA", "ZI",
    ],
    "asia": [
        "AF", "AM", "AJ", "BA", "BG", "BT", "BX", "CB", "CH", "TT", "GG", "HK", "IN", "ID", "IR", "IZ",
        "IS", "JA", "JO", "KZ", "KU", "KG", "LA", "LE", "MC", "MY", "MV", "MG", "BM", "NP", "KN", "MU",
        "WE", "PK", "RP", "QA", "SA", "SN", "KS", "CE", "SY", "TW", "TI", "TH", "TX", "AE", "UZ", "VM",
        "YM",
    ],
    "oceania": [
        "AS", "FJ", "KR", "NC", "NZ", "PP", "WS", "BP", "TN", "NH",
    ],
}

# --- fixed values: English names of language codes --------------------------
LANGUAGE_NAMES = {
    "af": "Afrikaans", "ar": "Arabic", "bg": "Bulgarian", "bn": "Bangla", "ca": "Catalan",
    "cs": "Czech", "cy": "Welsh", "da": "Danish", "de": "German", "el": "Greek",
    "en": "English", "es": "Spanish", "et": "Estonian", "fa": "Persian", "fi": "Finnish",
    "fr": "French", "gu": "Gujarati", "he": "Hebrew", "hi": "Hindi", "hr": "Croatian",
    "hu": "Hungarian", "id": "Indonesian", "it": "Italian", "ja": "Japanese", "kn": "Kannada",
    "ko": "Korean", "lt": "Lithuanian", "lv": "Latvian", "mk": "Macedonian",
    "ml": "Malayalam", "mr": "Marathi", "ne": "Nepali", "nl": "Dutch", "no": "Norwegian",
    "pa": "Punjabi", "pl": "Polish", "pt": "Portuguese", "ro": "Romanian", "ru": "Russian",
    "sk": "Slovak", "sl": "Slovenian", "so": "Somali", "sq": "Albanian", "sv": "Swedish",
    "sw": "Swahili", "ta": "Tamil", "te": "Telugu", "th": "Thai", "tl": "Filipino",
    "tr": "Turkish", "uk": "Ukrainian", "ur": "Urdu", "vi": "Vietnamese",
    "zh-cn": "Chinese (China)", "zh-tw": "Chinese (Taiwan)",
}

# Frequent function words per language: {language: {word: weight}}.
LANGUAGE_PROFILE = {
    "de": dict.fromkeys("der die und den von das nicht mit ist ein für auf".split(), 1),
    "en": dict.fromkeys("the of and to is that in for with was are this".split(), 1),
    "es": dict.fromkeys("la que el y los se del las por con una para".split(), 1),
    "fr": dict.fromkeys("la le et les des un du une est que pour dans".split(), 1),
}

# A starter dictionary; real runs plug in their own table or a model.
LEXICON = {
    "banco": "bank", "banque": "bank", "crisis": "crisis", "crise": "crisis", "Krise": "crisis",
    "deuda": "debt", "dette": "debt", "Schulden": "debt", "moneda": "currency",
    "monnaie": "currency", "Währung": "currency", "inflación": "inflation", "mercado": "market",
    "marché": "market", "Markt": "market", "dévaluation": "devaluation",
    "devaluación": "devaluation", "Abwertung": "devaluation", "croissance": "growth",
    "crecimiento": "growth", "Wachstum": "growth", "hausse": "rise", "baisse": "fall",
    "und": "and", "der": "the", "las": "the", "los": "the", "les": "the", "el": "the",
}

# Polarity of lower-case words: {word: kind}.
POLARITY = {
    **dict.fromkeys(
        "gain gains growth improve improved rally rebound recovery rise rises rising robust "
        "strengthen strengthened strong surge surplus upgrade".split(), "bullish"),
    **dict.fromkeys(
        "collapse crisis debt decline default deficit depreciation devaluation devalued "
        "downgrade fall falls falling flight loss losses plunge recession shortage slump "
        "weak weaken weakened".split(), "bearish"),
    **dict.fromkeys("flat neutral stable steady unchanged".split(), "neutral"),
}

# Known names: {phrase: kind}.
GAZETTEER = {
    "Central Bank": "ORG", "European Central Bank": "ORG", "Federal Reserve": "ORG",
    "International Monetary Fund": "ORG", "IMF": "ORG", "World Bank": "ORG",
    "Argentina": "GPE", "Brazil": "GPE", "Egypt": "GPE", "Ghana": "GPE", "Kenya": "GPE",
    "Lebanon": "GPE", "Nigeria": "GPE", "Pakistan": "GPE", "Turkey": "GPE", "Zambia": "GPE",
}


@dataclass(frozen=True)
class PipelineConfig:
    # collect
    search_url: str = SEARCH_URL
    keywords: tuple[str, ...] = DEFAULT_KEYWORDS
    regions: Mapping[str, Any] = field(default_factory=lambda: REGION_CODES)
    max_records: int = 250
    window_hours: int = 6
    raw_dataset: str = RAW_DATASET

    # enrich
    # a cut of page texts and of the words that sentiment counts; None takes whole texts
    max_article_chars: int | None = None
    chunk_chars: int = 4_500
    basis_chars: int = 50
    short_text_word_threshold: int = 50
    sentiment_max_tokens: int | None = None
    entity_kinds: tuple[str, ...] = ("GPE", "ORG", "MONEY")
    # of names that lie in one another, take the longest only
    entity_longest: bool = False
    base_columns: tuple[str, ...] = ("URL", "Date", "Title", "Country", "Domain", "Keywords")
    enriched_dataset: str = ENRICHED_DATASET
    target_language: str = "en"

    # score
    conf_threshold: float = 0.70
    rollup_dataset: str = ROLLUP_DATASET

    # word tables: a mapping, or a DataFrame of any size
    language_profile: Any = field(default_factory=lambda: LANGUAGE_PROFILE)
    language_names: Any = field(default_factory=lambda: LANGUAGE_NAMES)
    lexicon: Any = field(default_factory=lambda: LEXICON)
    polarity: Any = field(default_factory=lambda: POLARITY)
    gazetteer: Any = field(default_factory=lambda: GAZETTEER)

    # an operators.ngrams.LanguageModel; without one the language profile decides
    language_model: Any = None

    # model hooks: callables on lists of texts, see operators.translate / sentiment / entities
    translate_batch: Any = None
    sentiment_model: Any = None
    entity_batch: Any = None

    # word tables up to this many entries are written into the expressions
    inline_entries: int = 2_000
    # a joined lookup table is broadcast only when a count shows it within both bounds
    broadcast_rows: int = 200_000
    broadcast_bytes: int = 32 * 1024 * 1024
    lookup_salts: int = 32
    # blocks of 4 KB of the filter that drops pages without an article; 0 turns it off
    page_filter_blocks: int = 4096

    @property
    def country_codes(self) -> list[str]:
        """Distinct codes of all regions in code order."""
        return sorted({code for codes in self.regions.values() for code in codes})
