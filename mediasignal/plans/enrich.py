"""Second stage: articles and landed pages to English text, sentiment and entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediasignal.config import PipelineConfig
from mediasignal.functions import text as tx
from mediasignal.functions import urls
from mediasignal.operators.columns import merge_spellings, rename, select_available
from mediasignal.operators.dedupe import keep_first
from mediasignal.operators.entities import add_entities
from mediasignal.operators.language import add_language, add_language_name, language_basis
from mediasignal.operators.lookup import has_joined_tables, resolve_tables, size_of, within_bounds
from mediasignal.operators.sentiment import LABEL, SCORE, add_no_content, add_sentiment
from mediasignal.operators.translate import add_translation
from mediasignal.schemas import ENRICHED_COLUMNS
from mediasignal.session import staged
from mediasignal.sources.pages import join_pages, pages_of

# Columns of an enriched row before it meets its base row.
RESULT_COLUMNS = ["URL", "Translated Title", "Translated Text", "Language", LABEL, SCORE,
                  "Keywords", "Domain"]
RENAMES = {"Keywords": "Enriched Keywords", "Domain": "Enriched Domain"}


def base_articles(df: DataFrame, config: PipelineConfig) -> DataFrame:
    """The base columns that exist, one row per URL."""
    base = select_available(df, config.base_columns)
    if "URL" not in base.columns:
        return base
    return keep_first(base, "URL", [c for c in ("Date", "Title", "Country", "Domain", "Keywords")
                                    if c in base.columns] or ["URL"])


def add_status(df: DataFrame) -> DataFrame:
    return df.withColumn("_status", F.when(F.col("page_ok"), "ok").otherwise("no_content"))


def readable_text(config: PipelineConfig) -> Column:
    """The page text; with ``max_article_chars`` cut to so many unless it has fewer
    words than the short-text threshold."""
    full = F.col("text_full")
    if config.max_article_chars is None:
        return full
    long = tx.has_words(full, config.short_text_word_threshold)
    return F.when(long, tx.cap(full, config.max_article_chars)).otherwise(full)


def add_texts(df: DataFrame, config: PipelineConfig) -> DataFrame:
    """Phase one: language, translated title and translated text.

    Needs ``URL, Title, page_ok, text_full``. English bodies are not sent to
    the translator; an empty outcome falls back to the title.
    """
    title = F.coalesce(F.col("Title").cast("string"), F.lit(""))
    out = add_status(df.withColumn("_title", title))
    out = out.withColumn("_basis", language_basis(F.col("text_full"), F.col("_title"), config))
    out = add_language(out, "URL", "_basis", "_code", config)
    out = add_language_name(out, "_code", "Language", config)
    out = out.withColumn("_body", readable_text(config))
    english = F.col("_code") == config.target_language
    out = out.withColumn("_foreign", F.when(~english, F.col("_body")))
    if has_joined_tables(config):
        out = staged(out.drop("text_full", "_basis"), "texts")
    texts = out
    out = add_translation(out, "URL", "_title", "_tt", config, chunked=False, source=texts)
    out = add_translation(out, "URL", "_foreign", "_translated", config, source=texts)
    shown_title = tx.first_truthy(F.col("_tt"), F.col("_title"))
    body = F.when(english, F.col("_body")).otherwise(F.col("_translated"))
    text = F.when(F.col("page_ok"), tx.first_truthy(body, shown_title)).otherwise(shown_title)
    return (out.withColumn("Translated Title", shown_title)
            .withColumn("Translated Text", text)
            .drop("_title", "_basis", "_code", "_body", "_foreign", "_tt", "_translated", "text_full"))


def add_signals(df: DataFrame, config: PipelineConfig) -> DataFrame:
    """Phase two: sentiment and entities of ``Translated Text``.

    Rows without page content get no score, but their title is searched for
    entities like any other text.
    """
    scored = df.withColumn("_scored", F.when(F.col("_status") == "ok", F.col("Translated Text")))
    scored = add_no_content(add_sentiment(scored, "URL", "_scored", config))
    return add_entities(scored, "URL", "Translated Text", "Enriched Keywords", config, source=df).drop("_scored")


def enrich_rows(articles: DataFrame, pages: DataFrame, config: PipelineConfig) -> DataFrame:
    """Results of the eligible articles (``RESULT_COLUMNS``), one row per article."""
    config = resolve_tables(config, articles.sparkSession)
    named = merge_spellings(articles, URL=("url", "URL"), Title=("title", "Title"))
    wanted = named.select("URL", "Title").where(urls.eligible(F.col("URL")))
    full = _signals(wanted, pages, config, wanted, config.page_filter_blocks)
    return full.select(
        "URL", "Translated Title", "Translated Text", "Language", f"`{LABEL}`", f"`{SCORE}`",
        F.col("Enriched Keywords").alias("Keywords"),
        urls.domain(F.col("URL"), strip_www=True).alias("Domain"))


def join_enriched(base: DataFrame, results: DataFrame) -> DataFrame:
    """Base rows with their results; a base row without one keeps nulls."""
    renamed = rename(results, RENAMES).select("URL", *[f"`{c}`" for c in ENRICHED_COLUMNS])
    order = [*base.columns, *ENRICHED_COLUMNS]
    return base.join(renamed, "URL", "left").select(*[f"`{c}`" for c in order])


def enrich(articles: DataFrame, pages: DataFrame, config: PipelineConfig, few: bool = False) -> DataFrame:
    """Base rows with their enrichment; the columns of a row that isn't eligible stay null.

    Same rows as ``join_enriched(base, enrich_rows(base, pages))``, in one pass:
    results never leave their base row, so the article and page tables meet in
    a single shuffle by URL, and a filter of the articles' URLs drops other pages
    while scanning. Nothing is counted while the plan is made, unless the caller
    says that a stored table holds ``few`` articles: if a count bears that out,
    that filter is exact.
    """
    base = base_articles(articles, config)
    if "URL" not in base.columns:
        return base
    wanted, blocks = articles.select("URL").where(urls.eligible(F.col("URL"))), config.page_filter_blocks
    if few and within_bounds(*size_of(wanted), config):
        pages, blocks = pages_of(pages, wanted), 0
    config = resolve_tables(config, articles.sparkSession)
    rows = base if "Title" in base.columns else base.withColumn("Title", F.lit(""))
    full = _signals(rows, pages, config, wanted, blocks)
    ok = urls.eligible(F.col("URL"))
    results = [F.when(ok, F.col(f"`{c}`")).alias(c) for c in ENRICHED_COLUMNS[:-1]]
    domain = F.when(ok, urls.domain(F.col("URL"), strip_www=True)).alias("Enriched Domain")
    return full.select(*[f"`{c}`" for c in base.columns], *results, domain)


def _signals(rows: DataFrame, pages: DataFrame, config: PipelineConfig, wanted: DataFrame, blocks: int) -> DataFrame:
    joined = join_pages(rows, pages, wanted, blocks)
    if has_joined_tables(config):
        joined = staged(joined, "pages")
    texts = add_texts(joined, config)
    if has_joined_tables(config):
        texts = staged(texts, "translated")
    return add_signals(texts, config)
