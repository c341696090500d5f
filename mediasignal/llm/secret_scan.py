"""Secret scans: fixed patterns, and strings that look random to a pair of character models.

Two first-order Markov models over the characters of ``ALPHABET``, one of
random strings and one of ordinary identifiers, are counted from labelled
samples. A token of at least ``LEAST_CHARS`` characters that no fixed pattern
covers is a secret if its log-likelihood ratio, random over ordinary, reaches
``LEAST_RATIO`` for each ``LEAST_CHARS`` characters. Everything runs as column
expressions in the row that holds the text; positions come from the lengths of
matches and of the gaps between them.

The ordinary sample is the tokens of all documents without what the fixed
patterns find; the random sample has ``SAMPLE_STRINGS`` strings of each of the
character sets in which keys are written.

Defined cases: a null text is empty and has no spans. Without ordinary tokens
the models are equal and add nothing. Rows that repeat, ids that are null and
extra columns change nothing; empty tables give empty tables.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mediasignal.llm.common import whole_text

# Fixed patterns, in the order in which spans of one start are listed.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
KINDS = ["assign", "access", "hex", "random"]
LEAST_VALUE, LEAST_ACCESS = 12, 18

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: A token of ``LEAST_CHARS`` characters needs this ratio, a longer one more in proportion.
LEAST_CHARS, LEAST_RATIO = 16, 11.2
TOKEN = rf"[A-Za-z0-9+/_=-]{{{LEAST_CHARS},}}"
#: Character sets in which keys are written; the random sample has ``SAMPLE_STRINGS`` strings of each.
KEY_SETS = {
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "base62": ALPHABET[:62],
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
    "lower": "abcdefghijklmnopqrstuvwxyz0123456789", "hex": "0123456789abcdef", "upper hex": "0123456789ABCDEF",
}
SAMPLE_STRINGS, _SAMPLE_CHARS = 1000, 40
_BLOCK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sums(values: Column) -> Column:
    """Sums of a short array's numbers up to and with each."""
    return F.aggregate(values, F.array().cast("array<int>"), lambda seen, x: F.array_append(
        seen, F.coalesce(F.try_element_at(seen, F.lit(-1)), F.lit(0)) + x))


def running_sums(values: Column) -> Column:
    """Sums of an array's numbers up to and with each. Sums of blocks first, so a long array costs little more than its length."""
    starts = lambda v: F.when(F.size(v) > 0, F.sequence(F.lit(1), F.size(v), F.lit(_BLOCK))).otherwise(
        F.array().cast("array<int>"))
    totals = lambda blocks: F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda s, x: s + x))
    return let(values, lambda v: let(
        F.transform(starts(v), lambda i: F.slice(v, i, F.lit(_BLOCK))), lambda blocks: let(
            F.concat(F.array(F.lit(0)), _sums(totals(blocks))), lambda before: F.flatten(F.transform(
                blocks, lambda b, k: let(F.get(before, k), lambda first: F.transform(
                    _sums(b), lambda x: x + first)))))))


def pattern_spans(text: Column, pattern: str, kind: int, keep: Callable[[Column], Column] | None = None) -> Column:
    """Array of (start, kind, stop) of a pattern's leftmost matches, in code points; ``keep`` makes flags from the matches."""
    none = F.array().cast("array<struct<start:int,kind:int,stop:int>>")

    def spans(found: Column) -> Column:
        gaps = F.transform(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), F.length)
        sizes = F.transform(found, F.length)
        stops = running_sums(F.zip_with(gaps, sizes, lambda g, m: g + m))
        all_ = F.zip_with(stops, found, lambda stop, m: F.struct(
            (stop - F.length(m)).alias("start"), F.lit(kind).alias("kind"), stop.alias("stop")))
        if keep is None:
            return all_
        return F.filter(F.zip_with(all_, keep(found), lambda s, k: F.when(k, s)), lambda s: s.isNotNull())

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
               lambda found: F.when(F.size(found) > 0, spans(found)).otherwise(none))


def base_spans(text: Column) -> Column:
    """Spans of the fixed patterns by start, then kind."""
    value_long = lambda _: F.transform(
        F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), lambda v: F.length(v) >= LEAST_VALUE)
    long_enough = lambda found: F.transform(found, lambda m: F.length(m) >= LEAST_ACCESS)
    return F.array_sort(F.concat(
        pattern_spans(text, ASSIGN, 0, value_long), pattern_spans(text, ACCESS, 1, long_enough),
        pattern_spans(text, HEX, 2)))


def random_strings(spark: SparkSession, strings: int = SAMPLE_STRINGS, chars: int = _SAMPLE_CHARS) -> DataFrame:
    """(name, token): strings of each of ``KEY_SETS``, whose characters are picked by a hash of set, string and place."""
    sets = F.explode(F.create_map(*(F.lit(x) for item in KEY_SETS.items() for x in item))).alias("name", "chars")
    place = F.expr(f"transform(sequence(1, {int(chars)}), i -> substring(chars, cast(pmod(xxhash64(name, id, i), length(chars)) as int) + 1, 1))")
    return spark.range(strings).select("id", sets).select("name", F.array_join(place, "").alias("token"))


def labelled_samples(docs: DataFrame, strings: int = SAMPLE_STRINGS) -> DataFrame:
    """(token, random, n): random strings, and the ordinary tokens of all documents with their number.

    Ordinary is what the fixed patterns leave. Equal tokens are counted before
    they are shuffled.
    """
    random = random_strings(docs.sparkSession, strings).select("token", F.lit(True).alias("random"), F.lit(1).cast("long").alias("n"))
    text = whole_text(F.col("text"))
    for pattern in (ASSIGN, ACCESS, HEX):
        text = F.regexp_replace(text, pattern, " ")
    tokens = docs.select(F.explode(F.regexp_extract_all(text, F.lit("[A-Za-z0-9+/_=-]{4,}"), F.lit(0))).alias("token"))
    return random.unionByName(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).withColumn("random", F.lit(False)))


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratios, random over ordinary, of each character after each, in the order of ``ALPHABET``.

    What follows a rare character is taken to follow it as often as any other. The
    table has as many numbers as there are pairs of characters, whatever the sample.
    """
    chars = F.split("token", "")
    pairs = samples.select("random", "n", F.explode(F.zip_with(
        F.slice(chars, F.lit(1), F.greatest(F.size(chars) - 1, F.lit(0))),
        F.slice(chars, F.lit(2), F.greatest(F.size(chars) - 1, F.lit(0))),
        lambda a, b: F.concat(a, b))).alias("pair")).groupBy("random", "pair").agg(F.sum("n")).collect()
    n, place = len(ALPHABET), {c: i for i, c in enumerate(ALPHABET)}
    counts = {True: [[0] * n for _ in range(n)], False: [[0] * n for _ in range(n)]}
    for random, pair, count in pairs:
        if len(pair) == 2 and pair[0] in place and pair[1] in place:
            counts[random][place[pair[0]]][place[pair[1]]] += count
    if not any(map(sum, counts[False])):
        return [0.0] * (n * n)
    log = {k: _log_shares(rows) for k, rows in counts.items()}
    return [log[True][a][b] - log[False][a][b] for a in range(n) for b in range(n)]


def _log_shares(counts: list[list[int]]) -> list[list[float]]:
    """Logs of each row's shares, to which the shares of the columns were added with the weight of one count a column."""
    n, total = len(counts), sum(map(sum, counts))
    column = [(sum(row[b] for row in counts) + 1) / (total + n) for b in range(n)]
    return [[math.log((x + n * column[b]) / (sum(row) + n)) for b, x in enumerate(row)] for row in counts]


def likelihood_ratio(token: Column, ratios: list[float]) -> Column:
    """Sum of a token's log-likelihood ratios, in one pass over its characters."""
    n = len(ALPHABET)
    table = F.from_json(F.lit("[" + ",".join(f"{x:.6f}" for x in ratios) + "]"), "array<double>")
    start = F.struct(F.lit(-1).alias("at"), F.lit(0.0).alias("sum"))

    def step(seen: Column, char: Column) -> Column:
        at = F.instr(F.lit(ALPHABET), char) - 1
        return F.struct(at.alias("at"), (seen["sum"] + F.when(
            (seen["at"] < 0) | (at < 0), F.lit(0.0)).otherwise(F.get(table, seen["at"] * n + at))).alias("sum"))

    return F.aggregate(F.split(token, ""), start, step, lambda s: s["sum"])


def looks_random(token: Column, ratios: list[float]) -> Column:
    return likelihood_ratio(token, ratios) * LEAST_CHARS >= F.length(token) * LEAST_RATIO


def random_spans(text: Column, base: Column, ratios: list[float]) -> Column:
    """Spans of tokens that look random and meet no base span."""
    judged = lambda found: F.transform(found, lambda m: (
        ~m.rlike(f"AKIA[A-Z0-9]{{14,}}|{HEX}") & looks_random(m, ratios)))
    spans = pattern_spans(text, TOKEN, 3, judged)
    return F.filter(spans, lambda s: ~F.exists(base, lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])))


def _written(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def find_secrets(docs: DataFrame, ratios: list[float]) -> DataFrame:
    """One row per document: doc_id, base and all (arrays of start, kind, stop)."""
    rows = docs.select("doc_id", whole_text(F.col("text")).alias("text"))
    rows = rows.withColumn("base", base_spans(F.col("text")))
    return rows.select("doc_id", "base", F.array_sort(F.concat(
        "base", random_spans(F.col("text"), F.col("base"), ratios))).alias("all"))


def secret_report(docs: DataFrame, ratios: list[float]) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random."""
    found = find_secrets(docs, ratios)
    count = lambda kind: F.size(F.filter("all", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _written(F.col("all")).alias("spans"), count(3).alias("n_random"))
