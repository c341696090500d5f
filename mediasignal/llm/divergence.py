"""Source divergence audit: how far the word use of each source lies from its siblings and from its language.

The terms of a language are the runs of letters that occur in ``LEAST_DOCS`` of
its documents or more. Each (language, source) group gives a term the smoothed
share ``p = 1 + floor(SCALE * (n + 1) / (N + V))``: ``n`` its occurrences there, ``N``
those of all ``V`` kept terms. Two shares are compared by
``f(p, q) = floor((p - q)^2 / q)``.

Texts are counted where they are read: a task holds counters of ``HELD_TERMS``
entries and hands them on when they are full, so the shuffle gets counts, not
words. Kept terms are numbered in descending order of their occurrences, and a
bitmap is stored per (group, count): the terms that occur just so often there,
64 terms a word. For a pair of groups, AND plus popcount gives the number of
terms of each joint cell (count here, count there); a cell's ``f`` is computed once
and multiplied by that number. Cells with a zero follow by complement from the
sizes of the counts and from ``V``, so terms that one side lacks are never listed.

The divergence between sources sums ``f`` over all kept terms, for each ordered
pair. The characteristic terms of a group are those it uses more than its
language does, the ``TOP_TERMS`` of the largest ``f``.

Defined cases: null texts, languages and sources count as ''. A repeated row is
another document. Groups without terms give every term the share of no
occurrence; a language without kept terms has divergences of 0 and no terms.
Ties are ranked by the UTF-8 bytes of the item. Empty tables give empty tables;
other columns, null ids too, are not read. All arithmetic is exact.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediasignal.llm.common import whole_text, word_blocks
from mediasignal.session import staged

LEAST_DOCS, SCALE, TOP_TERMS = 3, 1_000_000_000, 200
HELD_TERMS = 200_000
WORD_BITS = 64

#: ASCII letters in lower case, all other ASCII as blanks; bytes of longer characters stay.
_LETTERS = bytes((b | 0x20) if chr(b).isalpha() and b < 128 else b if b > 127 else 0x20 for b in range(256))
_COUNTS = "lang string, source string, term string, n long, docs long"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def rows() -> pa.RecordBatch:
        columns: list[list] = [[], [], [], [], []]
        for (lang, source), (words, docs) in held.items():
            columns[0] += [lang] * (len(words) + 1)
            columns[1] += [source] * (len(words) + 1)
            # The empty term stands for the group itself.
            columns[2] += [b"", *words]
            columns[3] += [0, *words.values()]
            columns[4] += [0, *(docs[w] for w in words)]
        held.clear()
        kinds = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        arrays[2] = arrays[2].cast(pa.string())
        return pa.RecordBatch.from_arrays(arrays, ["lang", "source", "term", "n", "docs"])

    entries = 0
    for batch in batches:
        for lang, source, text in zip(*(batch.column(i) for i in range(3))):
            words, docs = held.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
            before, seen = len(words), set()
            for block in word_blocks(text.as_py().translate(_LETTERS)):
                words.update(block)
                seen.update(block)
            docs.update(seen)
            entries += len(words) - before + 1
            if entries > HELD_TERMS:
                yield rows()
                entries = 0
    if held:
        yield rows()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents with the term; a row with term '' for each group."""
    read = docs.select(whole_text(F.col("lang")).alias("lang"), whole_text(F.col("source")).alias("source"),
                       whole_text(F.col("text")).cast("binary").alias("text"))
    return read.mapInArrow(_counted, _COUNTS).groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: str, total: str, terms: str) -> Column:
    """p of ``n`` occurrences, in decimals because the product may pass 64 bits."""
    return F.expr(f"1 + (cast({SCALE} as decimal(19,0)) * cast({n} + 1 as decimal(19,0))) div cast({total} + {terms} as decimal(19,0))")


def _apart(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) div {q})"


class Audit:
    """Stored counts and bitmaps of ``docs``."""

    def __init__(self, docs: DataFrame, least_docs: int = LEAST_DOCS):
        counts = staged(term_counts(docs), "term_counts")
        kept = counts.where("term <> ''").groupBy("lang", "term").agg(
            F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least_docs).drop("docs")
        order = ["lang", F.desc("lang_n"), "term"]
        #: (lang, term, lang_n, id): neighbouring ids have about equal counts, so their words have few levels.
        self.kept = staged(kept.repartitionByRange(*order).sortWithinPartitions(*order)
                           .withColumn("id", F.monotonically_increasing_id()), "kept_terms")
        #: (lang, source, term, n, lang_n, id) of the kept terms that occur in the group.
        self.used = staged(counts.where("term <> ''").join(self.kept, ["lang", "term"])
                           .select("lang", "source", "term", "n", "lang_n", "id"), "used_terms")
        langs = self.kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
        totals = self.used.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("own_terms"))
        #: (lang, source, total, own_terms, terms, lang_total) of every group that occurs.
        self.groups = staged(counts.where("term = ''").select("lang", "source").join(totals, ["lang", "source"], "left")
                             .join(langs, "lang", "left").na.fill(0), "groups")
        #: (lang, source, n, word, bits): the terms with just n occurrences in the group.
        self.bitmaps = staged(self.used.groupBy(
            "lang", "source", "n", F.expr(f"id div {WORD_BITS}").alias("word")).agg(
            F.expr(f"bit_or(shiftleft(1L, cast(id % {WORD_BITS} as int)))").alias("bits")), "bitmaps")

    def cells(self) -> DataFrame:
        """(lang, source, n, item, m, terms): how many terms occur n times in one group and m times in another, both above 0."""
        one, other = self.bitmaps.alias("a"), self.bitmaps.alias("b")
        both = one.join(other, F.expr("a.lang = b.lang and a.word = b.word and a.source < b.source and (a.bits & b.bits) <> 0"))
        half = staged(both.groupBy(F.col("a.lang"), F.col("a.source"), F.col("a.n"), F.col("b.source").alias("item"),
                                   F.col("b.n").alias("m")).agg(F.expr("sum(bit_count(a.bits & b.bits))").alias("terms")), "cells")
        return half.unionByName(half.select("lang", F.col("item").alias("source"), F.col("m").alias("n"),
                                            F.col("source").alias("item"), F.col("n").alias("m"), "terms"))

    def pairs(self) -> DataFrame:
        """(lang, source, item, value): divergence of each group from each other source of its language."""
        one = self.groups.select("lang", "source", "terms", "own_terms", "total", _share("0", "total", "greatest(terms, 1)").alias("p0"))
        other = self.groups.select("lang", F.col("source").alias("item"), F.col("total").alias("item_total"),
                                   F.col("own_terms").alias("item_terms"), _share("0", "total", "greatest(terms, 1)").alias("q0"))
        pair = one.join(other, "lang").where("source <> item")
        levels = staged(self.bitmaps.groupBy("lang", "source", "n").agg(F.expr("sum(bit_count(bits))").alias("size")), "levels")
        p, q = _share("n", "total", "terms").alias("p"), _share("m", "item_total", "terms").alias("q")
        value = lambda count, f: F.expr(f"cast({count} as decimal(19,0)) * ({f})").alias("value")
        keys = ["lang", "source", "item"]
        # By inclusion and exclusion: all terms, the levels of either side, and their joint cells.
        parts = [
            pair.select(*keys, value("terms - own_terms - item_terms", _apart("p0", "q0"))),
            pair.join(levels, ["lang", "source"]).select("*", p).select(*keys, value("size", _apart("p", "q0"))),
            pair.join(levels.selectExpr("lang", "source as item", "n as m", "size"), ["lang", "item"]).select("*", q)
            .select(*keys, value("size", _apart("p0", "q"))),
            pair.drop("terms").join(self.cells().withColumnRenamed("terms", "both"), keys).join(
                self.groups.select("lang", "source", "terms"), ["lang", "source"]).select("*", p, q).select(*keys, value(
                    "both", f"{_apart('p', 'q')} - {_apart('p', 'q0')} - {_apart('p0', 'q')} + {_apart('p0', 'q0')}")),
        ]
        every = parts[0]
        for part in parts[1:]:
            every = every.unionByName(part)
        return every.groupBy(*keys).agg(F.sum("value").cast("long").alias("value"))

    def terms(self, top: int = TOP_TERMS) -> DataFrame:
        """(lang, source, item, value, rank): the terms that mark a group most within its language."""
        found = self.used.join(self.groups, ["lang", "source"]).select(
            "lang", "source", F.col("term").alias("item"), _share("n", "total", "terms").alias("p"),
            _share("lang_n", "lang_total", "terms").alias("q")).where("p > q")
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return (found.select("lang", "source", "item", F.expr(_apart("p", "q")).alias("value"))
                .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top))


def divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank: part ``pair`` has the other sources, part ``term`` the marking terms."""
    audit = Audit(docs, least_docs)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = audit.pairs().withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))
    return pairs.unionByName(audit.terms(top).withColumn("part", F.lit("term"))).select(
        "lang", "source", "part", "item", "value", "rank")
