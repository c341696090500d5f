"""Exact deduplication with a split for heavy digests.

Texts are equal when their SHA-256 digests are, taken after each run of white
space became one space. Misra-Gries counters (``freqItems``) name every digest
that may hold more than ``support`` of all rows; a count verifies them. Winners
of the heavy digests, at most ``1 / support`` rows, are broadcast, so the rows
of a huge group are decided where they are read. The other digests are grouped
by an ordinary shuffle of digest and id, combined before it.

Defined cases: a null text is an empty text. Null ids lose against any other
id; a group with none but null ids has a null ``keep_id`` and keeps its rows.
Rows that repeat id and text are one document: ``exact_groups`` marks each of
them kept, ``drop_copies`` returns one of them. Empty tables give empty tables;
extra columns pass through ``drop_copies`` and are ignored by ``exact_groups``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediasignal.llm.common import SPACES, fresh, whole_text
from mediasignal.session import staged

#: Share of all rows from which a digest is heavy; its inverse bounds the broadcast winners.
SUPPORT = 0.0005


def text_digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of the text with each run of white space as one space."""
    return F.sha2(F.regexp_replace(whole_text(text), SPACES, " ").cast("binary"), 256)


def heavy_digests(digests: DataFrame, support: float = SUPPORT) -> DataFrame:
    """(digest, keep_id, group_size) of the digests with at least ``support`` of all rows; at most 1/support rows."""
    found = digests.stat.freqItems(["digest"], support).select(F.explode("digest_freqItems").alias("digest"))
    # The counters hold 1/support entries at most, so this list is bounded whatever the input.
    names = [r.digest for r in found.distinct().collect()]
    candidates = digests.sparkSession.createDataFrame([(n,) for n in names], "digest string")
    rows = digests.count()
    counted = digests.join(F.broadcast(candidates), "digest").groupBy("digest").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"),
        F.count(F.lit(1)).alias("repeats"))
    return counted.where(F.col("group_size") >= F.lit(support * rows)).select("digest", "keep_id", "group_size")


def _split(docs: DataFrame, support: float) -> tuple[DataFrame, DataFrame]:
    """The stored (doc_id, digest) rows, and the winners of heavy digests."""
    digests = staged(docs.select("doc_id", text_digest(F.col("text")).alias("digest")), "digests")
    return digests, staged(heavy_digests(digests, support), "heavy")


def exact_groups(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    digests, heavy = _split(docs, support)
    heavy = F.broadcast(heavy)
    light = digests.join(heavy, "digest", "left_anti")
    groups = light.groupBy("digest").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    decided = digests.join(heavy, "digest").unionByName(light.join(groups, "digest"))
    return decided.select("doc_id", "keep_id", "group_size",
                          F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                          F.col("digest").alias("text_sha256"))


def drop_copies(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """The columns and rows of ``docs`` without copies: of equal texts the row with the smallest doc_id stays."""
    digests, heavy = _split(docs, support)
    heavy = F.broadcast(heavy)
    by_id = digests.join(heavy, "digest", "left_anti").groupBy("digest", "doc_id").agg(
        F.count(F.lit(1)).alias("n"))
    groups = staged(by_id.groupBy("digest").agg(
        F.min("doc_id").alias("keep_id"), F.sum("n").alias("size"),
        F.coalesce(F.min_by("n", "doc_id"), F.sum("n")).alias("repeats")).where("size > 1"), "groups")

    digest, other, keep = fresh(docs, "digest_of_text", "digest_of_group", "id_to_keep")
    texts = docs.withColumn(digest, text_digest(F.col("text")))
    winners = heavy.select(F.col("digest").alias(other), F.col("keep_id").alias(keep))
    first = (texts.join(winners, (F.col(digest) == F.col(other)) & F.col("doc_id").eqNullSafe(F.col(keep)))
             .drop(other, keep).dropDuplicates([digest]))

    several = groups.select(F.col("digest").alias(other), F.col("keep_id").alias(keep), F.lit(True).alias("several_rows"))
    # This list grows with the data, so the join shuffles at any size.
    (several_rows,) = fresh(docs, "several_rows")
    several = several.withColumnRenamed("several_rows", several_rows)
    rest = (texts.join(winners, F.col(digest) == F.col(other), "left_anti")
            .join(several.hint("merge"), F.col(digest) == F.col(other), "left")
            .where(F.col(several_rows).isNull() | F.col("doc_id").eqNullSafe(F.col(keep)))
            .drop(other, keep, several_rows))
    # Only where the stored groups hold a repeated row must rows of one id and text be merged.
    if not groups.where("repeats > 1").isEmpty():
        rest = rest.dropDuplicates([digest, "doc_id"])
    return first.unionByName(rest).select(*docs.columns)
