"""From documents to packed sequences: five stages, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mediasignal.llm.exact_dedup import drop_copies
from mediasignal.llm.mixing import Mix, take_mixed
from mediasignal.llm.packing import packed
from mediasignal.llm.quality import fit, keep_good
from mediasignal.llm.queries import table, vocabulary
from mediasignal.llm.simhash import drop_near_copies
from mediasignal.session import staged

#: Nearly all tokens at nearly natural weights, and no document twice: what cleaning kept is not thrown away here.
MIX = Mix(domains={"web": 6, "reference": 4}, langs={"en": 12, "fr": 3, "de": 3, "es": 2}, share=950, epochs=1)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from ``labels``, doesn't reject."""
    return keep_good(docs, fit(docs, table(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts whose SimHash fingerprints link (3-word shingles, 2 bits at most)."""
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the target weights take."""
    return take_mixed(docs, MIX)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences."""
    return packed(docs, vocabulary("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", near_dedup),
    ("source_mixing", mixing),
    ("packing", packing),
]

#: SQL expresses neither the learned scores nor the tokenizer; ``tests/llm`` holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
