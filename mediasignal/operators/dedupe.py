"""Keep-first by key, and bag union."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: str | Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row per key in the given order; rows without a key count as one group.

    Spark limits every group to one row before the shuffle as well, so a key
    with very many copies does not gather in one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def cap_per_group(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], n: int) -> DataFrame:
    """At most ``n`` rows per group, the first ones in the given order."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") <= n).drop("_rn")


def union_rows(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)
