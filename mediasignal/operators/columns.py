"""Column-level steps shared by the stages."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediasignal.functions.text import first_truthy


def select_available(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The listed columns that exist, in list order."""
    return df.select(*[c for c in columns if c in df.columns])


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required column(s): {missing}")
    return df


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def first_spelling(df: DataFrame, *spellings: str) -> Column:
    """First non-empty value among the spellings present in the header, else ``""``."""
    present = [F.col(f"`{c}`").cast("string") for c in spellings if c in df.columns]
    return first_truthy(*present, F.lit(""))


def merge_spellings(df: DataFrame, **spellings: tuple[str, ...]) -> DataFrame:
    """One column per keyword, filled from its first non-empty spelling.

    Spark ignores the case of names, so the header is made unique first.
    """
    plain = df.toDF(*[f"{i}:{c}" for i, c in enumerate(df.columns)])
    where: dict[str, str] = {}
    for unique, name in zip(plain.columns, df.columns):
        where.setdefault(name, unique)
    wanted = {s for names in spellings.values() for s in names}
    kept = [F.col(f"`{u}`").alias(n) for n, u in where.items() if n not in wanted]
    merged = [
        first_truthy(*[F.col(f"`{where[s]}`").cast("string") for s in names if s in where], F.lit(""))
        .alias(out)
        for out, names in spellings.items()
    ]
    return plain.select(*merged, *kept)
