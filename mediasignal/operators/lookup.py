"""Lookups in word tables, chosen by the measured size of the table.

* up to ``inline_entries`` rows: the entries become literals of the expression,
  the articles stay where they are and nothing is shuffled;
* within ``broadcast_rows`` and ``broadcast_bytes``: broadcast join;
* beyond: shuffle join, with the frequent words spread over ``lookup_salts``
  partitions each.

All three give the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediasignal.config import PipelineConfig

# Word tables of the configuration and their columns.
TABLES = {
    "language_profile": ("lang", "token", "weight"),
    "language_names": ("code", "name"),
    "lexicon": ("src", "dst"),
    "polarity": ("token", "kind"),
    "gazetteer": ("phrase", "kind"),
}


def resolve_tables(config: PipelineConfig, spark) -> PipelineConfig:
    """Decide the form of every word table once, so later steps do not measure again."""
    return replace(config, **{name: CleanTable(entries(getattr(config, name), columns, config, spark))
                              for name, columns in TABLES.items()})


def has_joined_tables(config: PipelineConfig) -> bool:
    tables = (getattr(config, name) for name in TABLES)
    return any(isinstance(t.rows if isinstance(t, CleanTable) else t, DataFrame) for t in tables)


# How rows of one key become one entry: the columns of the key, and the aggregate of the last column.
_ONE_ENTRY = {
    ("lang", "token", "weight"): F.sum,
    ("code", "name"): F.min,
    ("src", "dst"): F.min,
    ("token", "kind"): F.min,
    ("phrase", "kind"): None,
}


def clean_entries(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per entry, whatever form the table takes later.

    Rows with a null are left out. Repeated keys are added up in a language
    profile and keep the least value elsewhere; a phrase may have several kinds.
    """
    known = frame.select(*columns).dropna()
    combine = _ONE_ENTRY[tuple(columns)]
    if combine is None:
        return known.distinct()
    *keys, value = columns
    return known.groupBy(*keys).agg(combine(value).alias(value))


def entries(table, columns: Sequence[str], config: PipelineConfig, spark) -> list[tuple] | DataFrame:
    """``table`` as a list of tuples if it is small, as a DataFrame otherwise; see ``clean_entries``."""
    if isinstance(table, CleanTable):
        return table.rows
    if isinstance(table, DataFrame):
        frame = clean_entries(table, columns)
        if config.inline_entries <= 0:
            return frame
        head = frame.limit(config.inline_entries + 1).collect()
        return sorted(tuple(r) for r in head) if len(head) <= config.inline_entries else frame
    rows = [r for r in flatten(table) if None not in r]
    combine = {F.sum: sum, F.min: min, None: None}[_ONE_ENTRY[tuple(columns)]]
    if combine is None:
        rows = sorted(set(rows))
    else:
        groups: dict[tuple, list] = {}
        for *key, value in rows:
            groups.setdefault(tuple(key), []).append(value)
        rows = [(*key, combine(values)) for key, values in groups.items()]
    if len(rows) <= config.inline_entries:
        return rows
    types = ["bigint" if c == "weight" else "string" for c in columns]
    return spark.createDataFrame(rows, ", ".join(f"{c} {t}" for c, t in zip(columns, types)))


@dataclass(frozen=True)
class CleanTable:
    """Entries whose form is decided: a list to be written into expressions, or a DataFrame to be joined."""

    rows: list[tuple] | DataFrame


def flatten(table: Mapping) -> list[tuple]:
    """``{a: b}`` to ``[(a, b)]`` and ``{a: {b: c}}`` to ``[(a, b, c)]``."""
    return [
        (key, *rest)
        for key, value in table.items()
        for rest in (flatten(value) if isinstance(value, Mapping) else [(value,)])
    ]


def size_of(table: DataFrame) -> tuple[int, int]:
    """Rows and bytes of a narrow table; partial sums only, no row travels."""
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in table.columns),
                F.lit(16))
    rows, size = table.agg(F.count(F.lit(1)), F.coalesce(F.sum(width.cast("long")), F.lit(0))).first()
    return rows, size


def within_bounds(rows: int, size: int, config: PipelineConfig) -> bool:
    return rows <= config.broadcast_rows and size <= config.broadcast_bytes


def is_bounded(table: DataFrame, config: PipelineConfig) -> bool:
    """True if a count proves the table small enough to broadcast."""
    return within_bounds(*size_of(table), config)


#: Bytes of a table with its copies for the salts up to which Spark may still broadcast it.
SMALL_COPIES = 1024 * 1024


def lookup_join(facts: DataFrame, table: DataFrame, on: str, how: str, spread: Sequence[str],
                config: PipelineConfig, bounded: bool | None = None) -> DataFrame:
    """Join ``facts`` with a lookup ``table`` on column ``on``; ``bounded`` is what ``is_bounded`` said, if it was asked.

    ``spread`` names fact columns that differ between rows with the same word;
    their hash picks the salt, so a task that runs again picks the same one. Spark
    judges a table by the bytes of its files, which say little of like words in
    columns and nothing of the copies, so beyond ``SMALL_COPIES`` the join is a merge.
    """
    if is_bounded(table, config) if bounded is None else bounded:
        return facts.join(F.broadcast(table), on, how)
    salts = config.lookup_salts
    salted_facts = facts.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)))
    salted_table = table.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    if salts * size_of(table)[1] > SMALL_COPIES:
        salted_table = salted_table.hint("merge")
    return salted_facts.join(salted_table, [on, "_salt"], how).drop("_salt")
