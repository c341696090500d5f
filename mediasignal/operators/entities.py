"""Places, organisations and money amounts named in a text."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediasignal.config import PipelineConfig
from mediasignal.functions.text import sorted_set
from mediasignal.operators.lookup import entries
from mediasignal.operators.phrases import phrase_runs
from mediasignal.session import staged

# A word may hold inner punctuation ("Coca-Cola", "J.P", "AT&T") but not end in it.
NAME_WORD = r"[\p{L}\p{N}#_]+(?:[&.'-][\p{L}\p{N}#_]+)*"
# --- fixed values: currency signs and codes ---
SIGNS = ("$", "€", "£", "¥")
CODES = ("USD", "EUR", "GBP", "JPY", "CHF", "CNY")
MONEY = (rf"(?:[{''.join(SIGNS)}]|\b(?:{'|'.join(CODES)}))\s?"
         r"[0-9]+(?:,[0-9]{3})*(?:\.[0-9]+)?"
         r"(?:\s?(?:thousand|million|billion|trillion|bn|mn|tn|k|m)\b)?")


def name_words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(text, F.lit(NAME_WORD), F.lit(0)),
                      F.array().cast("array<string>"))


def money_amounts(text: Column) -> Column:
    """Amounts in text order. Most texts name no currency, which is cheap to see."""
    named = reduce(lambda a, b: a | b, [text.contains(c) for c in (*SIGNS, *CODES)])
    return F.when(named, F.regexp_extract_all(text, F.lit(MONEY), F.lit(0))).otherwise(
        F.array().cast("array<string>"))


def add_entities(df: DataFrame, key: str, text: str, out: str, config: PipelineConfig,
                 source: DataFrame | None = None) -> DataFrame:
    """Add the sorted distinct names and amounts of the configured kinds, joined
    by ``", "``; ``""`` if there are none. With ``entity_longest`` a name that lies in a longer one doesn't count.

    With a joined phrase table the words are taken from ``source``: the same keys
    and texts as ``df``, but cheaper to compute (by default ``df`` itself).
    """
    kinds = list(config.entity_kinds)
    if config.entity_batch is not None:
        found = entity_udf(config.entity_batch, kinds)(F.col(text))
        return df.withColumn(out, sorted_set(found))
    money = money_amounts(F.col(text)) if "MONEY" in kinds else F.array().cast("array<string>")
    table = entries(config.gazetteer, ("phrase", "kind"), config, df.sparkSession)
    if isinstance(table, DataFrame):
        known = table.where(F.col("kind").isin(kinds))
        named = _by_join(df, source or df, key, text, known, config)
    else:
        named = _in_row(df, text, [phrase for phrase, kind in table if kind in kinds], config.entity_longest)
    return named.withColumn(out, sorted_set(F.concat(F.col("_names"), money))).drop("_names")


def _maximal(found: Column, longest: int) -> Column:
    """The texts of ``found`` (pos, n, run), in order of ``pos`` with one entry each, that lie in no other one.

    Only the entries of the last ``longest - 1`` positions can reach over one, so as many are looked at.
    """
    def hidden(m: Column, k: Column) -> Column:
        before = F.slice(found, F.greatest(k - (longest - 2), F.lit(1)), F.least(k, F.lit(longest - 1)))
        return F.exists(before, lambda b: b["pos"] + b["n"] >= m["pos"] + m["n"])

    return F.transform(F.filter(found, lambda m, k: ~hidden(m, k)), lambda m: m["run"])


def _in_row(df: DataFrame, text: str, phrases: list[str], only_longest: bool) -> DataFrame:
    """Word runs that start like a known phrase, kept if they are one."""
    by_size: dict[int, list[str]] = {}
    for p in filter(None, phrases):
        by_size.setdefault(len(p.split(" ")), []).append(p)
    if not by_size:
        return df.withColumn("_names", F.array().cast("array<string>"))
    first = sorted({p.split(" ")[0] for size in by_size.values() for p in size})
    longest, words = max(by_size), F.col("_words")

    def match(i: Column) -> list[Column]:
        def run(n: int) -> Column:
            return F.get(words, i - 1) if n == 1 else F.array_join(F.slice(words, i, n), " ")

        def known(n: int) -> Column:  # the last word is cheaper to look at than the whole run
            last = F.get(words, i + (n - 2)).isin(sorted({p.split(" ")[-1] for p in by_size[n]}))
            return run(n).isin(by_size[n]) if n == 1 else last & run(n).isin(by_size[n])

        return [F.when(known(n), F.struct(i.alias("pos"), F.lit(n).alias("n"), run(n).alias("run")))
                for n in sorted(by_size, reverse=True)]

    starts = F.filter(F.transform(words, lambda w, i: F.when(w.isin(first), i + 1)), lambda i: i.isNotNull())
    found = (F.transform(starts, lambda i: F.coalesce(*match(i))) if only_longest
             else F.flatten(F.transform(starts, lambda i: F.array(*match(i)))))
    rows = (df.withColumn("_words", name_words(F.col(text)))
            .withColumn("_names", F.filter(found, lambda m: m.isNotNull())).drop("_words"))
    return rows.withColumn("_names", _maximal(F.col("_names"), longest) if only_longest else F.col("_names.run"))


def _by_join(df: DataFrame, source: DataFrame, key: str, text: str, table: DataFrame, config: PipelineConfig) -> DataFrame:
    """Word runs that a phrase table of any size has; see ``phrase_runs``."""
    words = source.select(key, name_words(F.col(text)).alias("words"))
    matches, longest = phrase_runs(words, key, table.select("phrase").where(F.col("phrase") != ""), config, staged)
    if config.entity_longest:
        ends = matches.groupBy(key, "pos").agg(F.max(F.struct("n", "run")).alias("m"))
        names = (ends.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "m.n", "m.run"))).alias("_names"))
                 .withColumn("_names", _maximal(F.col("_names"), longest)))
    else:
        names = matches.groupBy(key).agg(F.collect_set("run").alias("_names"))
    # A merge join: the names grow with the texts, and their stored runs are far smaller than they are.
    return (df.join(names.hint("merge"), key, "left")
            .withColumn("_names", F.coalesce("_names", F.array().cast("array<string>"))))


def entity_udf(find: Callable[[Sequence[str]], Sequence[Sequence[tuple[str, str]]]], kinds: list[str]):
    """Arrow UDF around a function from texts to lists of ``(surface, kind)``;
    a text it fails on has no entities."""

    def alone(text: str):
        try:
            return find([text])[0]
        except Exception:
            return []

    @F.pandas_udf("array<string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in batches:
            texts = [t or "" for t in column]
            try:
                results = list(find(texts))
                if len(results) != len(texts):
                    raise ValueError("one result per text expected")
            except Exception:
                results = [alone(t) for t in texts]
            yield pd.Series([[s for s, kind in found if kind in kinds] for found in results])

    return run
