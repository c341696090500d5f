"""Language of a text from character trigrams, with log-probabilities counted from labelled texts.

The words of a text are its runs of letters, lower-cased; each, between two
blanks, gives its trigrams. A language's weight of a trigram is
``round(1000 * ln((n + 1) / (N + V)))``, with ``n`` its occurrences there, ``N`` those of
all and ``V`` the number of trigrams; one that the language doesn't have gets the weight of
``n = 0``. A text belongs to the language with the largest sum, of equal sums to
the smaller code; without letters it is ``unknown``. Weights are whole numbers, so
sums don't depend on order.

Counting takes all labelled texts: words are counted before they are cut into
trigrams, so the shuffle carries one row per word and language and task. The
model keeps the ``GRAMS_EACH`` most frequent trigrams of each language, which bounds
what a worker holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRAMS_EACH = 20_000
UNKNOWN = "unknown"
_HELD_WORDS = 500_000


def letters(text: Column) -> Column:
    """Lower-case text in which each run of other characters is one blank."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}]+", " ")


def gram_weights(texts: DataFrame, text: str, lang: str, grams_each: int = GRAMS_EACH) -> DataFrame:
    """(lang, gram, weight) of the most frequent trigrams per language; gram '' has the weight of all others."""
    words = (texts.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.explode(F.split(letters(F.col(text)), " ")).alias("word"))
             .where("word <> ''").groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n")))
    grams = words.select("lang", "n", F.explode(F.expr(
        "transform(sequence(1, length(word)), i -> substring(concat(' ', word, ' '), i, 3))")).alias("gram"))
    counts = grams.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = counts.groupBy("lang").agg((F.sum("n") + F.count(F.lit(1))).cast("double").alias("total"))

    def weight(n: Column) -> Column:
        return F.round(1000 * F.ln(n.cast("double") / F.col("total"))).cast("long").alias("weight")

    frequent = counts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(
        F.col("rank") <= grams_each)
    return frequent.join(F.broadcast(totals), "lang").select("lang", "gram", weight(F.col("n") + 1)).unionByName(
        totals.select("lang", F.lit("").alias("gram"), weight(F.lit(1))))


@dataclass(frozen=True)
class LanguageModel:
    """Weights for use in Python workers: a row of ``weights`` per trigram, a column per language; row 0 is for other trigrams."""

    langs: tuple[str, ...]
    rows: dict[str, int]
    weights: np.ndarray

    @classmethod
    def of(cls, table: DataFrame) -> LanguageModel:
        """The model of a table that ``gram_weights`` made; it has ``GRAMS_EACH + 1`` rows a language at most."""
        entries = table.select("lang", "gram", "weight").collect()
        langs = tuple(sorted({r.lang for r in entries}))
        column = {lang: i for i, lang in enumerate(langs)}
        rows = {gram: i for i, gram in enumerate(sorted({r.gram for r in entries}))}
        others = np.zeros(len(langs), dtype=np.int64)
        for r in entries:
            if not r.gram:
                others[column[r.lang]] = r.weight
        weights = np.tile(others, (max(len(rows), 1), 1))
        for r in entries:
            weights[rows[r.gram], column[r.lang]] = r.weight
        return cls(langs, rows, weights)

    def of_word(self, word: str) -> np.ndarray:
        padded, rows = f" {word} ", self.rows
        return self.weights[[rows.get(padded[i:i + 3], 0) for i in range(len(word))]].sum(axis=0)


def language_of(text: Column, model: LanguageModel) -> Column:
    """Code of the likeliest language."""
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        ids: dict[str, int] = {}
        known = np.zeros((1024, len(model.langs)), dtype=np.int64)
        for texts in batches:
            found = []
            for cleaned in texts:
                words = cleaned.split(" ") if cleaned else []
                words = words[not words[0]:len(words) - (not words[-1])] if words else words
                if not words or not model.langs:
                    found.append(UNKNOWN)
                    continue
                if len(ids) > _HELD_WORDS:
                    ids = {}
                for word in set(words).difference(ids):
                    if len(ids) == len(known):
                        known = np.concatenate([known, np.zeros_like(known)])
                    known[len(ids)] = model.of_word(word)
                    ids[word] = len(ids)
                sums = known[np.fromiter(map(ids.__getitem__, words), dtype=np.int64, count=len(words))].sum(axis=0)
                found.append(model.langs[int(sums.argmax())])
            yield pd.Series(found, dtype=object)

    return F.pandas_udf(judge, "string")(F.coalesce(letters(text), F.lit("")))
