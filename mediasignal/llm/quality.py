"""Quality scores by Bradley-Terry ranking.

A document's score is a weighted sum of features of its whole text. The weights
are learned from preference pairs, a document of label 1 over one of label 0,
by logistic loss on the difference of their features. Quantiles of the scores
of both labels then set the threshold: halfway between a high quantile of label
0 and a low one of label 1. A logistic curve maps scores to 0..1 so that the
threshold gets ``CUT``.

The model is fitted on a bounded sample of labelled rows, at most
``LABELLED_ROWS`` of each label, the first by a hash of their id. Scoring
covers all rows and whole texts and uses nothing but the text.

Defined cases: null and empty texts are scored as empty texts. A null id is
never held out and has no label; an id with both labels isn't learned from,
one with several rows once;
labels other than 0 and 1 are ignored. Without labels of both kinds every score
is 0.5. Repeated rows get equal scores; empty tables give empty tables; extra
columns are ignored or, in ``keep_good``, passed through.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediasignal.llm.common import fresh, whole_text

#: Labelled rows of each label that the model is fitted on, at most.
LABELLED_ROWS = 10_000
#: Preference pairs: each labelled row meets this many of the other label.
PAIRS_EACH = 8
#: Score at the threshold.
CUT = 0.3
#: Quantiles of the scores of label 0 and label 1 that the threshold lies between.
QUANTILES = (0.99, 0.01)
RIDGE = 1e-3


def _class(*spans: tuple[int, int]) -> np.ndarray:
    mask = np.zeros(256, dtype=bool)
    for first, last in spans:
        mask[first:last + 1] = True
    return mask


_UPPER = _class((65, 90))
_LETTER = _class((65, 90), (97, 122), (128, 255))
_DIGIT = _class((48, 57))
_PLAIN = _class((9, 13), (32, 32), (44, 44), (46, 46)) | _LETTER | _DIGIT
_MARKS = [b"|", b"!", b".,", b"#$%&*", b":/@"]


def features(data: bytes) -> list[float]:
    """Shares of kinds of characters, words and lines of a UTF-8 text."""
    counts = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    words = data.lower().split()
    lines = [line for line in data.split(b"\n") if line.strip()]
    n, n_words, n_lines = max(len(data), 1), max(len(words), 1), max(len(lines), 1)
    letters = int(counts[_LETTER].sum())
    return [
        math.log1p(len(words)), letters / n, counts[_UPPER].sum() / max(letters, 1), counts[_DIGIT].sum() / n,
        counts[~_PLAIN].sum() / n, *(sum(int(counts[c]) for c in marks) / n_words for marks in _MARKS),
        math.log1p(10 * len(lines) / n_words), sum(map(len, words)) / n_words / 10, len(set(words)) / n_words,
        len(set(lines)) / n_lines, sum(len(w) <= 3 for w in words) / n_words,
    ]


@dataclass(frozen=True)
class QualityModel:
    mean: list[float]
    scale: list[float]
    weights: list[float]
    threshold: float

    def rank(self, rows: np.ndarray) -> np.ndarray:
        """Bradley-Terry scores."""
        z = np.clip((rows - np.array(self.mean)) / np.array(self.scale), -6, 6)
        return np.hstack([z, z * z]) @ np.array(self.weights)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Scores between 0 and 1; the threshold is at ``CUT``."""
        if not any(self.weights):
            return np.full(len(rows), 0.5)
        x = self.rank(rows) - self.threshold + math.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves no remainder modulo 5; such rows are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int = LABELLED_ROWS) -> DataFrame:
    """(doc_id, label, text as bytes) of at most ``most`` documents of each label, none of them held out."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("other"))
             .where("label = other").select("doc_id", "label"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = known.where("label = 0").orderBy(*order).limit(most).unionByName(
        known.where("label = 1").orderBy(*order).limit(most))
    # At most 2 * most rows of an id and a label.
    return docs.select("doc_id", whole_text(F.col("text")).cast("binary").alias("data")).join(
        F.broadcast(picked), "doc_id").select("doc_id", "label", "data")


def _newton(pairs: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Weights that minimise the logistic loss of the pairs' feature differences."""
    weights = np.zeros(pairs.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(pairs @ weights, -50, 50)))
        slope = pairs.T @ (p - 1) / len(pairs) + RIDGE * weights
        bend = (pairs * (p * (1 - p))[:, None]).T @ pairs / len(pairs) + RIDGE * np.eye(len(weights))
        step = np.linalg.solve(bend, slope)
        weights = weights - step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def fit(docs: DataFrame, labels: DataFrame, most: int = LABELLED_ROWS) -> QualityModel:
    """Learn from documents and their labels (doc_id, quality)."""

    @F.pandas_udf("array<double>")
    def compute(texts: pd.Series) -> pd.Series:
        return texts.map(features)

    # One row for an id, however often it is repeated, so the driver gets 2 * most rows at most.
    sample = labelled_sample(docs, labels, most).select("doc_id", "label", compute("data").alias("x")).groupBy(
        "doc_id", "label").agg(F.min("x").alias("x")).toPandas()
    width = len(features(b""))
    if sample["label"].nunique() < 2:
        return QualityModel([0.0] * width, [1.0] * width, [0.0] * 2 * width, 0.0)
    rows, label = np.array(sample["x"].tolist()), sample["label"].to_numpy()
    order = np.lexsort([*rows.T, label])  # the order in which rows arrive must not matter
    rows, label = rows[order], label[order]
    mean, scale = rows.mean(axis=0), rows.std(axis=0) + 1e-6
    z = np.clip((rows - mean) / scale, -6, 6)
    z = np.hstack([z, z * z])
    good, bad = z[label == 1], z[label == 0]
    random = np.random.default_rng(7)
    n = PAIRS_EACH * max(len(good), len(bad))
    better = np.resize(random.permutation(len(good)), n)
    worse = np.resize(random.permutation(len(bad)), n)
    weights = _newton(good[random.permutation(better)] - bad[random.permutation(worse)])
    low, high = np.quantile(bad @ weights, QUANTILES[0]), np.quantile(good @ weights, QUANTILES[1])
    return QualityModel(mean.tolist(), scale.tolist(), weights.tolist(), float(low + high) / 2)


def text_score(text: Column, model: QualityModel) -> Column:
    @F.pandas_udf("double")
    def compute(texts: pd.Series) -> pd.Series:
        rows = [features(t) for t in texts]
        return pd.Series(model.score(np.array(rows)) if rows else [], dtype="float64")

    return compute(whole_text(text).cast("binary"))


def quality_scores(docs: DataFrame, model: QualityModel) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 from ``CUT``)."""
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                       text_score(F.col("text"), model).alias("score")).withColumn(
        "predicted", (F.col("score") >= CUT).cast("int"))


def keep_good(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The columns of ``docs`` and the rows that score at least ``CUT``."""
    (score,) = fresh(docs, "score")
    return docs.withColumn(score, text_score(F.col("text"), model)).where(F.col(score) >= CUT).select(*docs.columns)
