"""Sentiment label and confidence of a text.

The default counts polarity words; ``sentiment_model`` plugs in a model.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediasignal.config import PipelineConfig
from mediasignal.functions.text import is_blank, norm_label, words_lower
from mediasignal.operators.lookup import entries, is_bounded, lookup_join
from mediasignal.session import staged

LABEL = "Model Sentiment Label"
SCORE = "Model Sentiment Score"
# --- fixed values: labels of texts without a score ---
FAILED = "[SENTIMENT FAILED]"
NO_CONTENT = "[failed - no content]"
# Order of preference when counts are equal.
KINDS = ("neutral", "bullish", "bearish")


def add_sentiment(df: DataFrame, key: str, text: str, config: PipelineConfig) -> DataFrame:
    """Add label and score (0 to 1, two places); a blank text fails with no score."""
    if config.sentiment_model is not None:
        return add_model_sentiment(df, text, config.sentiment_model)
    polarity = entries(config.polarity, ("token", "kind"), config, df.sparkSession)
    if isinstance(polarity, DataFrame):
        counted = _count_by_join(df, key, text, polarity, config)
    else:
        counted = _count_in_row(df, text, polarity, config)
    label, score = label_and_score({k: F.col(f"_{k}") for k in KINDS})
    blank = is_blank(F.col(text))
    return (counted.withColumn(LABEL, F.when(blank, FAILED).otherwise(label))
            .withColumn(SCORE, F.when(~blank, score))
            .drop(*[f"_{k}" for k in KINDS]))


def label_and_score(counts: dict[str, Column]) -> tuple[Column, Column]:
    """Most frequent kind, and its share with one added to each count.

    The share is rounded half up in whole hundredths, so no binary fraction is
    involved.
    """
    top = F.greatest(*counts.values())
    label = F.coalesce(*[F.when(counts[k] == top, F.lit(k)) for k in KINDS])
    total = sum(counts.values(), F.lit(len(KINDS)).cast("long"))
    cents = F.call_function("div", (top + 1) * 200 + total, total * 2)
    return label, cents.cast("double") / 100


def _tokens(text: str, config: PipelineConfig) -> Column:
    words = words_lower(F.col(text))
    return words if config.sentiment_max_tokens is None else F.slice(words, 1, config.sentiment_max_tokens)


def _count_in_row(df: DataFrame, text: str, polarity: list[tuple], config: PipelineConfig) -> DataFrame:
    kind_of: dict[str, str] = {}
    for token, kind in polarity:
        kind_of[token] = min(kind, kind_of.get(token, kind))

    def hits(kind: str) -> Column:
        words = [t for t, k in kind_of.items() if k == kind]
        return F.size(F.filter(F.col("_hits"), lambda w: w.isin(words))).cast("long")

    return (df.withColumn("_hits", F.filter(_tokens(text, config), lambda w: w.isin(list(kind_of))))
            .withColumns({f"_{kind}": hits(kind) for kind in KINDS})
            .drop("_hits"))


def _count_by_join(df: DataFrame, key: str, text: str, polarity: DataFrame,
                   config: PipelineConfig) -> DataFrame:
    words = df.select(key, F.explode(_tokens(text, config)).alias("token"), F.lit(1).alias("n"))
    bounded = is_bounded(polarity, config)
    if not bounded:
        words = words.groupBy(key, "token").agg(F.count(F.lit(1)).alias("n"))
    unique = polarity.groupBy("token").agg(F.min("kind").alias("kind"))
    counts = (lookup_join(words, unique, "token", "inner", [key], config, bounded)
              .groupBy(key)
              .agg(*[F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).cast("long").alias(f"_{k}")
                     for k in KINDS]))
    return df.join(counts, key, "left").fillna(0, [f"_{k}" for k in KINDS])


def add_model_sentiment(df: DataFrame, text: str, model: Callable[[], Callable]) -> DataFrame:
    """Score with a plugged-in model.

    ``model()`` loads once per Python worker and returns a function from a list
    of texts to ``(label, score)`` pairs. Blank texts do not reach it; a text it
    fails on gets the failure label. Scores are rounded to two places with
    Python's rule.
    """
    scored = model_udf(model)(F.when(~is_blank(F.col(text)), F.col(text)))
    failed = F.col("_s.score").isNull()
    return (df.withColumn("_s", scored)
            .withColumn(LABEL, F.when(failed, FAILED).otherwise(norm_label(F.col("_s.label"))))
            .withColumn(SCORE, F.col("_s.score"))
            .drop("_s"))


def model_udf(model: Callable[[], Callable[[Sequence[str]], Sequence[tuple[str, float]]]]):
    @F.pandas_udf("label string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predict = model()

        def alone(text: str):
            try:
                return predict([text])[0]
            except Exception:
                return (None, None)

        for column in batches:
            texts = [t for t in column if t is not None]
            try:
                results = list(predict(texts)) if texts else []
                if len(results) != len(texts):
                    raise ValueError("one result per text expected")
            except Exception:
                results = [alone(t) for t in texts]
            it = iter(results)
            pairs = [next(it) if t is not None else (None, None) for t in column]
            yield pd.DataFrame({
                "label": [label for label, _ in pairs],
                "score": [None if s is None else round(float(s), 2) for _, s in pairs],
            }, dtype=object)

    return run


def add_no_content(df: DataFrame, status: str = "_status") -> DataFrame:
    """Rows without page content lose their score and say so in the label."""
    gone = F.col(status) == "no_content"
    return (df.withColumn(LABEL, F.when(gone, NO_CONTENT).otherwise(F.col(f"`{LABEL}`")))
            .withColumn(SCORE, F.when(~gone, F.col(f"`{SCORE}`"))))


@dataclass(frozen=True)
class TextClassifier:
    """A fitted classifier and, per label, the curve from its probability to the share of texts that had the label."""

    model: Any
    names: tuple[str, ...]
    curves: tuple[Any, ...]


# Probabilities are counted in so many steps when a curve is fitted, which bounds it whatever the number of texts.
_STEPS = 1000


def kept_out(text: Column) -> Column:
    """A fifth of the texts, by hash: never fitted by the classifier, but by the curves. Equal texts stay together."""
    return F.pmod(F.xxhash64(text), F.lit(5)) == 0


def fit_text_classifier(training: DataFrame, text: str, label: str) -> TextClassifier:
    """An MLlib classifier of hashed words, calibrated on texts that it was not fitted on.

    For each label an isotonic regression turns the classifier's probability into
    the share of kept-out texts of such a probability that have the label.
    """
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, StringIndexer
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.regression import IsotonicRegression

    words = training.withColumn("_words", words_lower(F.col(text)))
    fitted = Pipeline(stages=[
        StringIndexer(inputCol=label, outputCol="_label", stringOrderType="alphabetAsc"),
        HashingTF(inputCol="_words", outputCol="_features", numFeatures=1 << 14),
        LogisticRegression(featuresCol="_features", labelCol="_label", probabilityCol="_probability",
                           predictionCol="_prediction", rawPredictionCol="_raw", maxIter=20, regParam=0.01),
    ]).fit(words.where(~kept_out(F.col(text))))
    names, scorer = tuple(fitted.stages[0].labels), PipelineModel(fitted.stages[1:])
    # Rows per step of probability and label: at most (_STEPS + 1) * len(names) of them.
    judged = scorer.transform(words.where(kept_out(F.col(text)))).select(
        F.col(label).alias("label"), F.posexplode(vector_to_array("_probability")).alias("at", "p"))
    steps = staged(judged.groupBy("at", (F.round(F.col("p") * _STEPS) / _STEPS).alias("p")).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.avg((F.col("label") == F.element_at(F.array(*map(F.lit, names)), F.col("at") + 1)).cast("double")).alias("share")), "steps")
    curve = IsotonicRegression(featuresCol="p", labelCol="share", weightCol="n")
    found = {r.at for r in steps.select("at").distinct().collect()}
    return TextClassifier(scorer, names, tuple(
        curve.fit(steps.where(F.col("at") == i)) if i in found else None for i in range(len(names))))


def class_probabilities(df: DataFrame, text: str, classifier: TextClassifier, out: str) -> DataFrame:
    """Column ``out``: calibrated probabilities in the order of ``classifier.names``, with a sum of 1."""
    from pyspark.ml.functions import vector_to_array

    rows = classifier.model.transform(df.withColumn("_words", words_lower(F.col(text))))
    rows = rows.withColumn("_raws", vector_to_array("_probability"))
    for i, curve in enumerate(classifier.curves):
        rows = rows.withColumn(f"_p{i}", F.col("_raws")[i])
        if curve is not None:
            rows = (curve.copy({curve.featuresCol: f"_p{i}", curve.predictionCol: f"_c{i}"}).transform(rows)
                    .withColumn(f"_p{i}", F.col(f"_c{i}")).drop(f"_c{i}"))
    each = [F.col(f"_p{i}") for i in range(len(classifier.names))]
    total = sum(each, F.lit(0.0))
    # Where no kept-out text of such probabilities had any label, the classifier's own stand.
    rows = rows.withColumn(out, F.when(total > 0, F.array(*[p / total for p in each])).otherwise(F.col("_raws")))
    return rows.drop("_words", "_features", "_raw", "_probability", "_prediction", "_raws", *[f"_p{i}" for i in range(len(each))])


def round_two(score: Column) -> Column:
    """Two places as Python rounds them: by the exact value, so 0.695 gives 0.69."""
    def rounded(scores: pd.Series) -> pd.Series:
        return scores.map(lambda s: round(s, 2), na_action="ignore")

    return F.pandas_udf(rounded, "double")(score)


def add_classifier_sentiment(df: DataFrame, text: str, classifier: TextClassifier) -> DataFrame:
    """Label and score from :func:`fit_text_classifier`; blank texts fail as usual. Equal probabilities go to the first label."""
    rows = class_probabilities(df, text, classifier, "_each")
    blank = is_blank(F.col(text))
    label = F.element_at(F.array(*map(F.lit, classifier.names)), F.array_position("_each", F.array_max("_each")).cast("int"))
    return (rows.withColumn(LABEL, F.when(blank, FAILED).otherwise(label))
            .withColumn(SCORE, round_two(F.when(~blank, F.array_max("_each")))).drop("_each"))


def log_loss(df: DataFrame, text: str, label: str, classifier: TextClassifier) -> DataFrame:
    """(n, log_loss) of labelled texts; a probability counts as 0.001 at least."""
    rows = class_probabilities(df, text, classifier, "_each")
    of_label = F.try_element_at("_each", F.array_position(F.array(*map(F.lit, classifier.names)), F.col(label)).cast("int"))
    return rows.agg(F.count(F.lit(1)).alias("n"), F.avg(-F.ln(F.greatest(of_label, F.lit(0.001)))).alias("log_loss"))
