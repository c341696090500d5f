"""Language of a text, from a trigram model or from weighted words, and language names."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediasignal.config import PipelineConfig
from mediasignal.functions.text import default_text, words_lower
from mediasignal.operators.lookup import entries, is_bounded, lookup_join
from mediasignal.operators.ngrams import UNKNOWN, language_of
from mediasignal.session import staged


def language_basis(body: Column, title: Column, config: PipelineConfig) -> Column:
    """The body if it is longer than ``basis_chars``, else the (untranslated) title."""
    return F.when(F.length(body) > config.basis_chars, body).otherwise(title)


def add_language(df: DataFrame, key: str, text: str, out: str, config: PipelineConfig) -> DataFrame:
    """Add the code of the likeliest language.

    With a ``language_model`` that is the one of its trigrams; see ``ngrams``.
    Else the profile's words decide: the highest sum of weights wins. Equal scores go to the smaller code; a text without profile words is
    ``unknown``. ``key`` must be unique; it is used only for large profiles.
    """
    if config.language_model is not None:
        return df.withColumn(out, language_of(F.col(text), config.language_model))
    profile = entries(config.language_profile, ("lang", "token", "weight"), config, df.sparkSession)
    if isinstance(profile, DataFrame):
        return _by_join(df, key, text, out, profile, config)
    return _in_row(df, text, out, profile)


def _in_row(df: DataFrame, text: str, out: str, profile: list[tuple]) -> DataFrame:
    weights: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
    for lang, token, weight in profile:
        weights[lang][token] += weight
    tokens = sorted({token for words in weights.values() for token in words})
    if not tokens:
        return df.withColumn(out, F.lit(UNKNOWN))

    def hits(words: list[str]) -> Column:
        return F.size(F.filter(F.col("_hits"), lambda w: w.isin(words))).cast("long")

    def score(lang: str) -> Column:
        by_weight = defaultdict(list)
        for token, weight in weights[lang].items():
            by_weight[weight].append(token)
        return sum((hits(words) * weight for weight, words in by_weight.items()), F.lit(0).cast("long"))

    ranked = F.array(*[
        F.struct(score(lang).alias("score"), F.lit(-i).alias("order"), F.lit(lang).alias("lang"))
        for i, lang in enumerate(sorted(weights))])
    return (
        df.withColumn("_hits", F.filter(words_lower(F.col(text)), lambda w: w.isin(tokens)))
        .withColumn("_best", F.array_max(ranked))
        .withColumn(out, F.when(F.col("_best.score") > 0, F.col("_best.lang")).otherwise(UNKNOWN))
        .drop("_hits", "_best")
    )


def _by_join(df: DataFrame, key: str, text: str, out: str, profile: DataFrame,
             config: PipelineConfig) -> DataFrame:
    words = df.select(key, F.explode(words_lower(F.col(text))).alias("token"), F.lit(1).alias("n"))
    bounded = is_bounded(profile, config)
    if not bounded:
        words = words.groupBy(key, "token").agg(F.count(F.lit(1)).alias("n"))
    scores = (lookup_join(words, profile, "token", "inner", [key], config, bounded)
              .groupBy(key, "lang").agg(F.sum(F.col("n") * F.col("weight")).alias("score"))
              .where("score > 0"))
    best = scores.groupBy(key).agg(F.min_by("lang", F.struct(-F.col("score"), "lang")).alias(out))
    return df.join(best, key, "left").withColumn(out, F.coalesce(out, F.lit(UNKNOWN)))


def add_language_name(df: DataFrame, code: str, out: str, config: PipelineConfig) -> DataFrame:
    """Add the display name of a language code, ``Unknown`` if it has none.

    A joined table is first cut to the codes that occur, of which there are as
    many as languages; the articles then stay where they are.
    """
    names = entries(config.language_names, ("code", "name"), config, df.sparkSession)
    if isinstance(names, DataFrame):
        side = names.select(F.col("code").alias("_lookup"), F.col("name").alias(out))
        bounded = is_bounded(side, config) or None
        if not bounded:
            codes = df.select(F.col(code).alias("_lookup")).distinct()
            side = staged(side.join(codes, "_lookup", "left_semi"), "names")
        joined = lookup_join(df.withColumn("_lookup", F.col(code)), side, "_lookup", "left", df.columns[:1], config,
                             bounded)
        return joined.drop("_lookup").withColumn(out, default_text(F.col(out), "Unknown"))
    if not names:
        return df.withColumn(out, F.lit("Unknown"))
    literal = F.create_map(*[F.lit(x) for pair in names for x in pair])
    return df.withColumn(out, default_text(literal[F.col(code)], "Unknown"))
