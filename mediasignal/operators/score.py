"""Signed sentiment per country and month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediasignal.config import PipelineConfig
from mediasignal.functions import dates
from mediasignal.functions.text import norm_label
from mediasignal.operators.columns import rename, require_columns
from mediasignal.operators.dedupe import keep_first
from mediasignal.operators.sentiment import LABEL, SCORE

REQUIRED = ("Date", "Country", LABEL, SCORE)
# Scores are summed as decimals of 18 places, so sums don't depend on the order of rows.
EXACT = "decimal(28,18)"
OUTPUT = ("Year-Month", "COUNTRY", "article_count", "pos_count", "neg_count", "neu_count",
          "majority_sentiment", "avg_sentiment_label", "avg_sentiment")


def sign(label: Column) -> Column:
    return F.when(label == "bullish", 1).when(label == "bearish", -1).otherwise(0)


def signed_score(label: Column, score: Column) -> Column:
    return sign(label) * score.cast("double")


def average_label(total: Column) -> Column:
    return F.when(total > 0, "bullish").when(total < 0, "bearish").otherwise("neutral")


def with_normal_label(df: DataFrame) -> DataFrame:
    return df.withColumn(LABEL, norm_label(F.col(f"`{LABEL}`")))


def drop_missing_score(df: DataFrame) -> DataFrame:
    """Neither null nor NaN."""
    return df.withColumn(SCORE, F.col(f"`{SCORE}`").cast("double")).na.drop(subset=[SCORE])


def drop_bad_date(df: DataFrame) -> DataFrame:
    return df.withColumn("Date", dates.parse_lenient(F.col("Date"))).where(F.col("Date").isNotNull())


def drop_duplicate_urls(df: DataFrame, order: Sequence[str | Column] | None = None) -> DataFrame:
    """Keep the first row per URL, if there is such a column.

    First means: earliest date, then highest score, then smallest label and country.
    """
    if "URL" not in df.columns:
        return df
    default = ["Date", F.col(f"`{SCORE}`").desc(), f"`{LABEL}`", "Country"]
    return keep_first(df, "URL", order or default)


def confident(df: DataFrame, config: PipelineConfig) -> DataFrame:
    return df.where(F.col(f"`{SCORE}`") >= F.lit(config.conf_threshold))


def clean(df: DataFrame, config: PipelineConfig, order: Sequence[str | Column] | None = None) -> DataFrame:
    """Rows that count. Duplicates go before the threshold: an article whose first
    row is not confident is left out altogether."""
    rows = with_normal_label(require_columns(df, REQUIRED))
    return confident(drop_duplicate_urls(drop_bad_date(drop_missing_score(rows)), order), config)


def rollup(rows: DataFrame, first: Sequence[str] = ("Date", "URL")) -> DataFrame:
    """Counts, majority and mean per country and month, in one pass over ``rows``.

    Labels are counted first, so the second grouping sees one row per label;
    both groupings combine before they shuffle, and no group is ever gathered.
    A majority tie goes to the label whose first row comes first by the columns
    ``first``. Each label keeps that row's columns as its minimum, for which Spark
    sorts the slim rows of a task instead of hashing them.
    """
    n, group = F.col("n"), ["Country", "month"]

    def label_count(label: str) -> Column:
        return F.sum(F.when(F.col("label") == label, n).otherwise(0))

    counted = rows.where(F.col("Country").isNotNull()).select(
        "Country", dates.month_start(F.col("Date")).alias("month"), F.col(f"`{LABEL}`").alias("label"),
        (sign(F.col(f"`{LABEL}`")) * F.col(f"`{SCORE}`").cast(EXACT)).cast(EXACT).alias("signed"),
        F.struct(*[c for c in first if c in rows.columns]).alias("at"))
    per_label = counted.groupBy(*group, "label").agg(
        F.count(F.lit(1)).alias("n"), F.sum("signed").alias("signed"), F.min("at").alias("at"))
    grouped = per_label.groupBy(*group).agg(
        F.sum("n").alias("article_count"),
        label_count("bullish").alias("pos_count"),
        label_count("bearish").alias("neg_count"),
        label_count("neutral").alias("neu_count"),
        F.coalesce(F.min_by("label", F.struct(-n, "at")), F.lit("neutral")).alias("majority_sentiment"),
        F.sum("signed").alias("signed"),
    )
    mean = F.col("signed").cast("double") / F.col("article_count").cast("double")
    labelled = (
        grouped.withColumn("avg_sentiment", mean)
        .withColumn("avg_sentiment_label", average_label(F.col("signed")))
        .withColumn("Date", dates.iso_day(F.col("month")))
    )
    renamed = rename(labelled, {"Country": "COUNTRY", "Date": "Year-Month"})
    return renamed.select(*[f"`{c}`" for c in OUTPUT])


def score(df: DataFrame, config: PipelineConfig, order: Sequence[str | Column] | None = None,
          first: Sequence[str] = ("Date", "URL")) -> DataFrame:
    """The whole third stage, sorted by country and month."""
    return rollup(clean(df, config, order), first).orderBy("COUNTRY", "`Year-Month`")
