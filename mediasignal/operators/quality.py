"""Counts that describe a run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from mediasignal.functions import dates
from mediasignal.functions.text import norm_label, percent
from mediasignal.operators.articles import reply_object
from mediasignal.operators.sentiment import FAILED, KINDS, LABEL, NO_CONTENT, SCORE


def label_distribution(df: DataFrame) -> DataFrame:
    return (df.groupBy(norm_label(F.col(f"`{LABEL}`")).alias("label"))
            .agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "label"))


def drop_counts(df: DataFrame) -> DataFrame:
    """Rows read, dropped for a bad score or date, dropped as duplicates, and kept.

    Copies of a URL are counted before the shuffle, so a frequent URL is cheap.
    """
    value = F.col(f"`{SCORE}`").cast("double")
    good = value.isNotNull() & ~F.isnan(value) & dates.parse_lenient(F.col("Date")).isNotNull()
    marked = df.withColumn("_good", F.when(good, 1).otherwise(0))
    counts = [F.count(F.lit(1)).alias("n"), F.sum("_good").alias("good")]
    has_url = "URL" in df.columns
    groups = marked.groupBy("URL").agg(*counts) if has_url else marked.agg(*counts)
    kept = F.least("good", F.lit(1)) if has_url else F.col("good")
    zero = F.lit(0)
    return groups.agg(
        F.coalesce(F.sum("n"), zero).cast("long").alias("rows_in"),
        F.coalesce(F.sum(F.col("n") - F.col("good")), zero).cast("long").alias("bad_score_or_date"),
        F.coalesce(F.sum(F.col("good") - kept), zero).cast("long").alias("duplicate_urls"),
        F.coalesce(F.sum(kept), zero).cast("long").alias("rows_out"),
    )


def request_counts(responses: DataFrame) -> DataFrame:
    """Requests per country and day, and one row with null keys for the whole run.

    Bodies are judged once: the total is a second grouping set over the counts
    per country and day. No requests give no rows.
    """
    usable = F.count_if(reply_object(F.col("status"), F.col("body")).isNotNull())
    per_day = responses.groupBy("code", "day").agg(F.count(F.lit(1)).alias("requests"), usable.alias("usable"))
    day, code = F.col("day"), F.col("code")
    return (per_day.groupingSets([[code, day], []], code, day)
            .agg(F.sum("requests").alias("requests"), F.sum("usable").alias("usable")))


def request_summary(responses: DataFrame) -> DataFrame:
    """One row (rows_in, details) of the replies a run asked for, in one pass over them."""
    usable = F.count_if(reply_object(F.col("status"), F.col("body")).isNotNull())
    return responses.agg(F.count(F.lit(1)).alias("rows_in"), F.concat(F.lit("usable="), usable.cast("string")).alias("details"))


def drop_summary(df: DataFrame) -> DataFrame:
    """One row (rows_in, details) of the rows a rollup read, in one pass over them."""
    parts = [F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in ("bad_score_or_date", "duplicate_urls")]
    return drop_counts(df).select("rows_in", F.concat_ws(", ", *parts).alias("details"))


class Written:
    """What a stage writes, counted while it is written.

    ``rows`` is to be written in place of the frame it was made of. The counts are taken in the tasks that write
    the files, whose counts Spark takes once each, however often a task or an executor is lost; a count
    further up, before a shuffle, would grow when a stage runs again. ``counts`` waits for the write.
    """

    def __init__(self, df: DataFrame, labels: bool = False):
        self._seen = Observation()
        self._labels = [norm_label(F.lit(x)) for x in (*KINDS, FAILED, NO_CONTENT)] if labels else []
        metrics = [F.count(F.lit(1)).alias("rows")]
        if labels:
            label = F.col(f"`{LABEL}`")
            metrics.append(F.count(label).alias("labelled"))
            metrics += [F.count_if(label.isNotNull() & (norm_label(label) == x)).alias(f"label{i}")
                        for i, x in enumerate(self._labels)]
        self.rows = df.observe(self._seen, *metrics)

    def counts(self) -> dict[str, int]:
        return self._seen.get

    def label_summary(self, spark: SparkSession) -> DataFrame | None:
        """One row (rows_out, details) as ``label_summary`` gives it; None if there were labels beyond the known ones."""
        counts = self.counts()
        each = [counts[f"label{i}"] for i in range(len(self._labels))]
        if sum(each) != counts["labelled"]:
            return None
        parts = [F.concat(x, F.lit(f"={n}")) for x, n in zip(self._labels, each) if n]
        details = F.array_join(F.array_sort(F.array(*parts)), ", ") if parts else F.lit("")
        return one_row(spark).select(F.lit(counts["labelled"]).cast("long").alias("rows_out"), details.alias("details"))


def label_summary(df: DataFrame) -> DataFrame:
    """One row (rows_out, details): the rows with a label, and ``label=count`` in label order; there are few labels."""
    each = label_distribution(df.where(F.col(f"`{LABEL}`").isNotNull())).select(
        "n", F.concat_ws("=", "label", F.col("n").cast("string")).alias("part"))
    return each.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows_out"),
                    F.array_join(F.array_sort(F.collect_list("part")), ", ").alias("details"))


def one_row(spark: SparkSession) -> DataFrame:
    return spark.range(1).select()


def count_of(spark: SparkSession, n: int, name: str) -> DataFrame:
    """One row with a count that is known."""
    return one_row(spark).select(F.lit(n).cast("long").alias(name))


def summary_row(stage: str, before: DataFrame, after: DataFrame) -> DataFrame:
    """The summary of a stage from one row with ``rows_in``, one with ``rows_out``, and ``details`` in either."""
    both = before.join(after)  # one row each
    return both.select(F.lit(stage).alias("stage"), "rows_in", "rows_out",
                       percent(F.col("rows_out"), F.col("rows_in")).alias("percent"), "details")


def stage_summary(stage: str, before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows in and out of a stage, both counted from frames, and the percentage done."""
    zero = F.lit(0).cast("long")
    counts = [before.agg(F.count(F.lit(1)).alias("a")).select("a", zero.alias("b")),
              after.agg(F.count(F.lit(1)).alias("b")).select(zero.alias("a"), "b")]
    counted = reduce(DataFrame.unionByName, counts).agg(F.sum("a").alias("rows_in"), F.sum("b").alias("rows_out"))
    return counted.select(F.lit(stage).alias("stage"), "rows_in", "rows_out",
                          percent(F.col("rows_out"), F.col("rows_in")).alias("percent"))
