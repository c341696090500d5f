"""Run the stages over named datasets."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediasignal import schemas
from mediasignal.config import PipelineConfig
from mediasignal.functions import dates
from mediasignal.operators.quality import Written, count_of, drop_summary, label_summary, request_summary, summary_row
from mediasignal.operators.score import score
from mediasignal.operators.sentiment import LABEL
from mediasignal.plans.collect import collect, found_articles, replies_of_week
from mediasignal.plans.enrich import enrich
from mediasignal.session import staging_scope
from mediasignal.sources.datasets import Datasets

STAGES = ("collect", "enrich", "score")


def run_stages(datasets: Datasets, responses: DataFrame | None = None, pages: DataFrame | None = None,
               config: PipelineConfig | None = None, run_date: date | str | None = None,
               stages: Sequence[str] = STAGES, keep_weeks: bool = False,
               every_week: bool = False) -> DataFrame:
    """Run the picked stages in order and return one summary row per stage.

    Each stage writes its dataset and the next one reads it; a stage that is not
    picked is taken from its dataset as it stands. Empty article tables are not
    written, an empty rollup is. The week is the one of ``run_date``, by default
    today; ``every_week`` takes all landed replies. With ``keep_weeks`` the raw
    and the enriched dataset are partitioned by ``run_week``, a run replaces the
    partitions of its week, and the rollup covers all weeks that are stored.

    The summary counts the week's replies and articles for *collect*, articles
    and those with a sentiment label for *enrich*, rows read and rollup rows for
    *score*; ``details`` names usable replies, labels and dropped rows. What a stage
    writes is counted by the tasks that write it, not read again.
    """
    config = config or PipelineConfig()
    unknown = set(stages) - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stage(s): {sorted(unknown)}")
    spark = datasets.spark
    summaries = []
    base: DataFrame | None = None
    found: int | None = None  # rows of base, where the run knows them
    day = None if every_week else _as_date(run_date)
    by = "run_week" if keep_weeks else None
    whole = by is None or day is not None  # what a run writes is all that is read back

    def of_week(stored: DataFrame) -> DataFrame:
        if by is None or day is None:
            return stored
        return stored.where(F.col(by) == dates.week_start(F.lit(day.isoformat()).cast("date")))

    def with_week(df: DataFrame) -> DataFrame:
        week = dates.week_start(dates.parse_lenient(F.col("Date")).cast("date"))
        return df.withColumn(by, week) if by else df

    if "collect" in stages:
        asked = replies_of_week(responses, day)
        written = Written(with_week(collect(responses, day)))
        wrote = datasets.write(config.raw_dataset, written.rows, on_empty="skip",
                               partition_by=by, probe=found_articles(responses, day))
        base = of_week(datasets.read(config.raw_dataset)) if wrote else spark.createDataFrame([], schemas.ARTICLES_RAW)
        found = (written.counts()["rows"] if whole else base.count()) if wrote else 0
        summaries.append(summary_row("collect", request_summary(asked), count_of(spark, found, "rows_out")))

    if "enrich" in stages:
        if base is None:
            base = of_week(datasets.read(config.raw_dataset))
        if found is None:
            found = base.count()
        with staging_scope(spark):
            written = Written(with_week(enrich(base, pages, config, few=True)), labels=True)
            wrote = datasets.write(config.enriched_dataset, written.rows, on_empty="skip", partition_by=by, probe=base)
        done = written.label_summary(spark) if wrote and whole else None
        if done is None:
            stored = of_week(datasets.read(config.enriched_dataset)) if wrote else spark.createDataFrame([], written.rows.schema)
            done = label_summary(stored)
        summaries.append(summary_row("enrich", count_of(spark, found, "rows_in"), done))

    if "score" in stages:
        enriched = datasets.read(config.enriched_dataset)
        written = Written(score(enriched, config))
        datasets.write(config.rollup_dataset, written.rows, on_empty="write")
        rows = count_of(spark, written.counts()["rows"], "rows_out")
        summaries.append(summary_row("score", drop_summary(enriched), rows))

    return reduce(DataFrame.unionByName, summaries)


def _as_date(run_date: date | str | None) -> date:
    if run_date is None:
        return datetime.now(timezone.utc).date()
    return run_date if isinstance(run_date, date) else date.fromisoformat(run_date)
