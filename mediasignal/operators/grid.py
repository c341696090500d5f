"""The request grid of a week: days, windows within the day, countries, URLs.

Every step fans rows out with ``explode`` over a short list, so no join and no
shuffle is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mediasignal.config import PipelineConfig
from mediasignal.functions import dates, urls


def week_of(df: DataFrame, run_date: str) -> DataFrame:
    """Monday and Sunday of the week that holds ``run_date``."""
    return (df.withColumn("week_start", dates.week_start(F.col(run_date)))
            .withColumn("week_end", dates.week_end(F.col(run_date))))


def week_days(df: DataFrame) -> DataFrame:
    """One row per day from ``week_start`` to ``week_end``, as column ``day``."""
    return df.withColumn("day", F.explode(F.sequence("week_start", "week_end", F.expr("interval 1 day"))))


def day_windows(df: DataFrame, hours: int) -> DataFrame:
    """One row per window of ``hours`` hours; ends are inclusive and stay within the day."""
    start = F.col("win") * hours * 3600
    end = F.least(start + hours * 3600 - 1, F.lit(86_399))

    def at(seconds: Column) -> Column:
        midnight = F.col("day").cast("timestamp_ntz")
        return dates.compact(F.timestamp_add("SECOND", seconds, midnight))

    count = -(-24 // hours)
    return (df.withColumn("win", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
            .withColumn("window_start", at(start)).withColumn("window_end", at(end)))


def country_dimension(spark: SparkSession, config: PipelineConfig) -> DataFrame:
    """Rows ``(region, code)`` as listed; a code may stand in two regions."""
    return spark.createDataFrame(
        [(region, code) for region, codes in config.regions.items() for code in codes],
        "region string, code string")


def distinct_codes(*lists: DataFrame) -> DataFrame:
    """Sorted distinct codes of one or more lists with a ``code`` column."""
    out = lists[0].select("code")
    for other in lists[1:]:
        out = out.unionByName(other.select("code"))
    return out.distinct().orderBy("code")


def keyword_query(config: PipelineConfig) -> Column:
    quoted = F.transform(F.array(*[F.lit(k) for k in config.keywords]),
                         lambda k: F.concat(F.lit('"'), k, F.lit('"')))
    return F.concat(F.lit("("), F.array_join(quoted, " OR "), F.lit(")"))


def country_query(code: Column, config: PipelineConfig) -> Column:
    return F.concat(keyword_query(config), F.lit(" sourcecountry:"), code)


def request_url(code: Column, start: Column, end: Column, config: PipelineConfig) -> Column:
    return F.concat(
        F.lit(f"{config.search_url}?query="), urls.quote_plus(country_query(code, config)),
        F.lit("&startdatetime="), start, F.lit("&enddatetime="), end,
        F.lit(f"&format=json&maxrecords={config.max_records}&mode=artlist"))


def request_grid(weeks: DataFrame, config: PipelineConfig) -> DataFrame:
    """Days × windows × countries of every week in ``weeks`` (``week_start``, ``week_end``)."""
    codes = F.array(*[F.lit(c) for c in config.country_codes])
    return (day_windows(week_days(weeks), config.window_hours)
            .withColumn("code", F.explode(codes))
            .select("day", "win", "window_start", "window_end", "code"))
