"""First stage: landed search replies to unique articles."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediasignal.functions import dates
from mediasignal.operators.articles import article_rows, drop_empty_url
from mediasignal.operators.dedupe import keep_first
from mediasignal.schemas import ARTICLES_RAW
from mediasignal.sources.responses import hits

# Which hit of a URL is the first one.
FIRST = ("Date", "win", "code", "ord", "pos")


def replies_of_week(responses: DataFrame, run_date: date | None = None) -> DataFrame:
    """All landed replies, or those asked for the week that holds ``run_date``."""
    if run_date is None:
        return responses
    day = F.lit(run_date.isoformat()).cast("date")
    return responses.where(F.col("day").between(dates.week_start(day), dates.week_end(day)))


def found_articles(responses: DataFrame, run_date: date | None = None) -> DataFrame:
    """Article rows, copies included, of all landed replies or of one week."""
    return article_rows(drop_empty_url(hits(replies_of_week(responses, run_date))))


def collect(responses: DataFrame, run_date: date | None = None) -> DataFrame:
    """Unique articles of all landed replies, or of the week that holds ``run_date``."""
    return keep_first(found_articles(responses, run_date), "URL", FIRST).select(*ARTICLES_RAW.fieldNames())
