"""Search hits to article rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediasignal.functions import dates, text, themes, urls


def reply_object(status: Column, body: Column) -> Column:
    """The body of a reply with status 200 as a variant, null unless it is a JSON object.

    The parsed body is bound as the item of a list, so it is parsed once however often it is looked at.
    """
    parsed = F.array(F.when(status == 200, F.try_parse_json(body)))
    return F.transform(parsed, lambda p: F.when(F.schema_of_variant(p).startswith("OBJECT"), p))[0]


def usable_responses(responses: DataFrame) -> DataFrame:
    """Replies with status 200 whose body is a JSON object."""
    return responses.where(reply_object(F.col("status"), F.col("body")).isNotNull())


def drop_empty_url(hits: DataFrame) -> DataFrame:
    """Strip the URL and drop hits that have none."""
    return hits.withColumn("url", text.strip(F.col("url"))).where(F.col("url") != "")


def article_rows(hits: DataFrame) -> DataFrame:
    """Hits (``day, win, code, ord, pos`` and the reply's fields) as article rows.

    ``Date`` is the day asked for. The order columns are kept for ``keep_first``.
    """
    return hits.select(
        dates.iso_day(F.col("day")).alias("Date"),
        F.coalesce(F.col("title"), F.lit("")).alias("Title"),
        F.col("url").alias("URL"),
        urls.domain(F.col("url")).alias("Domain"),
        text.default_text(F.col("sourcecountry"), "Unknown").alias("Country"),
        themes.themes_text(F.col("themes")).alias("Keywords"),
        "day", "win", "code", "ord", "pos",
    )
