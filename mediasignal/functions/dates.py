"""Date expressions. All work on dates or zone-less timestamps, so the session
time zone has no effect."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def run_date(text: Column) -> Column:
    """``YYYY-MM-DD`` text to a date; other text is an error."""
    return F.to_date(text, "yyyy-MM-dd")


def week_start(day: Column) -> Column:
    return F.trunc(day, "week")


def week_end(day: Column) -> Column:
    return F.date_add(F.trunc(day, "week"), 6)


def compact(ts: Column) -> Column:
    return F.date_format(ts.cast("timestamp_ntz"), "yyyyMMddHHmmss")


def iso_day(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd'T'00:00:00.000'Z'")


def parse_lenient(value: Column) -> Column:
    """ISO date or timestamp text to a zone-less timestamp, null for anything else."""
    text = value.cast("string")
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text.try_cast("timestamp_ntz"))


def month_start(ts: Column) -> Column:
    return F.trunc(ts.cast("date"), "MM")


def month_iso(ts: Column) -> Column:
    return iso_day(month_start(ts))
