"""URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Network location: user info and port stay in.
_NETLOC = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"


def domain(url: Column, strip_www: bool = False) -> Column:
    """Lower-case network location, ``""`` if the text has none; never raises."""
    host = F.lower(F.coalesce(F.regexp_extract(url, _NETLOC, 1), F.lit("")))
    return F.regexp_replace(host, r"^www\.", "") if strip_www else host


def quote_plus(text: Column) -> Column:
    """Form encoding that keeps ``~`` and escapes ``*``."""
    encoded = F.url_encode(text)
    return F.replace(F.replace(encoded, F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def eligible(url: Column) -> Column:
    """Worth enriching: http(s), not a video page, ten characters or more."""
    ok = url.startswith("http") & ~F.lower(url).contains("video") & (F.length(url) >= 10)
    return F.coalesce(ok, F.lit(False))
