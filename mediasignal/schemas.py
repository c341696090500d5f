"""Declared schemas of the stage tables."""

from pyspark.sql.types import (
    DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
    VariantType,
)


def _strings(*names):
    return [StructField(n, StringType()) for n in names]


# One landed reply to a search request.
RESPONSE = StructType([
    StructField("ord", LongType()),
    StructField("day", DateType()),
    StructField("win", IntegerType()),
    StructField("code", StringType()),
    StructField("status", IntegerType()),
    StructField("body", StringType()),
])

# The fields that are read from each entry of a reply's list ``articles``.
HIT = StructType([
    StructField("url", StringType()),
    StructField("title", StringType()),
    StructField("sourcecountry", StringType()),
    StructField("themes", VariantType()),
])

ARTICLES_RAW = StructType(_strings("Date", "Title", "URL", "Domain", "Country", "Keywords"))

PAGES = StructType([
    StructField("url", StringType()),
    StructField("status", IntegerType()),
    StructField("html", StringType()),
])

ARTICLES_ENRICHED = StructType(
    _strings("URL", "Date", "Title", "Country", "Domain", "Keywords",
             "Translated Title", "Translated Text", "Language", "Model Sentiment Label")
    + [StructField("Model Sentiment Score", DoubleType())]
    + _strings("Enriched Keywords", "Enriched Domain")
)

COUNTRY_MONTH = StructType(
    _strings("Year-Month", "COUNTRY")
    + [StructField(n, LongType()) for n in ("article_count", "pos_count", "neg_count", "neu_count")]
    + _strings("majority_sentiment", "avg_sentiment_label")
    + [StructField("avg_sentiment", DoubleType())]
)

# Columns the enrichment adds to a base row, in output order.
ENRICHED_COLUMNS = [f.name for f in ARTICLES_ENRICHED.fields[6:]]
