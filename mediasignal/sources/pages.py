"""Landed article pages: ``url, status, html``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediasignal.functions.html import add_main_text
from mediasignal.operators.dedupe import keep_first
from mediasignal.operators.membership import key_filter, may_hold

#: Blocks of the filter of wanted URLs, 4 KB each: 16 MB, at which 13 million URLs let 2 % of the other pages pass.
FILTER_BLOCKS = 4096


def one_page_per_url(pages: DataFrame) -> DataFrame:
    """The best landing of each URL: lowest status first, then the smaller MD5 of the text."""
    order = [F.col("status").asc_nulls_last(), F.md5(F.col("text").cast("binary")).asc_nulls_last()]
    return keep_first(pages.where(F.col("URL").isNotNull()), "URL", order)


def page_texts(pages: DataFrame) -> DataFrame:
    """``URL, page_ok, text_full`` with one row per landed URL.

    The text is extracted before any shuffle, so the markup never travels.
    """
    landed = pages.select(
        F.col("url").alias("URL"), "status",
        F.when(F.col("status") < 400, F.col("html")).alias("html"))
    texts = add_main_text(landed, "html", "text")
    return one_page_per_url(texts.select("URL", "status", "text")).select(
        "URL", F.coalesce(F.col("status") < 400, F.lit(False)).alias("page_ok"),
        F.col("text").alias("text_full"))


def pages_of(pages: DataFrame, wanted: DataFrame) -> DataFrame:
    """Landed pages of the ``wanted`` URLs, a table shown to be small.

    A week's articles against years of landed pages: the others are dropped
    while scanning, before any markup is worked on.
    """
    keys = wanted.select(F.col("URL").alias("url")).distinct()
    return pages.join(F.broadcast(keys), "url", "left_semi")


def join_pages(articles: DataFrame, pages: DataFrame, wanted: DataFrame | None = None,
               filter_blocks: int = FILTER_BLOCKS) -> DataFrame:
    """Articles with their page text; without a usable page ``page_ok`` is false.

    A merge join: the texts grow with the data, so they are never broadcast, and
    the joined partitions are sized by the bytes of both sides. A Bloom filter of
    the URLs in ``wanted`` (by default the articles) keeps most other pages from
    being worked on and shuffled, however many articles there are; with 0 blocks
    there is none.
    """
    if filter_blocks:
        keys = key_filter(articles if wanted is None else wanted, "URL", filter_blocks)
        pages = may_hold(pages, "url", keys, filter_blocks)
    return join_texts(articles, page_texts(pages))


def join_texts(articles: DataFrame, texts: DataFrame) -> DataFrame:
    """Articles with their row of ``texts``, which ``page_texts`` made; it may be stored by URL, in the buckets of the articles."""
    return (articles.join(texts.hint("merge"), "URL", "left")
            .withColumn("page_ok", F.coalesce(F.col("page_ok"), F.lit(False)))
            .withColumn("text_full", F.when(F.col("page_ok"), F.col("text_full")).otherwise("")))
