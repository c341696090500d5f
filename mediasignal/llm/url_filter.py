"""URL rules by hashed host-suffix and path-prefix expressions.

A rule is a host and the beginning of a path. A URL is expanded into its
expressions, each suffix of its host at a dot with each beginning of its path
that is as long as some rule's path. Expressions meet rules in an equi-join on
the first four bytes of their SHA-256; the full digest confirms the match, and
the longest rule decides. Distinct URLs are judged once.

Defined cases: a null URL and one without ``://`` have an empty host and path
and match no rule. An empty path begins with no rule's ``/``. Rules with a null
part or verdict are ignored; of rules with equal host and path, ``block`` wins.
URLs without a rule get ``default``. Repeated rows get equal verdicts; empty
tables give empty tables; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX_HEX = 8
#: Distinct lengths of rule paths, at most; they become a list in the plan.
PATH_LENGTHS = 1000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    # Neither part of a URL holds a question mark.
    return F.sha2(F.concat(host, F.lit("?"), path).cast("binary"), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """One row per page: page_id, host, path, rule (host and path of the longest that fits), verdict."""
    usable = rules.select(F.translate("host", UPPER, LOWER).alias("host"), "path", "verdict").dropna()
    usable = usable.groupBy("host", "path").agg(F.max(F.col("verdict") == "block").alias("block"))
    lengths = [r[0] for r in usable.select(F.length("path")).distinct().limit(PATH_LENGTHS + 1).collect()]
    if len(lengths) > PATH_LENGTHS:
        raise ValueError(f"rule paths have more than {PATH_LENGTHS} different lengths")
    rule = usable.select(F.concat("host", "path").alias("rule"), "block",
                         F.length("host").alias("host_length"), F.length("path").alias("path_length"),
                         _digest(F.col("host"), F.col("path")).alias("rule_digest")).withColumn(
        "rule_prefix", F.substring("rule_digest", 1, PREFIX_HEX))

    url = F.col("url")
    urls = pages.select("url").where(url.isNotNull()).distinct().select(
        "url", host_of(url).alias("host"), path_of(url).alias("path"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    starts = F.filter(F.array(*(F.lit(n) for n in sorted(lengths))) if lengths else F.array().cast("array<int>"),
                      lambda n: n <= F.length("path"))
    expressions = (urls.where(F.instr(url, "://") > 0)
                   .select("url", "path", F.explode(suffixes).alias("suffix"), starts.alias("starts"))
                   .select("url", "suffix", F.expr("explode(transform(starts, n -> left(path, n)))").alias("start"))
                   .select("url", _digest(F.col("suffix"), F.col("start")).alias("digest"))
                   .withColumn("prefix", F.substring("digest", 1, PREFIX_HEX)))
    found = expressions.join(rule, F.col("prefix") == F.col("rule_prefix")).where("digest = rule_digest")
    best = found.groupBy("url").agg(F.max(F.struct(
        (F.col("host_length") + F.col("path_length")).alias("length"), "host_length", "block", "rule")).alias("best"))
    judged = best.select(F.col("url").alias("judged_url"), F.col("best.rule").alias("rule"),
                         F.when(F.col("best.block"), "block").otherwise("allow").alias("ruled"))
    return (pages.select("page_id", url.cast("string").alias("url"))
            .join(judged, F.col("url") == F.col("judged_url"), "left")
            .select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), "rule",
                    F.coalesce("ruled", F.lit(default)).alias("verdict")))
