"""Landed search replies: one row per request with the reply's status and body."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mediasignal import schemas
from mediasignal.operators.articles import reply_object


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RESPONSE).json(path)


def hits(responses: DataFrame) -> DataFrame:
    """One row per search hit with its place ``pos`` in the reply.

    Failed replies, bodies that are not a JSON object and empty lists give no
    rows; a list entry that is not an object is left out, the others stay.
    """
    listed = responses.select("ord", "day", "win", "code", F.posexplode_outer(F.try_variant_get(
        reply_object(F.col("status"), F.col("body")), "$.articles", "array<variant>")).alias("pos", "_a"))
    # An outer explode, because a plain one would parse the body again to test the list before it is taken apart.
    return listed.where(F.schema_of_variant("_a").startswith("OBJECT")).select(
        "ord", "day", "win", "code", "pos",
        *[F.try_variant_get("_a", f"$.{f.name}", f.dataType.simpleString()).alias(f.name) for f in schemas.HIT.fields])
