"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Keys lie on a ring in the order of the MD5 of their id. Each shard owns ``VNODES``
points there, by the MD5 of its number and the point's; a key belongs to the
shard of the next point clockwise. No shard takes more than its share of the
rows, so that any two counts differ by one at most (the law ``rows``): the first
``rows mod shards`` shards have room for one more. Keys that find a shard full go
on clockwise to the next other one. With many points few keys have to, so one
more shard moves little more than the rows that it takes.

Points are on ``CELLS`` places of the ring, so all keys between two occupied
places, an arc, meet the shards in one order, and the overflow is settled for
arcs instead of keys: in round ``r`` each arc offers what it has left to the
``r``-th shard clockwise, which takes offers in ring order while it has room. That
needs the count of each arc, ``shards * VNODES + 1`` numbers at most, however many
rows there are. It gives pieces of arcs, each with its shard and first slot. One
range shuffle of the slim rows numbers them along the ring, and a row takes
shard and slot from the piece that its number lies in.

All steps are column expressions, windows and joins. Broadcast are the places'
arcs (``CELLS`` rows) and the pieces (an arc has one for each round at most).

Defined cases: null texts have no bytes, null ids hash like an empty text.
The key of a row is its id; rows of one id are neighbours on the ring, ordered
by size, checksum and then as stored, and may be split between shards when there
are many. Equal texts are not held together. Empty tables give empty tables,
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mediasignal.llm.common import placed, whole_text
from mediasignal.session import staged

SHARDS, VNODES = 16, 512
#: Places of the ring on which points lie: the first four hex digits of a digest.
CELLS, _DIGITS = 1 << 16, 4


def _cell(spot: str) -> Column:
    return F.expr(f"cast(conv(substring({spot}, 1, {_DIGITS}), 16, 10) as int)")


def ring(spark: SparkSession, shards: int = SHARDS, vnodes: int = VNODES) -> tuple[DataFrame, DataFrame]:
    """(cell, arc) of each place, and (arc, shards) of each arc: the shards clockwise. Both depend on the counts alone."""
    points = spark.range(shards * vnodes).selectExpr(f"cast(id % {shards} as int) as shard", f"id div {shards} as point").select(
        "shard", F.md5(F.concat_ws(":", "shard", "point").cast("binary")).alias("spot")).withColumn("cell", _cell("spot"))
    occupied = points.select("cell").distinct()
    # What lies ahead is looked up backwards: a frame that only grows costs one step a row.
    ahead = Window.orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, 0)
    # Places after the last point are an arc of their own, with the shards of the first.
    cells = spark.range(CELLS).select(F.col("id").cast("int").alias("cell")).join(
        occupied.select("cell", F.col("cell").alias("end")), "cell", "left").select(
        "cell", F.coalesce(F.min("end").over(ahead), F.lit(CELLS)).alias("arc"))
    ends = occupied.select(F.col("cell").alias("arc")).unionByName(spark.range(1).select(F.lit(CELLS).alias("arc")))
    starts = ends.select("arc", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")).select(
        "shard", "arc", F.expr(f"case when arc < {CELLS} then lpad(lower(hex(arc)), {_DIGITS}, '0') else '' end").alias("place"))
    along = points.select("shard", F.lit(None).cast("int").alias("arc"), F.col("spot").alias("place"), "spot").unionByName(
        starts.withColumn("spot", F.lit(None).cast("string")))
    later = Window.partitionBy("shard").orderBy(F.desc("place")).rowsBetween(Window.unboundedPreceding, 0)
    first = F.min("spot").over(Window.partitionBy("shard"))
    met = along.select("shard", "arc", F.coalesce(F.last("spot", ignorenulls=True).over(later), F.concat(F.lit("~"), first))
                       .alias("spot")).where("arc is not null")
    arcs = met.groupBy("arc").agg(F.array_sort(F.collect_list(F.struct("spot", "shard"))).alias("met")).select(
        "arc", F.col("met.shard").alias("shards"))
    return cells, arcs


def _settled(arcs: DataFrame, rows: int, shards: int) -> DataFrame:
    """(arc, shard, low, high, shift) of each piece: places ``low`` to ``high`` of the ring take ``shard``, and slot place + shift."""
    room = [rows // shards + (s < rows % shards) for s in range(shards)]
    begin = F.sum("rows").over(Window.orderBy("arc")) - F.col("rows")  # over the arcs, a bounded list
    left, taken = staged(arcs.withColumn("low", begin), "arcs"), []
    for turn in range(shards):
        offered = left.select("*", F.col("shards")[turn].alias("shard")).withColumn(
            "before", F.sum("rows").over(Window.partitionBy("shard").orderBy("arc")) - F.col("rows"))
        free = F.element_at(F.array(*(F.lit(r).cast("long") for r in room)), F.col("shard") + 1) - F.col("before")
        offered = staged(offered.withColumn("take", F.greatest(F.lit(0), F.least("rows", free)))
                         .withColumn("turn", F.lit(turn)).drop("before").coalesce(1), "offers")
        taken.append(offered.where("take > 0").select("turn", "arc", "shard", "low", "take"))
        for r in offered.groupBy("shard").agg(F.sum("take").alias("n")).collect():  # a row per shard
            room[r.shard] -= r.n
        if not any(room):
            break
        left = offered.where("rows > take").select(
            "arc", (F.col("rows") - F.col("take")).alias("rows"), "shards", (F.col("low") + F.col("take")).alias("low"))
    pieces = taken[0]
    for more in taken[1:]:
        pieces = pieces.unionByName(more)
    slot = F.sum("take").over(Window.partitionBy("shard").orderBy("turn", "arc")) - F.col("take")
    return staged(pieces.select("arc", "shard", "low", (F.col("low") + F.col("take")).alias("high"), (slot - F.col("low")).alias("shift"))
                  .coalesce(1), "pieces")


def shard_rows(docs: DataFrame, shards: int = SHARDS, vnodes: int = VNODES) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    cells, arcs = ring(docs.sparkSession, shards, vnodes)
    slim = docs.select(
        "doc_id", (F.octet_length(whole_text(F.col("text"))) + 1).cast("long").alias("size"),
        F.crc32(whole_text(F.col("text")).cast("binary")).alias("text_crc32"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("spot"))
    # The row's number parts the rows of an id that is in many of them; stored, it stays the same whatever is run again.
    slim = staged(slim.withColumn("cell", _cell("spot")).join(F.broadcast(cells), "cell").withColumn(
        "row", F.monotonically_increasing_id()).drop("cell"), "slim")
    counts = slim.groupBy("arc").agg(F.count(F.lit(1)).alias("rows"))
    arcs = staged(arcs.join(counts, "arc"), "counted")
    rows = arcs.agg(F.sum("rows")).first()[0] or 0
    pieces = _settled(arcs, rows, shards)
    along = placed(slim, ["arc", "spot", "doc_id", "size", "text_crc32", "row"], "along")
    found = along.join(F.broadcast(pieces.withColumnRenamed("arc", "arc_of_piece")), F.expr(
        "arc = arc_of_piece and place >= low and place < high"))
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                        (F.col("place") + F.col("shift")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
