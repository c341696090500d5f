"""A Bloom filter over the keys of a table: built by Spark, broadcast, and asked where other rows are read.

Each key sets ``PROBES`` bits of one block of ``BLOCK_BITS``, the size of Spark's bitmap
aggregate, so the filter is a table with one row per block and asking it is one
broadcast join. Its size is fixed by the number of blocks whatever the number of
keys: too many keys let more other rows pass, but never lose one of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS, PROBES = 32_768, 3


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bits(key: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(BLOCK_BITS)) for i in range(PROBES)]


def key_filter(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, bitmap) of the values of ``key``; at most ``blocks`` rows of 4 KB. Nulls set nothing."""
    named = keys.select(F.col(key).alias("key")).where(F.col("key").isNotNull())
    bits = named.select(_block(F.col("key"), blocks).alias("block"), F.explode(F.array(*_bits(F.col("key")))).alias("bit"))
    return bits.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bitmap"))


def may_hold(rows: DataFrame, key: str, keys: DataFrame, blocks: int) -> DataFrame:
    """``rows`` (all columns) without most of those whose ``key`` is not in the filter ``keys``."""
    block, bitmap = "_block_of_filter", "_bitmap_of_filter"
    asked = rows.join(F.broadcast(keys.toDF(block, bitmap)), _block(F.col(key), blocks) == F.col(block))
    for bit in _bits(F.col(key)):
        byte = F.conv(F.hex(F.substring(F.col(bitmap), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        asked = asked.where(F.call_function("getbit", byte, F.pmod(bit, F.lit(8)).cast("int")) == 1)
    return asked.drop(block, bitmap)
