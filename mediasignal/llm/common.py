"""Small helpers that the operators share."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediasignal.session import staged

#: The six ASCII white-space characters, the same that ``bytes.split()`` splits on.
SPACES = r"[\x20\x09-\x0D]+"
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names made from ``names`` that ``df`` doesn't have, whatever the case of its letters."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def whole_text(column: Column) -> Column:
    """The text; a null counts as empty."""
    return F.coalesce(column.cast("string"), F.lit(""))


def word_blocks(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """All words of ``data``, in lists that cover about ``size`` bytes each, so that a huge text needs little memory."""
    start = 0
    while start < len(data):
        end = start + size
        if end < len(data):
            space = _SPACE.search(data, end)
            end = space.start() if space else len(data)
        yield data[start:end].split()
        start = end


def placed(rows: DataFrame, by: list, name: str) -> DataFrame:
    """The stored ``rows`` in the order ``by`` over all partitions, with their ``place`` in it, gapless from 0.

    One range shuffle; the driver gets one count per partition. Rows that are
    equal in ``by`` should be equal in all that the result uses.
    """
    order = staged(rows.repartitionByRange(*by).sortWithinPartitions(*by)
                   .withColumn("place", F.monotonically_increasing_id()), name)
    # That number is the partition's, shifted by 33 bits, plus the row's place in the partition.
    part = F.shiftright("place", 33)
    before, seen = [], 0
    for r in sorted(order.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()):
        before.append((r.part, seen - (r.part << 33)))
        seen += r.n
    shift = F.broadcast(rows.sparkSession.createDataFrame(before, "part long, shift long"))
    return order.join(shift, part == F.col("part")).withColumn("place", F.col("place") + F.col("shift")).drop("part", "shift")
