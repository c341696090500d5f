"""Near-duplicates by SimHash, linked through per-segment bit counts.

A fingerprint has 64 bits over hashed word shingles. Its embedding is the
number of set bits in each of 32 segments of two bits: two fingerprints that
differ in at most two bits are at most two apart in Manhattan distance, a lower
bound of the Hamming distance. Both then lie within one of some common grid
point, so each fingerprint enters the cells of its own point and of its direct
neighbours, and only fingerprints that share a cell are compared bit by bit.

Equal fingerprints are merged first. A cell hands on a spanning forest of its
links, never its pairs. The members of a cell with over ``CELL_ROWS``
fingerprints take an exact other way: each is tied to all words within one bit
of it, and fingerprints that share such a word, at most 65, are those within
two bits of each other.

Defined cases: a null or blank text has fingerprint zero and links like any
other. Null ids lose against any other id; a group with none but null ids has a
null ``component_id``. Repeated rows get equal results. Empty tables give empty
tables; extra columns are ignored or, in ``drop_near_copies``, passed through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediasignal.llm.common import fresh, whole_text, word_blocks
from mediasignal.llm.components import connected_components
from mediasignal.session import staged

SHINGLE_WORDS = 3
SEED = 42
SEGMENTS = 32
#: Fingerprints of one cell that are compared pair by pair; those of a fuller cell take the other way.
CELL_ROWS = 128
_HASHES = 1 << 15


def _bit_counts(hashes: list[int]) -> np.ndarray:
    bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8), bitorder="little")
    return bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)


def fingerprint(data: bytes, words_each: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """SimHash of a UTF-8 text as a signed 64-bit number."""
    counts, total, hashes, tail = np.zeros(64, dtype=np.int64), 0, [], []
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for words in word_blocks(data.lower()):
        words = tail + words
        hashes += [digest(join(g), seed) for g in zip(*(words[i:] for i in range(words_each)))]
        tail = words[1 - words_each:] if words_each > 1 else []
        if len(hashes) >= _HASHES:
            counts, total, hashes = counts + _bit_counts(hashes), total + len(hashes), []
    if not total and not hashes and tail:
        hashes = [digest(join(tail), seed)]
    if hashes:
        counts, total = counts + _bit_counts(hashes), total + len(hashes)
    value = int.from_bytes(np.packbits(2 * counts > total, bitorder="little").tobytes(), "little", signed=True)
    return value if total else 0


def text_fingerprint(text: Column, words_each: int = SHINGLE_WORDS) -> Column:
    @F.pandas_udf("long")
    def compute(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words_each) for t in texts], dtype="int64")

    return compute(whole_text(text).cast("binary"))


def _cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The grid points within one of each fingerprint's point, as numbers in base 3."""
    power = 3 ** np.arange(SEGMENTS, dtype=np.int64)
    for pdf in batches:
        fp = pdf["fp"].to_numpy(dtype=np.int64)
        bits = np.unpackbits(fp.astype("<i8").view(np.uint8), bitorder="little").reshape(-1, SEGMENTS, 64 // SEGMENTS)
        point = bits.sum(axis=2, dtype=np.int64)
        own = point @ power
        up = np.where(point < 64 // SEGMENTS, own[:, None] + power, -1)
        down = np.where(point > 0, own[:, None] - power, -1)
        cells = np.concatenate([own[:, None], up, down], axis=1)
        rows, columns = np.nonzero(cells >= 0)
        yield pd.DataFrame({"cell": cells[rows, columns], "fp": fp[rows]})


def _forest(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that connect what is within ``distance`` bits: each member but one to an earlier one."""
    bits = fps.view(np.uint64)  # of signed numbers, numpy counts the bits of the absolute value
    near = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= distance
    left, links = np.ones(len(fps), dtype=bool), []
    for start in range(len(fps)):
        if left[start]:
            left[start], edge = False, [start]
            while edge:
                at = edge.pop()
                new = np.flatnonzero(near[at] & left)
                left[new] = False
                links += [(int(fps[at]), int(fps[i])) for i in new]
                edge += new.tolist()
    return links


def _cell_links(distance: int, most: int):
    """Links of cells that arrive sorted; the members of a fuller cell come with a null partner."""

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held_cell, held, crowded = None, np.zeros(0, dtype=np.int64), False
        for pdf in batches:
            cell, fp = pdf["cell"].to_numpy(), pdf["fp"].to_numpy()
            ends = np.append(np.flatnonzero(np.diff(cell)) + 1, len(cell))
            starts, out, alone = np.append(0, ends[:-1]), [], []
            for a, b in zip(starts.tolist(), ends.tolist()):
                if cell[a] != held_cell:
                    if len(held) > 1:
                        out += _forest(held, distance)
                    held_cell, held, crowded = cell[a], np.zeros(0, dtype=np.int64), False
                    if b - a == 1 and b < len(cell):
                        continue
                if not crowded and len(held) + b - a <= most:
                    held = np.append(held, fp[a:b])
                else:
                    alone += [held, fp[a:b]]
                    held, crowded = np.zeros(0, dtype=np.int64), True
            table = pd.DataFrame(out, columns=["u", "v"], dtype="Int64")
            if alone:
                table = pd.concat([table, pd.DataFrame({
                    "u": pd.array(np.concatenate(alone), dtype="Int64"),
                    "v": pd.array([pd.NA] * sum(map(len, alone)), dtype="Int64")})])
            yield table
        if len(held) > 1:
            yield pd.DataFrame(_forest(held, distance), columns=["u", "v"], dtype="Int64")

    return links


def fingerprint_links(fps: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Edges (u, v) whose components are those of all pairs of ``fps`` (fp) at two or fewer differing bits."""
    cells = fps.select("fp").mapInPandas(_cells, "cell long, fp long")
    found = staged(cells.repartition("cell").sortWithinPartitions("cell", "fp")
                   .mapInPandas(_cell_links(2, cell_rows), "u long, v long").distinct(), "links")
    crowded = found.where("v is null").select("u")
    near = crowded.select("u", F.explode(F.expr(
        "array_append(transform(sequence(0, 63), i -> u ^ shiftleft(1L, i)), u)")).alias("word"))
    # At most 65 fingerprints lie within one bit of a word.
    first = near.groupBy("word").agg(F.min("u").alias("v"))
    stars = near.join(first, "word").where("u <> v").select("u", "v").distinct()
    return found.where("v is not null").unionByName(stars)


def _labelled(prints: DataFrame, links_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(fp, root, component_id) of each fingerprint in ``prints`` (doc_id, fp); root is the component's smallest fp."""
    each = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprints")
    roots = connected_components(links_of(each)).withColumnRenamed("node", "fp")
    members = each.join(roots, "fp")
    best = members.groupBy("root").agg(F.min("first_id").alias("component_id"))
    linked = members.join(best, "root").select("fp", "root", "component_id")
    # Stored, so that the joins with it are plain ones, whose hot fingerprints Spark splits.
    return staged(each.join(linked, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"),
        F.when(F.col("root").isNull(), F.col("first_id")).otherwise(F.col("component_id")).alias("component_id")), "labels")


def near_copies(docs: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per document: doc_id, fingerprint (hex), component_id (the smallest doc_id that links reach)."""
    prints = staged(docs.select("doc_id", text_fingerprint(F.col("text")).alias("fp")), "prints")
    return prints.join(_labelled(prints, lambda each: fingerprint_links(each, cell_rows)), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_copies(docs: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """The columns of ``docs`` and one row of each component, that with the smallest doc_id."""
    (fp,) = fresh(docs, "fp")
    texts = staged(docs.withColumn(fp, text_fingerprint(F.col("text"))), "printed")
    return drop_linked(texts, fp, lambda each: fingerprint_links(each, cell_rows)).select(*docs.columns)


def drop_linked(texts: DataFrame, fp: str, links_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """One row of each component of ``texts``, whose column ``fp`` holds the nodes that ``links_of`` gives edges of."""
    other, gone, group = fresh(texts, "fp_of_group", "id_that_goes", "component")
    prints = texts.select("doc_id", F.col(fp).alias("fp"))
    ids = staged(prints.groupBy("fp", "doc_id").agg(F.count(F.lit(1)).alias("n"))
                 .join(_labelled(prints, links_of), "fp")
                 .withColumn("stays", F.col("doc_id").eqNullSafe(F.col("component_id"))), "decided")
    goes = ids.where("not stays").select(F.col("fp").alias(other), F.col("doc_id").alias(gone))
    kept = texts.join(goes, (F.col(fp) == F.col(other)) & F.col("doc_id").eqNullSafe(F.col(gone)), "left_anti")
    # Rows that share the smallest id of one component; as a rule there are none.
    again = ids.where("stays").groupBy("root").agg(F.sum("n").alias("n")).where("n > 1")
    again = staged(ids.where("stays").join(again.select("root"), "root")
                   .select(F.col("fp").alias(other), F.col("root").alias(group)).distinct(), "again")
    if not again.isEmpty():
        same = F.col(fp) == F.col(other)
        one = kept.join(again, same).drop(other).dropDuplicates([group]).drop(group)
        kept = kept.join(again, same, "left_anti").unionByName(one)
    return kept
