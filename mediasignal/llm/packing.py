"""Packing documents into sequences along a space-filling curve.

The counts of a document's token ids, hashed to ``BUCKETS`` places and brought
to length one, are projected to four numbers. Their cell on a Hilbert curve is
the document's key: documents near each other on the curve share vocabulary.
Documents are range-sorted by key, ties by a hash of the id, so a third of all
rows with one key still spreads over tasks. Each range is then cut every
``LENGTH`` ids, documents running over from one sequence into the next. What
is left at a range's end is cut into sequences whose lengths are powers of two,
which take no padding.

Defined cases: a null text is empty; every document has at least its end id.
Repeated rows and null ids are documents of their own. An empty table gives
an empty table; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediasignal.llm.common import whole_text
from mediasignal.llm.tokens import word_encoder
from mediasignal.session import staged

LENGTH = 4096
END_ID = 2
BUCKETS = 1024
DIMENSIONS, BITS = 4, 8
#: Ids that one task packs, about.
TASK_IDS = 8_000_000
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Positions on the Hilbert curve of points (rows of whole numbers below ``2 ** bits``), by Skilling's transform."""
    x, n = points.astype(np.int64).T.copy(), points.shape[1]
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            set_ = (x[i] & q) != 0
            t = np.where(set_, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(set_, p, t)
            x[i] ^= t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(t)
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def document_point(ids: np.ndarray) -> np.ndarray:
    """The document's cell: its hashed id counts, projected by fixed random signs."""
    counts = np.bincount((ids.astype(np.int64) * 2654435761 >> 7) % BUCKETS, minlength=BUCKETS)
    signs = _signs()
    at = counts @ signs / np.sqrt(float(counts @ counts) or 1.0)
    return np.clip((at + 2) / 4 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)


def _signs(made: list = []) -> np.ndarray:
    if not made:
        made.append(np.random.default_rng(11).choice([-1.0, 1.0], size=(BUCKETS, DIMENSIONS)))
    return made[0]


def encoded(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, key, tie, n, ids) of each document; ids are 16-bit numbers with the end id."""
    end = np.array([END_ID], dtype="<u2").tobytes()

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = word_encoder(tokenizer)
        for pdf in batches:
            ids = [encoder.encode(t) + end for t in pdf["data"]]
            points = [document_point(np.frombuffer(i, dtype="<u2")) for i in ids]
            keys = hilbert_keys(np.array(points)) if points else []
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "key": keys, "tie": pdf["tie"],
                                "n": [len(i) // 2 for i in ids], "ids": ids})

    rows = docs.select("doc_id", F.xxhash64("doc_id").alias("tie"), whole_text(F.col("text")).cast("binary").alias("data"))
    return rows.mapInPandas(encode, "doc_id long, key long, tie long, n long, ids binary")


def _cut(parts: list[tuple], sizes: list[int], sequence: int) -> list[tuple]:
    """Pieces of ``parts`` (doc_id, start, ids, doc_tokens) in sequences of the given sizes."""
    out, offset = [], 0
    size = sizes.pop(0)
    for doc_id, start, ids, total in parts:
        while len(ids):
            if offset == size:
                size, sequence, offset = sizes.pop(0), sequence + 1, 0
            now = ids[:size - offset]
            out.append((doc_id, start, len(now), zlib.crc32(now.astype("<u4").tobytes()), total, sequence, offset))
            start, offset, ids = start + len(now), offset + len(now), ids[len(now):]
    return out


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cuts the documents of one range, in order; holds the documents of one open sequence."""
    names = [c.split()[0] for c in PIECES.split(", ")]
    sequence, open_, held = (TaskContext.get().partitionId() << 40), [], 0
    for pdf in batches:
        out = []
        for doc_id, ids in zip(pdf["doc_id"].astype("Int64"), pdf["ids"]):
            ids = np.frombuffer(ids, dtype="<u2")
            open_.append((doc_id, 0, ids, len(ids)))
            held += len(ids)
            if held >= LENGTH:
                full, held = divmod(held, LENGTH)
                out += _cut(open_, [LENGTH] * full + [held], sequence)
                sequence += full
                open_ = []
                while out and out[-1][5] == sequence:  # the open sequence's part goes on
                    out.pop()
                if held:
                    open_.append((doc_id, len(ids) - held, ids[len(ids) - held:], len(ids)))
        yield _table(out, names)
    if held:
        sizes = [1 << b for b in range(LENGTH.bit_length(), -1, -1) if held >> b & 1]
        yield _table(_cut(open_, sizes, sequence), names)


def _table(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})


def packed(docs: DataFrame, tokenizer: str, task_ids: int = TASK_IDS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    ids = staged(encoded(docs, tokenizer), "ids")
    total = ids.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return (ids.repartitionByRange(max(1, -(-total // task_ids)), "key", "tie")
            .sortWithinPartitions("key", "tie", "doc_id").mapInPandas(_pack, PIECES))
