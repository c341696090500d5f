"""Token counts of whole texts by a SentencePiece model.

Ordinary texts are encoded whole. A huge text is cut into chunks that overlap,
so that many tasks share it: chunk ``i`` begins at ``i * CHUNK`` and runs
``overlap`` characters into the next. Each is encoded with offsets. Two
neighbours are spliced at the first stable boundary after the later one's
begin, which both must show: a place between two characters that stand side by
side in no piece of the vocabulary, so no merge ever crosses it and the pieces
on either side don't depend on each other. Where the overlap holds no such
place, or a chunk doesn't show it, the alignment fails and the whole text is
tried again with wider overlaps, at last with an overlap as long as the text.

The proof needs a model that merges pairs (BPE), leaves the text as it is and
writes each space as U+2581; ``load`` checks this, and for other models every
text is encoded whole.

Defined cases: a null text is empty and has no tokens. Repeated rows and null
ids are counted for themselves. An empty table gives an empty table; extra
columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediasignal.llm.common import whole_text
from mediasignal.session import staged

CHUNK, OVERLAP = 32_768, 512
#: Parts that a part of a text is cut into at once.
FAN = 64
LIMIT = 4096
SPACE = "▁"


class PieceModel:
    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())
                  if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i))]
        #: Pairs of characters that stand side by side in a piece.
        self.pairs = {p[i:i + 2] for p in pieces for i in range(len(p) - 1)}
        probe = "Ａ ﬁéé  x \n"
        self.plain = self.model.decode(self.model.encode(probe)) == probe

    def stable(self, text: str, at: int) -> bool:
        """Whether no merge can cross the place before character ``at``."""
        return text[at - 1:at + 1].replace(" ", SPACE) not in self.pairs

    def splice(self, text: str, begin: int, end: int) -> int:
        """The first stable place from ``begin`` on and before ``end``; -1 if there is none."""
        return next((i for i in range(max(begin, 1), min(end, len(text))) if self.stable(text, i)), -1)

    def begins(self, text: str) -> list[int]:
        """The character at which each token begins."""
        at, found = 0, []
        for piece in self.model.encode(text, return_type="proto").pieces:
            found.append(at)
            at += len(piece.surface)
        return found

    def chunk(self, text: str, first: bool, last: bool, size: int) -> int:
        """Tokens between the chunk's two splices; -1 if one of them isn't found or isn't shown."""
        low = 0 if first else self.splice(text, 1, len(text))
        high = len(text) if last else self.splice(text, size + 1, len(text))
        if low < 0 or high < 0:
            return -1
        begins = self.begins(text)
        if not first and low not in begins or not last and high not in begins:
            return -1
        return sum(low <= b < high for b in begins)


@functools.cache
def load(path: str) -> PieceModel:
    """One model for each Python worker."""
    return PieceModel(path)


def whole_counts(text: Column, path: str) -> Column:
    @F.pandas_udf("long")
    def compute(texts: pd.Series) -> pd.Series:
        model = load(path).model
        return pd.Series([len(model.encode(t)) for t in texts], dtype="int64")

    return compute(text)


def _chunk_counts(path: str):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load(path)
        for pdf in batches:
            pdf["n"] = [model.chunk(*row) for row in zip(pdf["part"], pdf["first"], pdf["last"], pdf["size"])]
            yield pdf[["row", "n"]]

    return count


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit."""
    rows = docs.select("doc_id", whole_text(F.col("text")).alias("text")).withColumn("n_bytes", F.octet_length("text").cast("long"))
    short = rows.where(F.length("text") <= chunk).select("doc_id", "n_bytes", whole_counts(F.col("text"), path).alias("n_tokens"))
    counted = short.unionByName(_huge_counts(rows.where(F.length("text") > chunk), path, chunk, overlap))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _chunks(texts: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(row, part, first, last): chunks of the texts (row, text), each with ``overlap`` characters of the next one.

    Reaching a place in a text takes time in proportion to what stands before
    it, so a text is cut into large parts first, those into smaller ones, and
    these into chunks.
    """
    parts, of_parent = texts.select("row", F.col("text").alias("part"), F.lit(True).alias("first"), F.lit(True).alias("last")), 0
    for size in (chunk * FAN * FAN, chunk * FAN, chunk):
        # The parent's own characters, without those of its neighbour.
        own = f"if(last, length(part), {of_parent})"
        parts = parts.select("row", F.explode(F.expr(f"""transform(array(bigint({own})), own -> transform(
            sequence(0L, (own - 1) div {size}), i -> struct(
                substring(part, cast(i * {size} + 1 as int), {min(size + overlap, 2**31 - 1)}) as part, first and i = 0 as first,
                last and (i + 1) * {size} >= own as last)))[0]""")).alias("c")).select("row", "c.*")
        of_parent = size
    return parts


def _huge_counts(rows: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    # Rows of one id and text have one count; the key stands for the row when chunks come together again.
    key = F.sha2(F.col("text").cast("binary"), 256)
    todo = rows.withColumn("row", key)
    sizes = staged(todo.select("doc_id", "n_bytes", "row"), "huge")
    left = todo.select("row", "text").dropDuplicates(["row"])
    done = None
    while True:
        if not load(path).plain:
            found = left.select("row", whole_counts(F.col("text"), path).alias("n"))
            return sizes.join(found.withColumnRenamed("n", "n_tokens"), "row").select("doc_id", "n_bytes", "n_tokens")
        parts = _chunks(left, chunk, overlap).withColumn("size", F.lit(chunk))
        # Dealt out anew, so that the chunks of one text run side by side.
        counts = staged(parts.repartition(F.xxhash64("row", "part")).mapInPandas(_chunk_counts(path), "row string, n long")
                        .groupBy("row").agg(F.min("n").alias("least"), F.sum("n").alias("n")), "chunks")
        good = counts.where("least >= 0").select("row", F.col("n").alias("n_tokens"))
        done = good if done is None else done.unionByName(good)
        if counts.where("least < 0").isEmpty():
            return sizes.join(done, "row").select("doc_id", "n_bytes", "n_tokens")
        left = left.join(counts.where("least < 0").select("row"), "row", "left_semi")
        chunk, overlap = 4 * chunk, 4 * overlap
