"""Translation: titles in one piece, bodies in chunks.

The default replaces words and phrases by a dictionary; ``translate_batch`` plugs in
a model or service as a function from a list of texts to a list of texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediasignal.config import PipelineConfig
from mediasignal.functions import text as tx
from mediasignal.operators.lookup import entries, lookup_join
from mediasignal.operators.phrases import best_cover, phrase_runs, replace_runs
from mediasignal.session import staged

RETRIES = 2


def add_translation(df: DataFrame, key: str, text: str, out: str, config: PipelineConfig,
                    chunked: bool = True, source: DataFrame | None = None) -> DataFrame:
    """Add the English form of column ``text``.

    A chunk that cannot be translated stays as it was; chunks are joined with
    one space. Without ``chunked`` the text is one piece, as for titles. A
    missing text gives ``""`` and costs nothing. Where entries are phrases (words
    with single spaces between), a piece is cut into the entries that cover most of
    its words, of such cuts the one with fewest entries (``phrases.best_cover``);
    words outside stay as they are. With a joined dictionary the words are taken
    from ``source``: the same keys and texts as ``df``, but cheaper to compute (by
    default ``df`` itself).
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    pieces = tx.chunks(whole, config.chunk_chars) if chunked else F.array(whole)
    if config.translate_batch is not None:
        translated = batch_translator(config.translate_batch)(pieces)
        return df.withColumn(out, tx.rejoin(translated))
    lexicon = entries(config.lexicon, ("src", "dst"), config, df.sparkSession)
    if isinstance(lexicon, DataFrame):
        return _by_join(df, source or df, key, pieces, out, lexicon, config)
    words: dict[str, str] = {}
    for src, dst in lexicon:
        words[src] = min(dst, words.get(src, dst))
    if not words:
        return df.withColumn(out, tx.rejoin(pieces))
    literal = F.create_map(*[F.lit(x) for pair in words.items() for x in pair])
    if any(" " in src for src in words):
        return df.withColumn(out, tx.rejoin(each_piece(pieces, _phrases_in_row(words, literal))))

    def word(w: Column) -> Column:
        return F.when(w.isin(list(words)), literal[w]).otherwise(w)

    return df.withColumn(out, tx.rejoin(each_piece(pieces, lambda p: replace_words(p, word))))


def each_piece(pieces: Column, translated: Callable[[Column], Column]) -> Column:
    """The pieces, cut once, each translated or as it was."""
    return tx.bind(pieces, lambda cut: F.zip_with(F.transform(cut, translated), cut, or_as_it_was))


def replace_words(piece: Column, word: Callable[[Column], Column]) -> Column:
    """Apply ``word`` to what stands between single spaces."""
    return F.array_join(F.transform(F.split(piece, " "), word), " ")


def _phrases_in_row(entries: dict[str, str], literal: Column) -> Callable[[Column], Column]:
    """A function that replaces the entries found in a piece, all as one expression."""
    by_size: dict[int, list[str]] = {}
    for src in entries:
        by_size.setdefault(len(src.split(" ")), []).append(src)
    first = sorted({src.split(" ")[0] for src in entries})

    def replaced(words: Column) -> Column:
        def runs(i: Column) -> Column:
            each = []
            for n, known in sorted(by_size.items()):
                run = F.array_join(F.slice(words, i + 1, n), " ")
                whole = (i + n <= F.size(words)) & run.isin(known)
                each.append(F.when(whole, F.struct(F.lit(n).alias("n"), literal[run].alias("value"))))
            return F.filter(F.array(*each), lambda r: r.isNotNull())

        begun = F.filter(F.transform(words, lambda w, i: F.when(w.isin(first), i)), lambda i: i.isNotNull())
        starts = F.transform(begun, lambda i: F.struct(i.alias("pos"), runs(i).alias("runs")))
        return replace_runs(words, best_cover(starts, max(by_size)))

    return lambda piece: tx.bind(F.split(piece, " "), replaced)


def or_as_it_was(translated: Column, piece: Column) -> Column:
    return F.when(translated == "", piece).otherwise(translated)


def _by_join(df: DataFrame, source: DataFrame, key: str, pieces: Column, out: str, lexicon: DataFrame,
             config: PipelineConfig) -> DataFrame:
    """For a large dictionary: each piece meets only the entries of its own words."""
    chunk = source.select(key, F.posexplode(pieces).alias("_pos", "_piece"))
    if not lexicon.where(F.contains("src", F.lit(" "))).isEmpty():
        return _with_pieces(df, key, _phrases_by_join(chunk, key, lexicon, config), out)
    words = chunk.select(key, "_pos", F.explode(F.array_distinct(F.split("_piece", " "))).alias("src"))
    unique = lexicon.groupBy("src").agg(F.min("dst").alias("dst"))
    found = (lookup_join(words, unique, "src", "inner", [key, "_pos"], config)
             .groupBy(key, "_pos")
             .agg(F.map_from_entries(F.collect_list(F.struct("src", "dst"))).alias("_words")))
    done = (chunk.join(found, [key, "_pos"], "left")
            .withColumn("_new", F.when(F.col("_words").isNotNull(), replace_words(
                F.col("_piece"), lambda w: F.coalesce(F.col("_words")[w], w))).otherwise(F.col("_piece")))
            .select(key, "_pos", or_as_it_was(F.col("_new"), F.col("_piece")).alias("_t")))
    return _with_pieces(df, key, done, out)


def _phrases_by_join(chunk: DataFrame, key: str, lexicon: DataFrame, config: PipelineConfig) -> DataFrame:
    """(key, _pos, _t): each piece with the entries of its best cover replaced."""
    chunk = staged(chunk.select(key, "_pos", "_piece", F.struct(key, "_pos").alias("_id")), "pieces")
    table = lexicon.select(F.col("src").alias("phrase"), F.col("dst").alias("value"))
    words = chunk.select("_id", F.split("_piece", " ").alias("words"))
    found, longest = phrase_runs(words, "_id", table, config)
    starts = (found.groupBy("_id", "pos").agg(F.array_sort(F.collect_list(F.struct("n", "value"))).alias("runs"))
              .groupBy("_id").agg(F.array_sort(F.collect_list(F.struct("pos", "runs"))).alias("_starts")))
    new = F.when(F.col("_starts").isNotNull(), replace_runs(
        F.split("_piece", " "), best_cover(F.col("_starts"), longest))).otherwise(F.col("_piece"))
    return (chunk.join(starts.withColumnRenamed("_id", "_same").hint("merge"), F.col("_id").eqNullSafe(F.col("_same")), "left")
            .select(key, "_pos", tx.bind(new, lambda t: or_as_it_was(t, F.col("_piece"))).alias("_t")))


def _with_pieces(df: DataFrame, key: str, done: DataFrame, out: str) -> DataFrame:
    done = done.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_pos", "_t"))).alias("_parts"))
    return (df.join(done, key, "left")
            .withColumn(out, F.coalesce(tx.rejoin(F.col("_parts._t")), F.lit("")))
            .drop("_parts"))


def batch_translator(translate: Callable[[Sequence[str]], Sequence[str | None]]):
    """Arrow UDF over arrays of pieces.

    All pieces of a batch go to ``translate`` at once; if that fails, each piece
    gets up to two tries of its own and then stays as it was.
    """

    def alone(piece: str) -> str:
        for _ in range(RETRIES):
            try:
                return translate([piece])[0] or piece
            except Exception:
                continue
        return piece

    @F.pandas_udf("array<string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in batches:
            flat = [p for pieces in column for p in pieces if p]
            try:
                results = list(translate(flat)) if flat else []
                if len(results) != len(flat):
                    raise ValueError("one result per text expected")
                done = [r or p for r, p in zip(results, flat)]
            except Exception:
                done = [alone(p) for p in flat]
            it = iter(done)
            yield pd.Series([[next(it) if p else p for p in pieces] for pieces in column])

    return run
