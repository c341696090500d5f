"""Phrases of a table found in the words of texts: a walk down the tree of their words, and the best cover of a text."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediasignal.config import PipelineConfig
from mediasignal.functions.text import bind
from mediasignal.operators.lookup import is_bounded, lookup_join
from mediasignal.session import staged


def phrase_runs(words: DataFrame, key: str, table: DataFrame, config: PipelineConfig,
                store: Callable[[DataFrame, str], DataFrame] = staged) -> tuple[DataFrame, int]:
    """Word runs that a phrase table of any size has, and the most words that a phrase has.

    ``words`` has ``key`` and the array ``words``; ``table`` has ``phrase`` (words
    with single spaces between) and may have ``value``, of which the least counts.
    Returns (key, pos, n, run, value): ``n`` words from position ``pos``, counted from 0.

    The nodes of the tree are the beginnings of phrases. Every word is looked up
    among the first words, and only starts that are found go on, by one word a
    level, as long as what they have read begins a phrase. So a word that starts
    no phrase costs one row and nothing more. With a table that isn't broadcast,
    the starts of a text are gathered before they meet its words, so a text
    travels once however many starts it has. ``store`` writes a level's table.
    """
    parts = F.split("phrase", " ")
    value = F.col("value") if "value" in table.columns else F.lit(None).cast("string")
    begun = (table.select(parts.alias("parts"), value.alias("value"))
             .select("parts", "value", F.explode(F.sequence(F.lit(1), F.size("parts"))).alias("n"))
             .select("n", F.array_join(F.slice("parts", F.lit(1), F.col("n")), " ").alias("run"),
                     (F.col("n") == F.size("parts")).alias("whole"), "value"))
    nodes = store(begun.groupBy("n", "run").agg(
        F.max("whole").alias("whole"), F.min(F.when(F.col("whole"), F.col("value"))).alias("value")), "phrase-tree")
    bounded, longest = is_bounded(nodes, config), nodes.agg(F.max("n")).first()[0] or 1

    def known(runs: DataFrame, n: int) -> DataFrame:
        level = nodes.where(F.col("n") == n).select("run", "whole", "value")
        return store(lookup_join(runs, level, "run", "inner", [key, "pos"], config, bounded), "runs")

    if bounded:  # nothing is shuffled, so the words behind may come along
        each = F.transform("words", lambda w, i: F.struct(
            i.alias("pos"), w.alias("run"), F.slice("words", i + 2, F.lit(longest - 1)).alias("rest")))
        alive = known(words.select(key, F.explode(each).alias("at")).select(key, "at.*"), 1)
    else:
        starts = known(words.select(key, F.posexplode("words").alias("pos", "run")), 1)
        of_text = starts.groupBy(F.col(key).alias("_key")).agg(
            F.collect_list(F.struct("pos", "run", "whole", "value")).alias("_starts"))
        with_rest = F.transform("_starts", lambda s: s.withField("rest", F.slice("words", s["pos"] + 2, F.lit(longest - 1))))
        alive = store(words.join(of_text.hint("merge"), F.col(key).eqNullSafe(F.col("_key"))).select(
            key, F.explode(with_rest).alias("at")).select(key, "at.*"), "starts")
    found = []
    for n in range(1, longest + 1):
        found.append(alive.where("whole").select(key, "pos", F.lit(n).alias("n"), "run", "value"))
        if n < longest:
            alive = known(alive.where(F.size("rest") >= n).select(
                key, "pos", "rest", F.concat_ws(" ", "run", F.col("rest")[n - 1]).alias("run")), n + 1)
    return reduce(DataFrame.unionByName, found), longest


# A start, with what the words from it on come to at best: words covered, minus the number of runs, and the
# run taken here (n words, 0 if none). Ordered as the best choice is: most words, fewest runs, longest run.
_COVER = "array<struct<pos:int,best:struct<words:int,runs:int,n:int,value:string>>>"


def best_cover(starts: Column, longest: int) -> Column:
    """The runs that replace a text's words: (pos, n, value) in order of ``pos``, none meeting another.

    ``starts`` is an array of (pos, runs), in order of ``pos``, with the runs (n, value) found there, at
    most ``longest`` words each. Of all covers the one with most words covered counts, then with fewest
    runs, then the one that takes the longer run at the first start where they differ. Worked out from the
    last start to the first: what follows a run is the best of the next start at or behind its end, which is
    among the ``longest`` starts seen last. No starts, or null, give no runs.
    """
    def step(seen: Column, s: Column) -> Column:
        def behind(n: Column | int) -> Column:
            after = F.get(F.filter(F.slice(seen, 1, longest), lambda d: d["pos"] >= s["pos"] + n), F.lit(0))["best"]
            return F.struct(F.coalesce(after["words"], F.lit(0)).alias("words"), F.coalesce(after["runs"], F.lit(0)).alias("runs"))

        def taken(r: Column) -> Column:
            rest = behind(r["n"])
            return F.struct((rest["words"] + r["n"]).alias("words"), (rest["runs"] - 1).alias("runs"),
                            r["n"].alias("n"), r["value"].alias("value"))

        rest = behind(1)
        passed = F.struct(rest["words"].alias("words"), rest["runs"].alias("runs"),
                          F.lit(0).alias("n"), F.lit(None).cast("string").alias("value"))
        best = F.array_max(F.concat(F.transform(s["runs"], taken), F.array(passed)))
        return F.concat(F.array(F.struct(s["pos"].alias("pos"), best.alias("best"))), seen)

    seen = F.aggregate(F.reverse(starts), F.array().cast(_COVER), step)

    def walk(kept: Column, d: Column) -> Column:
        last = F.get(kept, F.size(kept) - 1)
        free = last.isNull() | (last["pos"] + last["n"] <= d["pos"])
        run = F.struct(d["pos"].alias("pos"), d["best"]["n"].alias("n"), d["best"]["value"].alias("value"))
        return F.when(free & (d["best"]["n"] > 0), F.concat(kept, F.array(run))).otherwise(kept)

    return F.aggregate(seen, F.array().cast("array<struct<pos:int,n:int,value:string>>"), walk)


def replace_runs(words: Column, cover: Column) -> Column:
    """``words`` with each run of ``cover`` replaced by its value, joined by single spaces."""
    def replaced(words: Column, cover: Column) -> Column:
        def end(k: Column) -> Column:
            return F.when(k > 0, F.get(cover, k - 1)["pos"] + F.get(cover, k - 1)["n"]).otherwise(0)

        parts = F.transform(cover, lambda c, k: F.concat(
            F.slice(words, end(k) + 1, c["pos"] - end(k)), F.array(c["value"])))
        last = end(F.size(cover))
        tail = F.slice(words, last + 1, F.greatest(F.size(words) - last, F.lit(0)))
        return F.array_join(F.concat(F.flatten(parts), tail), " ")

    return bind(F.struct(words.alias("words"), cover.alias("cover")), lambda b: replaced(b["words"], b["cover"]))
