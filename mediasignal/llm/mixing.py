"""Mixing sources to target weights, by budgets that flow down a domain-language-source tree.

A token budget is divided at each node by its children's weights. No child gets
more than its subtree can give, which is its tokens times ``epochs``; what one
can't use goes to its siblings by their weights, and only what all of them
can't use stays with the parent, whose siblings then had it offered. Since a
parent's own limit is the sum of its children's, one pass from the root down
does this: of the children, sorted by limit over weight, a first part gives all
it has and the others share the rest.

A leaf with budget ``t`` and ``s`` tokens gives ``t div s`` whole epochs and of
the next one the documents at the front of a seeded order, as far as their
tokens fit. That order is by MD5 of seed, epoch and id. The front is found by
sums over ranges of that hash, about ``RANGE_ROWS`` documents each, and a sort
of the one range in which the budget ends, so a leaf that holds a third of all
rows is never gathered. Each leaf keeps only its number of epochs and the last
hash of its front; a document is judged against these where it is read.

Defined cases: null texts have no tokens; null languages and sources count as
empty names. Weights are whole numbers; a name without one has weight 1, one
with 0 gets nothing. A leaf without tokens gives nothing. Rows that repeat an
id and leaf share their place in the order: all or none are taken. Rounding
leaves less than one token per child unused. Empty tables give empty tables;
extra columns are ignored or, in ``take_mixed``, passed through.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediasignal.llm.common import fresh, whole_text
from mediasignal.session import staged

LEVELS = ["domain", "lang", "source"]
#: Documents in one range of a leaf's seeded order, about.
RANGE_ROWS = 2_000


@dataclass(frozen=True)
class Mix:
    """Target weights, and how much to take: ``share`` thousandths of all tokens."""

    domains: dict[str, int] = field(default_factory=lambda: {"web": 6, "reference": 4})
    langs: dict[str, int] = field(default_factory=lambda: {"en": 5, "fr": 2, "de": 2, "es": 1})
    sources: dict[str, int] = field(default_factory=dict)
    share: int = 800
    epochs: int = 4
    seed: str = "mix-1"


def domain_of(source: Column) -> Column:
    """Documents carry no domain: sources are dealt to two by a hash of their name."""
    return F.when(F.substring(F.md5(source.cast("binary")), 1, 1) < "a", "web").otherwise("reference")


def word_tokens(text: Column) -> Column:
    """Words of a whole text."""
    return F.regexp_count(whole_text(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _keys() -> list[Column]:
    source = F.coalesce(F.col("source"), F.lit(""))
    return [domain_of(source).alias("domain"), F.coalesce(F.col("lang"), F.lit("")).alias("lang"),
            source.alias("source")]


def _weight(names: Column, weights: dict[str, int]) -> Column:
    found = F.lit(1)
    for name, weight in weights.items():
        found = F.when(names == name, weight).otherwise(found)
    return found.cast("long")


def _divide(children: DataFrame, parent: list[str], child: str) -> DataFrame:
    """Adds ``budget`` to children (parent keys, child, weight, room, given): the parent's budget is ``given``."""
    each = Window.partitionBy(*parent)
    order = each.orderBy(F.col("room") / F.col("weight"), child)
    before = order.rowsBetween(Window.unboundedPreceding, 0)
    shared = (children.where("weight > 0")
              .withColumn("room_to", F.sum("room").over(before))
              .withColumn("weight_after", F.sum("weight").over(each) - F.sum("weight").over(before))
              .withColumn("full", F.expr("room_to * weight + room * weight_after <= given * weight"))
              .withColumn("rest", F.col("given") - F.sum(F.when(F.col("full"), F.col("room")).otherwise(0)).over(each))
              .withColumn("weights", F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(each)))
    return shared.withColumn("budget", F.expr("case when full then room else weight * rest div weights end")).drop(
        "room_to", "weight_after", "full", "rest", "weights")


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """(domain, lang, source, tokens, rows, budget) from leaves (domain, lang, source, tokens, rows)."""
    weights = {"domain": mix.domains, "lang": mix.langs, "source": mix.sources}
    given, path = None, []
    for level in LEVELS:
        nodes = leaves.groupBy(*path, level).agg(
            (F.sum("tokens") * mix.epochs).alias("room"), F.sum("tokens").alias("tokens"), F.sum("rows").alias("rows"))
        nodes = nodes.withColumn("weight", _weight(F.col(level), weights[level]))
        if given is None:
            whole = F.sum("tokens").over(Window.partitionBy())  # over the few domains
            nodes = nodes.withColumn("whole", whole).withColumn(
                "given", F.expr(f"whole * {int(mix.share)} div 1000")).drop("whole")
        else:
            nodes = nodes.join(given, path)
        divided = _divide(nodes, path, level)
        path = [*path, level]
        given = divided.select(*path, F.col("budget").alias("given"))
    return divided.select(*path, "tokens", "rows", "budget")


def _order_key(doc_id: Column, epoch: Column, mix: Mix) -> Column:
    name = F.concat_ws(":", F.lit(mix.seed), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.md5(name.cast("binary"))


def leaf_fronts(docs: DataFrame, mix: Mix, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(domain, lang, source, whole, last): the leaf's whole epochs, and the last key of the next epoch's front."""
    rows = staged(docs.select("doc_id", *_keys(), word_tokens(F.col("text")).alias("tokens")), "tokens")
    leaves = rows.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    plan = staged(leaf_budgets(leaves, mix).where("tokens > 0").selectExpr(
        *LEVELS, "budget div tokens as whole", "budget % tokens as rest",
        f"ceil(rows / {int(range_rows)}) as ranges"), "budgets")
    keyed = (rows.join(plan, LEVELS).where("rest > 0")
             .withColumn("key", _order_key(F.col("doc_id"), F.col("whole"), mix))
             .withColumn("range", F.expr("cast(conv(substring(key, 1, 8), 16, 10) as bigint) * ranges div 4294967296L")))
    sums = keyed.groupBy(*LEVELS, "range", "rest").agg(F.sum("tokens").alias("tokens"))
    along = Window.partitionBy(*LEVELS).orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("to", F.sum("tokens").over(along))
    # The range in which the budget ends; a leaf whose rest outlasts no range doesn't exist, as rest < tokens.
    last = sums.where("to > rest and to - tokens <= rest").groupBy(*LEVELS).agg(
        F.min_by(F.struct("range", F.expr("rest - (to - tokens) as left")), "range").alias("at")).select(
        *LEVELS, F.col("at.range").alias("range"), F.col("at.left").alias("left"))
    inside = keyed.join(last, [*LEVELS, "range"]).groupBy(*LEVELS, "range", "left", "key").agg(
        F.sum("tokens").alias("tokens"))
    by_key = Window.partitionBy(*LEVELS).orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    fits = inside.withColumn("to", F.sum("tokens").over(by_key)).where("to <= left").groupBy(*LEVELS).agg(
        F.max("key").alias("key"))
    # Without one that fits, the front ends before the range's first key.
    ends = last.join(fits, LEVELS, "left").join(plan, LEVELS).select(*LEVELS, F.coalesce(
        "key", F.expr("lpad(lower(hex((range * 4294967296L + ranges - 1) div ranges)), 8, '0')")).alias("last"))
    return staged(plan.join(ends, LEVELS, "left").select(*LEVELS, "whole", F.coalesce("last", F.lit("")).alias("last")),
                  "fronts")


def _copies(doc_id: Column, mix: Mix) -> Column:
    return (F.coalesce(F.col("whole"), F.lit(0)) + F.coalesce(
        (_order_key(doc_id, F.col("whole"), mix) <= F.col("last")).cast("int"), F.lit(0))).cast("int")


def mixture(docs: DataFrame, mix: Mix, range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row per document: doc_id, domain, lang, source, tokens, copies (how often the mixture takes it)."""
    fronts = leaf_fronts(docs, mix, range_rows)
    rows = docs.select("doc_id", *_keys(), word_tokens(F.col("text")).alias("tokens"))
    return rows.join(fronts, LEVELS, "left").select(
        "doc_id", *LEVELS, "tokens", _copies(F.col("doc_id"), mix).alias("copies"))


def take_mixed(docs: DataFrame, mix: Mix, range_rows: int = RANGE_ROWS) -> DataFrame:
    """The columns of ``docs``; each row as often as the mixture takes it."""
    fronts = leaf_fronts(docs, mix, range_rows)
    names = fresh(docs, "leaf_domain", "leaf_lang", "leaf_source")
    held = docs.select("*", *(k.alias(n) for k, n in zip(_keys(), names)))
    leaf = fronts.select(*(F.col(k).alias(f"{k}_of_front") for k in LEVELS), "whole", "last")
    other = fresh(held, *leaf.columns)
    leaf = leaf.toDF(*other)
    same = [F.col(a) == F.col(b) for a, b in zip(names, other)]
    whole, last = other[3:]
    times = F.coalesce(F.col(whole), F.lit(0)) + F.coalesce(
        (_order_key(F.col("doc_id"), F.col(whole), mix) <= F.col(last)).cast("int"), F.lit(0))
    (copy,) = fresh(held.select("*"), "copy_of_row")
    taken = held.join(leaf, same, "left").withColumn(copy, times.cast("int")).where(F.col(copy) > 0)
    if mix.epochs > 1:
        taken = taken.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copy))))
    return taken.select(*docs.columns)
