"""Merkle manifest of a dataset: a content-addressed tree of digests, and proofs that single rows belong to it.

Each row is a leaf: the SHA-256 of its columns, each written as its UTF-8 byte
count, a colon and its value, or ``-`` if null. The leaves of a language ascend
by doc_id; runs of ``FAN`` neighbours are hashed to a node (of their digests as
hex text), runs of nodes likewise, until one node remains, the language's
subroot. The subroots, ordered by language, give the root in the same way.

A tree is stored as records ``digest -> kids``, one table per height, where ``kids``
is the concatenation that the digest is of. A request for a leaf descends from
the root: at each height it reads the record of the digest that it is at, goes
to the child that the next digit (base ``FAN``) of its rank names, and takes the
other children along as a segment of its path, those left and those right of
it; reversed, the path leads from the leaf to the root. Requests that are at
one node go on as one row, so a height costs one join of its nodes, and every
row of the dataset can be requested.

Defined cases: null ids are the first of their language, a null language is a
tree of its own, the first one. Rows that are equal in all five columns are
leaves of their own, with equal digests. Null and empty texts differ. Empty
tables give empty tables and no root; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediasignal.llm.common import placed
from mediasignal.session import staged

FAN = 8
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
_BITS, _HEX = FAN.bit_length() - 1, 64


def leaf_digest(*fields: Column) -> Column:
    def written(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(written, fields)), 256)


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of ``path``, from the leaf to the root."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from ``leaf`` and the siblings of ``path``."""
    return F.aggregate(path, leaf, lambda at, s: F.sha2(F.concat(s["left"], at, s["right"]), 256))


def _depth(leaves: str) -> Column:
    """Heights above the leaves: the digits of the last rank, none for a single leaf."""
    return F.expr(f"case when {leaves} > 1 then length(conv({leaves} - 1, 10, {FAN})) else 0 end")


def _grown(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Stored nodes (tree, depth, at, digest, kids) of each height from 1, and the roots (tree, depth, digest)."""
    heights: list[DataFrame] = []
    keys = ["tree", "depth", "digest"]
    roots = nodes.where("depth = 0").select(*keys)
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    for height in range(1, deepest + 1):
        runs = nodes.where(F.col("depth") >= height).groupBy("tree", "depth", F.shiftright("at", _BITS).alias("to")).agg(
            F.array_sort(F.collect_list(F.struct("at", "digest"))).alias("run"))
        nodes = staged(runs.withColumn("kids", F.expr("array_join(transform(run, k -> k.digest), '')")).select(
            "tree", "depth", F.col("to").alias("at"), F.sha2("kids", 256).alias("digest"), "kids"), f"{name}-{height}")
        heights.append(nodes)
        roots = roots.unionByName(nodes.where(F.col("depth") == height).select(*keys))
    return heights, staged(roots, f"{name}-roots")


def _step(at: DataFrame, records: DataFrame) -> DataFrame:
    """From nodes (tree, at, digest, path) to all their children."""
    kids = at.join(records.select("digest", "kids").dropDuplicates(["digest"]), "digest").drop("digest")
    kids = kids.select("*", F.explode(F.expr(f"sequence(0, cast(length(kids) div {_HEX} as int) - 1)")).alias("digit"))
    return kids.select(
        "tree", F.expr(f"at * {FAN} + digit").alias("at"), F.expr(f"substring(kids, digit * {_HEX} + 1, {_HEX})").alias("digest"),
        F.expr(f"array_append(path, struct(substring(kids, 1, digit * {_HEX}) as left, substring(kids, (digit + 1) * {_HEX} + 1) as right))")
        .alias("path"))


class Manifest:
    """The stored trees over ``rows`` (doc_id, lang, leaf and more columns of the caller)."""

    def __init__(self, rows: DataFrame):
        order = placed(rows, [F.asc_nulls_first("lang"), F.asc_nulls_first("doc_id"), "leaf"], "leaves")
        langs = order.groupBy("lang").agg(F.count(F.lit(1)).alias("leaves"), F.min("place").alias("first"))
        langs = placed(staged(langs, "languages"), [F.asc_nulls_first("lang")], "trees").withColumnRenamed("place", "tree")
        langs = staged(langs.withColumn("depth", _depth("leaves")), "trees")
        #: (…, tree, depth, rank) of every row.
        self.leaves = staged(order.withColumnRenamed("lang", "lang_of_leaf").join(
            langs.select("lang", "first", "tree", "depth"), F.col("lang").eqNullSafe(F.col("lang_of_leaf")))
            .withColumn("rank", F.col("place") - F.col("first")).drop("lang_of_leaf", "place", "first"), "ranked")
        self.records, subroots = _grown(self.leaves.select("tree", "depth", F.col("rank").alias("at"), F.col("leaf").alias("digest")), "nodes")
        trees = langs.count()
        self.top_records, root = _grown(subroots.select(
            F.lit(0).cast("long").alias("tree"), _depth(f"{trees}L").alias("depth"), F.col("tree").alias("at"), "digest"), "top")
        #: (tree, depth, digest) of every language.
        self.subroots = subroots
        row = root.first()
        self.root: str | None = row.digest if row else None

    def proofs(self, requests: DataFrame | None = None) -> DataFrame:
        """``requests``, rows of ``leaves`` (all of them if none are given), with subroot and path (left, right) up to the root."""
        asked = self.leaves if requests is None else requests
        empty = F.expr("cast(array() as array<struct<left: string, right: string>>)")
        at = self.subroots.sparkSession.createDataFrame([(0, 0, self.root)], "tree long, at long, digest string").select("*", empty.alias("path"))
        wanted = []
        if requests is not None:
            step = asked.select("tree", F.col("rank").alias("at"))
            for _ in self.records:
                step = staged(step.select("tree", F.shiftright("at", _BITS).alias("at")).distinct(), "wanted")
                wanted.append(step)
        for records in reversed(self.top_records):
            at = _step(at, records)
        trees = staged(at.select(F.col("at").alias("tree"), F.col("digest").alias("subroot"), "path"), "top-paths")
        start = trees.join(self.subroots.select("tree", "depth"), "tree").select(
            "tree", "depth", F.lit(0).cast("long").alias("at"), F.col("subroot").alias("digest"), "path")
        at = start.where("false").drop("depth")
        for height in range(len(self.records), 0, -1):
            at = at.unionByName(start.where(F.col("depth") == height).drop("depth"))
            if wanted:
                at = at.join(wanted[height - 1], ["tree", "at"], "left_semi")
            if height > 1:
                at = _step(at, self.records[height - 1])
        # The last step reads one record for each run of leaves, and each request takes its own child there.
        subroot = trees.select("tree", "subroot")
        found = asked.where("depth = 0").join(trees.select("tree", "path"), "tree")
        if self.records:
            runs = at.join(self.records[0].select("digest", "kids").dropDuplicates(["digest"]), "digest").select(
                F.col("tree").alias("tree_of_run"), "at", "path", "kids")
            inner = asked.where("depth > 0").join(runs, (F.col("tree") == F.col("tree_of_run")) & (
                F.shiftright("rank", _BITS) == F.col("at")))
            digit = f"cast(rank % {FAN} as int)"
            inner = inner.withColumn("path", F.expr(
                f"array_append(path, struct(substring(kids, 1, {digit} * {_HEX}) as left, substring(kids, ({digit} + 1) * {_HEX} + 1) as right))"))
            found = found.unionByName(inner.drop("tree_of_run", "at", "kids"))
        return found.join(subroot, "tree").withColumn("path", F.reverse("path"))


def lower_cased(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def audit(docs: DataFrame) -> DataFrame:
    """Every row proved against the manifest of ``docs``, after tampering with about a third of the rows.

    A row whose unsigned crc32 of its decimal doc_id is a multiple of 3 has the
    A-Z of its text lower-cased; ``verified`` tells whether its leaf and its proof
    still give the root.
    """
    fields = [F.col(c) for c in FIELDS]
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    claimed = F.when(changed, leaf_digest(*fields[:-1], lower_cased(F.col("text").cast("string"))))
    rows = staged(docs.select("doc_id", F.col("lang").cast("string").alias("lang"), leaf_digest(*fields).alias("leaf"),
                              claimed.alias("changed")), "digests")
    manifest = Manifest(rows)
    if manifest.root is None:
        path = F.expr("cast(array() as array<struct<left: string, right: string>>)")
        proved = manifest.leaves.select("*", F.lit("").alias("subroot"), path.alias("path"))
    else:
        proved = manifest.proofs()
    root = F.lit(manifest.root).cast("string")
    return proved.select(
        "doc_id", "leaf", "subroot", root.alias("root"), proof_digest(F.col("path")).alias("proof_sha256"),
        folded(F.coalesce("changed", "leaf"), F.col("path")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))
