"""Nearest neighbours by inner product over stable projections, indexed by kd-trees.

One more component makes all vectors equally long, so that the largest inner
product becomes the smallest distance. A Gaussian matrix, whose distribution is
2-stable, projects to ``DIMENSIONS`` numbers: for a pair at distance ``d`` the
squared projected distance over ``d ** 2`` has a chi-square distribution. A
kd-tree over the projections hands out its leaves in order of their projected
distance from the query, and their vectors are verified in full. The search
ends when a neighbour closer than the best ``k`` so far would lie in what is
left with a probability of ``MISS`` at most, by the chi-square test.

Every vector is indexed. The upper levels of the tree, which deal vectors to
cells, are fitted on at most ``SAMPLE_ROWS`` vectors, the first by a hash of
their id; a cell of many rows is split into blocks by a hash of the id, so
vectors that a third of all rows share are still spread. A task builds the
lower levels of one block and answers a bounded number of queries against it.
Queries visit their own cell first; the distance found there then rules out
other cells by the same test on the cells' boxes.

Defined cases: vectors that are null, empty, zero, hold null or non-finite
components or have another length than most (the longer of equally frequent)
take no part; nor do null ids. A query is no neighbour of itself, nor of other
rows of its id; if an id is repeated among queries, its least vector asks. With
fewer than ``k`` candidates all are returned. Extra columns are ignored; empty
tables give empty tables.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediasignal.session import staged

DIMENSIONS = 8  # even, for the closed form of the chi-square distribution
MISS = 0.03
SAMPLE_ROWS = 20_000
CELL_ROWS, MOST_CELLS, BLOCK_ROWS, QUERY_ROWS, LEAF_ROWS = 8192, 1024, 8192, 2048, 64
FOUND = "query_id long, vec_id long, score double"


def chi_square_tail(x: float, dimensions: int = DIMENSIONS) -> float:
    """Probability that a chi-square variable of an even number of dimensions exceeds ``x``."""
    return math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(dimensions // 2))


def stop_ratio(miss: float = MISS) -> float:
    """The value that a chi-square variable exceeds with probability ``miss``."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_tail(middle) > miss else (low, middle)
    return high


class Projection:
    """Projects vectors made equally long; ``longest`` is the greatest squared length."""

    def __init__(self, width: int, longest: float):
        self.matrix = np.random.default_rng(5).normal(size=(width + 1, DIMENSIONS))
        self.longest = longest

    def stored(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest - np.einsum("ij,ij->i", x, x), 0))
        return np.hstack([x, rest[:, None]]) @ self.matrix

    def asked(self, x: np.ndarray) -> np.ndarray:
        return x @ self.matrix[:-1]


def split_tree(points: np.ndarray, leaves: int) -> list[tuple[int, float]]:
    """Median splits (dimension, value) in heap order; ``leaves`` is a power of two."""
    splits, level = [], [np.arange(len(points))]
    while len(level) < leaves:
        below = []
        for rows in level:
            if len(rows) < 2:
                splits.append((0, math.inf))
                below += [rows, rows[:0]]
                continue
            p = points[rows]
            axis = int(np.argmax(p.max(axis=0) - p.min(axis=0)))
            value = float(np.median(p[:, axis]))
            splits.append((axis, value))
            below += [rows[p[:, axis] < value], rows[p[:, axis] >= value]]
        level = below
    return splits


def cell_of(points: np.ndarray, splits: list[tuple[int, float]]) -> np.ndarray:
    """The leaf of each point."""
    node = np.zeros(len(points), dtype=np.int64)
    if splits:
        axis, value = np.array([a for a, _ in splits]), np.array([v for _, v in splits])
        for _ in range((len(splits) + 1).bit_length() - 1):
            node = 2 * node + 1 + (points[np.arange(len(points)), axis[node]] >= value[node])
    return node - len(splits)


def box_distance(point: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of a point from each box."""
    gap = np.maximum(np.maximum(low - point, point - high), 0)
    return np.einsum("ij,ij->i", gap, gap)


class Block:
    """The kd-tree of one block; its leaves are runs of the reordered rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, points: np.ndarray):
        runs, todo = [], [np.arange(len(ids))]
        while todo:
            rows = todo.pop()
            if len(rows) <= LEAF_ROWS:
                runs.append(rows)
                continue
            p = points[rows]
            axis = int(np.argmax(p.max(axis=0) - p.min(axis=0)))
            order = rows[np.argpartition(p[:, axis], len(rows) // 2)]
            todo += [order[:len(rows) // 2], order[len(rows) // 2:]]
        order = np.concatenate(runs)
        self.ids, self.vectors = ids[order], vectors[order]
        self.ends = np.cumsum([len(r) for r in runs])
        self.starts = self.ends - [len(r) for r in runs]
        self.low = np.array([points[r].min(axis=0) for r in runs])
        self.high = np.array([points[r].max(axis=0) for r in runs])

    def search(self, query: int, vector: np.ndarray, point: np.ndarray, k: int, reach: float, ratio: float, whole: float):
        """Ids and exact scores of the best ``k``; ``reach`` is the squared distance to beat, ``whole`` |q|^2 + longest."""
        away = box_distance(point, self.low, self.high)
        order = np.argsort(away, kind="stable")
        rows, scores, slack = np.zeros(0, dtype=np.int64), np.zeros(0), 1e-9 * whole
        at, step = 0, 2
        while at < len(order) and away[order[at]] <= ratio * (reach + slack):
            now = order[at:at + step]
            now = now[away[now] <= ratio * (reach + slack)]
            new = np.concatenate([np.arange(self.starts[i], self.ends[i]) for i in now])
            new = new[self.ids[new] != query]
            rows, scores = np.append(rows, new), np.append(scores, self.vectors[new] @ vector)
            if len(scores) > k:
                least = np.partition(scores, -k)[-k]
                near = scores >= least - slack  # ties are settled exactly below
                rows, scores = rows[near], scores[near]
                reach = min(reach, whole - 2 * least)
            at, step = at + len(now), min(2 * step, 64)
        exact = (self.vectors[rows] * vector).sum(axis=1)
        best = np.lexsort([self.ids[rows], -exact])[:k]
        return self.ids[rows][best], exact[best]


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64).reshape(-1, width)


def usable(vector: Column) -> Column:
    """Whether a vector may take part."""
    fine = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


class Index:
    """Cells, blocks and projection of a table of vectors (vec_id, embedding)."""

    def __init__(self, vectors: DataFrame, cell_rows: int = CELL_ROWS, block_rows: int = BLOCK_ROWS,
                 sample_rows: int = SAMPLE_ROWS):
        good = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                              F.col("embedding").cast("array<double>").alias("v")).where(
            F.col("vec_id").isNotNull() & usable(F.col("v")))
        square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
        kind = good.groupBy(F.size("v").alias("width")).agg(
            F.count(F.lit(1)).alias("rows"), F.max(square).alias("longest")).orderBy(
            F.desc("rows"), F.desc("width")).first()
        self.width, self.rows, longest = (kind.width, kind.rows, kind.longest) if kind else (1, 0, 1.0)
        self.projection = projection = Projection(self.width, longest)
        self.good = good.where(F.size("v") == self.width)
        width = self.width

        @F.pandas_udf("array<double>")
        def project(v: pd.Series) -> pd.Series:
            return pd.Series(list(projection.stored(_matrix(v, width))))

        sample = self.good.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select(project("v").alias("p"))
        points = np.array([r.p for r in sample.collect()]).reshape(-1, DIMENSIONS)
        cells = min(MOST_CELLS, 1 << max(0, math.ceil(math.log2(max(1, self.rows / cell_rows)))))
        self.splits = splits = split_tree(points[np.lexsort(points.T)], cells)

        def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                p = projection.stored(_matrix(pdf["v"], width))
                yield pdf.assign(p=list(p), cell=cell_of(p, splits))

        self.stored = staged(self.good.mapInPandas(deal, "vec_id long, v array<double>, p array<double>, cell long"), "vectors")
        axes = range(DIMENSIONS)
        # One row for each of at most MOST_CELLS cells.
        self.cells = self.stored.groupBy("cell").agg(
            F.count(F.lit(1)).alias("rows"), F.array(*(F.min(F.get("p", F.lit(i))) for i in axes)).alias("low"),
            F.array(*(F.max(F.get("p", F.lit(i))) for i in axes)).alias("high")).orderBy("cell").collect()
        self.blocks = {r.cell: -(-r.rows // block_rows) for r in self.cells}

    def _visit(self, targets: DataFrame, k: int, miss: float) -> DataFrame:
        """(query_id, vec_id, score): the best of each block of the cells that ``targets`` (query_id, q, reach, cell) name."""
        spark, width, projection, ratio = targets.sparkSession, self.width, self.projection, stop_ratio(miss)
        asked = {r.cell: r["count"] for r in targets.groupBy("cell").count().collect()}  # MOST_CELLS rows at most
        plan = spark.createDataFrame([(c, b, -(-asked[c] // QUERY_ROWS)) for c, b in self.blocks.items() if c in asked],
                                     "cell long, blocks long, groups long")
        plan = F.broadcast(plan)
        stored = self.stored.join(plan, "cell").select(
            "cell", F.expr("pmod(xxhash64(vec_id), blocks)").alias("block"),
            F.explode(F.expr("sequence(0L, groups - 1)")).alias("group"), "vec_id", "v", "p")
        queries = targets.join(plan, "cell").select(
            "cell", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("block"),
            F.expr("pmod(xxhash64(query_id), groups)").alias("group"), "query_id", "q", "reach")

        def answer(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            names = [c.split()[0] for c in FOUND.split(", ")]
            if not len(left) or not len(right):
                return pd.DataFrame(columns=names)
            block = Block(right["vec_id"].to_numpy(), _matrix(right["v"], width), _matrix(right["p"], DIMENSIONS))
            vectors = _matrix(left["q"], width)
            points, out = projection.asked(vectors), []
            for query, vector, point, reach in zip(left["query_id"], vectors, points, left["reach"]):
                ids, scores = block.search(query, vector, point, k, reach, ratio,
                                           float(vector @ vector) + projection.longest)
                out.append(pd.DataFrame({"query_id": query, "vec_id": ids, "score": scores}))
            return pd.concat(out)

        keys = ["cell", "block", "group"]
        return queries.groupBy(*keys).cogroup(stored.groupBy(*keys)).applyInPandas(answer, FOUND)

    def search(self, queries: DataFrame, k: int, miss: float = MISS) -> DataFrame:
        """The ``k`` nearest of each query (query_id, embedding): query_id, rank, vec_id, score."""
        width, splits, projection, ratio = self.width, self.splits, self.projection, stop_ratio(miss)
        asked = queries.select(F.col("query_id").cast("long").alias("query_id"),
                               F.col("embedding").cast("array<double>").alias("q")).where(
            F.col("query_id").isNotNull() & usable(F.col("q")) & (F.size("q") == width)).groupBy("query_id").agg(
            F.min("q").alias("q"))

        def home(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                yield pdf.assign(cell=cell_of(projection.asked(_matrix(pdf["q"], width)), splits))

        asked = staged(asked.mapInPandas(home, "query_id long, q array<double>, cell long"), "queries")
        first = staged(self._visit(asked.withColumn("reach", F.lit(float("inf"))), k, miss), "found")
        nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        # The k-th score found in the query's own cell bounds what may still be nearer.
        bound = first.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") == k).select(
            "query_id", F.col("score").alias("least"))
        cells = [(r.cell, r.low, r.high) for r in self.cells]

        def others(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            numbers = np.array([c for c, _, _ in cells])
            low, high = (np.array([c[i] for c in cells]).reshape(-1, DIMENSIONS) for i in (1, 2))
            for pdf in batches:
                q = _matrix(pdf["q"], width)
                whole = np.einsum("ij,ij->i", q, q) + projection.longest
                reach = np.where(pdf["least"].isna(), np.inf, np.maximum(whole - 2 * pdf["least"], 0) + 1e-9 * whole)
                hits = [np.flatnonzero((box_distance(p, low, high) <= ratio * r) & (numbers != own))
                        for p, r, own in zip(projection.asked(q), reach, pdf["cell"])]
                row = np.repeat(np.arange(len(pdf)), [len(h) for h in hits])
                out = pdf.iloc[row][["query_id", "q"]].assign(reach=reach[row])
                yield out.assign(cell=numbers[np.concatenate(hits)] if len(row) else np.zeros(0, dtype=np.int64))

        rest = staged(asked.join(bound, "query_id", "left").mapInPandas(
            others, "query_id long, q array<double>, reach double, cell long"), "targets")
        return first.unionByName(self._visit(rest, k, miss)).withColumn(
            "rank", F.row_number().over(nearest).cast("int")).where(F.col("rank") <= k).select(
            "query_id", "rank", "vec_id", "score")
