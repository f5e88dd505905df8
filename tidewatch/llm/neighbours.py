"""Nearest neighbours by stable projections, a kd-tree and a chi-square stopping test.

Vectors are projected to `PROJECTED` dimensions by a fixed Gaussian matrix. Squared projected distances then follow d^2 times
a chi-square law with as many degrees of freedom, d being the true distance. Every task indexes the projections of its block of rows in a
kd-tree and takes the leaves in the order of their projected distance from the query; candidates are verified on the original
vectors. The search of a query in a block stops when the next leaf is so far that a vector nearer than the present k-th neighbour
would lie there with a chance of at most `MISS`; rounding is allowed for, so all copies of a query are met. That k-th
distance starts from the best found in the block.

All rows are indexed, `BLOCK` at a time. Queries are dealt in blocks of `QUERIES` and meet all blocks of rows; each
pair of blocks hands on k rows per query at most, which a ranking joins. No block is bound to a key, so nothing can be hot.

Vectors that are null, empty, all zero, or hold null or non-finite components take no part, nor do rows without id, nor
rows whose length differs from that of the queries. Rows that repeat id and vector count once; an id with several
vectors is a candidate with each of them, and as a query uses the smallest one.
A query never finds a row of its own id. Ties go to the smaller id. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.rowwise import emit
from tidewatch.session import materialize

K = 10
PROJECTED = 10
SEED = 31
LEAF, BLOCK, QUERIES = 64, 20_000, 4096
#: Chance to miss one true neighbour that the stopping test allows.
MISS = 1e-4


def chi_square_quantile(p: float, degrees: int) -> float:
    """The value that a chi-square variable exceeds with chance 1 - p, by bisection on its closed-form tail (even degrees)."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        term, tail = 1.0, 1.0
        for k in range(1, degrees // 2):
            term *= middle / 2 / k
            tail += term
        low, high = (middle, high) if math.exp(-middle / 2) * tail > 1 - p else (low, middle)
    return high


def projection(size: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((size, PROJECTED))


class Tree:
    """A kd-tree over projected points: rows in leaf order, and boxes of the nodes in heap order."""

    def __init__(self, points: np.ndarray) -> None:
        self.depth = max(0, math.ceil(math.log2(max(1, len(points)) / LEAF)))
        self.order = np.arange(len(points))
        nodes = 2 ** (self.depth + 1)
        self.first, self.last = np.zeros(nodes, np.int64), np.zeros(nodes, np.int64)
        self.low, self.high = (np.zeros((nodes, points.shape[1])) for _ in range(2))
        self._build(points, 1, 0, len(points))
        self.points = points[self.order]

    def _build(self, points: np.ndarray, node: int, first: int, last: int) -> None:
        own = points[self.order[first:last]]
        self.first[node], self.last[node] = first, last
        self.low[node], self.high[node] = (own.min(axis=0), own.max(axis=0)) if len(own) else (np.inf, np.inf)
        if node < 2**self.depth:
            middle = (first + last) // 2
            if len(own) > 1:
                axis = int((self.high[node] - self.low[node]).argmax())
                split = np.argpartition(own[:, axis], middle - first)
                self.order[first:last] = self.order[first:last][split]
            self._build(points, 2 * node, first, middle)
            self._build(points, 2 * node + 1, middle, last)

    def gap(self, node: int, point: np.ndarray) -> float:
        """Squared distance from a point to the box of a node."""
        outside = np.maximum(np.maximum(self.low[node] - point, point - self.high[node]), 0.0)
        return float(outside @ outside)

    def leaves(self, point: np.ndarray):
        """(squared distance bound, first, last) of the leaves, nearest first."""
        waiting = [(self.gap(1, point), 1)]
        while waiting:
            bound, node = heapq.heappop(waiting)
            if node >= 2**self.depth:
                yield bound, int(self.first[node]), int(self.last[node])
            else:
                for child in (2 * node, 2 * node + 1):
                    if self.first[child] < self.last[child]:
                        heapq.heappush(waiting, (self.gap(child, point), child))


def squared(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Squared distances in double precision, added up in the order of the components."""
    apart = rows - query
    return np.cumsum(apart * apart, axis=1)[:, -1]


def rounding(queries: np.ndarray, plane: np.ndarray) -> np.ndarray:
    """How far apart the projections of equal vectors may come out at most: a bound on the error of two sums of products."""
    return 4 * queries.shape[1] * np.finfo(np.float64).eps * np.linalg.norm(queries, axis=1) * np.linalg.norm(plane)


def search(tree: Tree, rows: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, seen: np.ndarray, k: int, reach: float, slack: float):
    """(ids, distances) of the k nearest rows found; `rows` and `ids` are in leaf order, `seen` the projected query with an error of `slack`."""
    best_ids, best = np.zeros(0, np.int64), np.zeros(0)
    for bound, first, last in tree.leaves(seen):
        at = np.arange(first, last)
        if len(best) == k:
            limit = (math.sqrt(reach * best[-1]) + slack) ** 2
            if bound > limit:
                break
            apart = tree.points[first:last] - seen
            at = at[np.einsum("ij,ij->i", apart, apart) <= limit]
        at = at[ids[at] != own]
        if len(at):
            best, best_ids = np.append(best, squared(rows[at], query)), np.append(best_ids, ids[at])
            order = np.lexsort((best_ids, best))[:k]
            best, best_ids = best[order], best_ids[order]
    return best_ids, np.sqrt(best)


def usable(vector: Column) -> Column:
    """Not null or empty, without null or non-finite components, and not all zero."""
    infinite = F.lit(float("inf"))
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite)
    return F.coalesce(F.forall(vector, sound) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(batch: pa.RecordBatch, place: int, size: int) -> np.ndarray:
    return batch.column(place).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _found(rows: DataFrame, ids: list[int], vectors: np.ndarray, k: int, miss: float) -> DataFrame:
    """The k nearest in every block of rows for a block of queries."""
    shared = rows.sparkSession.sparkContext.broadcast((ids, vectors))
    reach = chi_square_quantile(1 - miss, PROJECTED)

    def blocks(batches):
        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += len(batch)
            if count >= BLOCK:
                yield held
                held, count = [], 0
        if held:
            yield held

    def run(batches):
        queries, vectors = shared.value
        size = vectors.shape[1]
        plane = projection(size)
        seen = vectors @ plane
        slack = rounding(vectors, plane)
        for held in blocks(batches):
            own = np.concatenate([b.column(0).to_numpy() for b in held])
            matrix = np.concatenate([_matrix(b, 1, size) for b in held])
            tree = Tree(matrix @ plane)
            matrix, own = matrix[tree.order], own[tree.order]
            out = [search(tree, matrix, own, vectors[q], queries[q], seen[q], k, reach, slack[q]) for q in range(len(queries))]
            yield (
                np.repeat(np.array(queries, np.int64), [len(i) for i, _ in out]),
                np.concatenate([i for i, _ in out]),
                np.concatenate([d for _, d in out]),
            )

    same = rows.filter(F.size("vector") == vectors.shape[1])
    return emit(same, "query_id long, vec_id long, score double", run)


def nearest(vectors: DataFrame, queries: Column, *, k: int = K, miss: float = MISS) -> DataFrame:
    """query_id, rank, vec_id, score for the rows of `vectors` (vec_id, embedding) that `queries` selects, against all rows."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    asked = rows.filter(queries).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = materialize(asked.withColumn("size", F.size("vector")), "queries")
    dealt = rows.distinct()
    parts = None
    for size, count in sorted((r["size"], r["count"]) for r in asked.groupBy("size").count().collect()):
        number = -(-count // QUERIES)
        own = asked.filter(F.col("size") == size).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(number)))
        for block in range(number):
            taken = sorted((r["vec_id"], r["vector"]) for r in own.filter(F.col("block") == block).collect())
            if taken:
                found = _found(dealt, [i for i, _ in taken], np.array([v for _, v in taken]), k, miss)
                parts = found if parts is None else parts.union(found)
    if parts is None:
        parts = rows.limit(0).select(F.col("vec_id").alias("query_id"), "vec_id", F.lit(0.0).alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = parts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
