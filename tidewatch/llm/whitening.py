"""Whitening of embeddings by shifted CholeskyQR.

Entries c become whole numbers x = floor(1024 c) + 100000. Their sums are exact, so every row is centred on the exact mean.
A Gram pass multiplies the centred rows with themselves: every task adds up its rows, the sums of tasks are added in a
tree, and the driver sees some matrices of the size of the dimensions. The Cholesky factor of the first Gram matrix, with a shift
that keeps it positive, turns rows into nearly orthogonal ones by a triangular solve; the Gram matrix of those gives the next
factor, until the rows are orthogonal. The product of the factors is R of the centred rows, and its singular
value decomposition holds the components (right vectors) and their eigenvalues (squares over n). Rows are read again in every pass and
never shuffled; the solves are applied one after the other, so rounding does not grow with the condition of the data.

Rows whose vector is null, empty, or holds null or non-finite entries are dropped; so are entries beyond 2^52, of which x is
no long. If lengths differ, those of the most frequent length count (the longer one of equally frequent ones). Zero
vectors and repeated rows count like any other; a null vec_id is kept. Directions without variance have no component, so there may be fewer
than asked for, and none if all vectors are equal. Extra columns are ignored. The number of dimensions, not of rows, is bounded by
the memory of a task: some matrices of dimensions squared.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.rowwise import emit
from tidewatch.session import materialize

COMPONENTS = 8
SCALE, OFFSET = 1024, 100_000
#: Tasks that add up the sums of all others; the driver gets one matrix of each.
FAN_IN = 16
#: Rows count as orthogonal when their Gram matrix is so near to one that a last solve leaves only rounding.
NEAR = 1e-6
ROUNDS = 12

RESULT = "vec_id long, component int, deviation decimal(38,0), whitened double"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (array<double>) of the rows that take part, before lengths are compared."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= 2.0**52)
    return rows.filter(F.coalesce((F.size("vector") > 0) & F.forall("vector", sound), F.lit(False)))


def _matrix(batch: pa.RecordBatch, place: int, size: int) -> np.ndarray:
    return batch.column(place).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def whole(matrix: np.ndarray) -> np.ndarray:
    """floor(1024 c) as whole numbers, without the offset."""
    return np.floor(matrix * SCALE).astype(np.int64)


def _exact_sum(numbers: np.ndarray) -> list[int]:
    """Column sums without overflow."""
    low = numbers & 0xFFFF
    return [int(h) * 0x10000 + int(l) for h, l in zip(((numbers - low) >> 16).sum(axis=0), low.sum(axis=0), strict=True)]


def totals(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors of the most frequent length and the exact sums of floor(1024 c) per dimension."""

    def make(batches):
        sums: dict[int, list[int]] = {}
        counts: dict[int, int] = {}
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy()
            for size in np.unique(sizes).tolist():
                own = batch.filter(pa.array(sizes == size))
                more = _exact_sum(whole(_matrix(own, 1, size)))
                sums[size] = [a + b for a, b in zip(sums[size], more, strict=True)] if size in sums else more
                counts[size] = counts.get(size, 0) + own.num_rows
        for size, values in sums.items():
            yield [size] * size, range(size), [counts[size]] * size, [Decimal(v) for v in values]

    added = emit(rows, "size int, place int, n long, total decimal(38,0)", make)
    added = materialize(added.groupBy("size", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")), "totals")
    first = added.filter("place = 0").orderBy(F.desc("n"), F.desc("size")).first()
    if first is None:
        return 0, []
    return first["n"], [int(r["total"]) for r in added.filter(F.col("size") == first["size"]).orderBy("place").collect()]


@dataclass
class Centre:
    """The exact mean of the whole numbers of n vectors, as floor and rest per dimension."""

    n: int
    floor: np.ndarray
    rest: np.ndarray

    @staticmethod
    def of(n: int, totals: list[int]) -> Centre:
        return Centre(n, np.array([t // n for t in totals], np.int64), np.array([t % n for t in totals], np.int64))

    def centred(self, matrix: np.ndarray) -> np.ndarray:
        """x - S/n in double precision."""
        return (np.floor(matrix * SCALE) - self.floor) - self.rest / self.n

    def deviations(self, matrix: np.ndarray) -> list[int]:
        """The sum of (n x - S)^2 of every row as a whole number: n x - S = n (x - floor) - rest."""
        apart = whole(matrix)
        if max(np.abs(apart).max(initial=0), np.abs(self.floor).max(initial=0)) >= 2**22:
            apart = apart.astype(object)  # beyond 64 bits when multiplied
        apart = apart - self.floor
        high, low = self.rest >> 24, self.rest & 0xFFFFFF
        sums = zip((apart * apart).sum(axis=1), (apart * high).sum(axis=1), (apart * low).sum(axis=1), strict=True)
        last = sum(int(r) ** 2 for r in self.rest)
        return [self.n**2 * int(s) - 2 * self.n * ((int(h) << 24) + int(l)) + last for s, h, l in sums]


def solve_triangular(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """rows times the inverse of an upper triangular factor, column by column."""
    out = np.empty_like(rows)
    for k in range(len(factor)):
        out[:, k] = (rows[:, k] - out[:, :k] @ factor[:k, k]) / factor[k, k]
    return out


def _added(rows: DataFrame, size: int, of, shape: tuple[int, ...]) -> np.ndarray:
    """Sum over all rows of `of(block of vectors)`, arrays of one shape, added up in tasks and then in a tree."""

    def partial(batches):
        total = np.zeros(shape)
        rows = 0
        for batch in batches:
            total += of(_matrix(batch, 1, size))
            rows += batch.num_rows
        if rows:
            yield [TaskContext.get().partitionId()], [total.tobytes()]

    def combine(batches):
        total, rows = np.zeros(shape), 0
        for batch in batches:
            for values in batch.column(1):
                total += np.frombuffer(values.as_buffer()).reshape(shape)
            rows += batch.num_rows
        if rows:
            yield [TaskContext.get().partitionId()], [total.tobytes()]

    kind = "task long, total binary"
    dealt = emit(rows, kind, partial).repartition(FAN_IN, F.pmod("task", F.lit(FAN_IN))).sortWithinPartitions("task")
    found = sorted((r["task"], bytes(r["total"])) for r in emit(dealt, kind, combine).collect())
    return sum((np.frombuffer(t).reshape(shape) for _, t in found), np.zeros(shape))


def root(gram: np.ndarray) -> np.ndarray:
    """A matrix whose Gram matrix is `gram`: its Cholesky factor, or one by eigenvalues where it is not positive definite."""
    try:
        return np.linalg.cholesky(gram).T
    except np.linalg.LinAlgError:
        values, vectors = np.linalg.eigh(gram)
        return np.sqrt(np.maximum(values, 0.0))[:, None] * vectors.T


def rank(singular: np.ndarray) -> int:
    """Directions with more variance than rounding leaves in one that has none."""
    return int((singular > len(singular) * 32 * np.finfo(float).eps * singular.max()).sum())


def factor(rows: DataFrame, centre: Centre) -> np.ndarray:
    """A matrix R with RᵀR equal to the Gram matrix of the centred rows, upper triangular if they have full rank."""
    size, context = len(centre.floor), rows.sparkSession.sparkContext
    chain: list[np.ndarray] = []
    product, one = np.eye(size), np.eye(size)
    for turn in range(ROUNDS):
        shared = context.broadcast((vars(centre), chain))

        def gram(matrix: np.ndarray, shared=shared) -> np.ndarray:
            known, chain = shared.value
            rows = Centre(**known).centred(matrix)
            for f in chain:
                rows = solve_triangular(rows, f)
            return rows.T @ rows

        found = _added(rows, size, gram, (size, size))
        found = (found + found.T) / 2
        scale = np.trace(found)
        composed = root(found) @ product
        # done when all directions that hold anything are orthogonal
        near = int((np.abs(np.linalg.eigvalsh(found) - 1) <= NEAR).sum())
        if scale == 0 or turn and near >= rank(np.linalg.svd(composed, compute_uv=False)):
            break
        shift = 11 * (centre.n * size + size * (size + 1)) * np.finfo(float).eps / 2 * scale if turn == 0 else 0.0
        while True:
            try:
                last = np.linalg.cholesky(found + shift * one).T
                break
            except np.linalg.LinAlgError:
                shift = max(10 * shift, size * np.finfo(float).eps * scale)
        chain = [*chain, last]
        product = last @ product
    return composed


def fit(rows: DataFrame, centre: Centre, components: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit components (rows), their eigenvalues, and the share of the trace each explains."""
    _, singular, axes = np.linalg.svd(factor(rows, centre))
    kept = min(components, rank(singular))
    values = singular**2 / centre.n
    axes = axes[:kept]
    signs = np.sign(axes[np.arange(kept), np.abs(axes).argmax(axis=1)])
    return axes * signs[:, None], values[:kept], values[:kept] / max(values.sum(), 1e-300)


def identity_error(rows: DataFrame, centre: Centre, weights: np.ndarray) -> float:
    """The largest entry of the covariance of the whitened rows minus the identity."""
    size, k = weights.shape
    shared = rows.sparkSession.sparkContext.broadcast((vars(centre), weights))

    def moments(matrix: np.ndarray) -> np.ndarray:
        known, weights = shared.value
        white = Centre(**known).centred(matrix) @ weights
        return np.vstack([white.T @ white, white.sum(axis=0)])

    found = _added(rows, size, moments, (k + 1, k)) / centre.n
    return float(np.abs(found[:k] - np.outer(found[k], found[k]) - np.eye(k)).max())


def whiten(vectors: DataFrame, *, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and identity_error of every row and component.

    `vectors` needs vec_id and embedding. deviation is a decimal, null beyond 38 digits.
    """
    rows = usable(vectors)
    n, sums = totals(rows)
    facts = lambda n, error: [F.lit(n).cast("long").alias("n"), F.lit(error).cast("double").alias("identity_error")]
    order = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    nothing = rows.limit(0).selectExpr("vec_id", "0 AS component", "CAST(0 AS DECIMAL(38,0)) AS deviation", "0D AS whitened", "0D AS explained")
    if not n:
        return nothing.select("*", *facts(0, 0.0)).select(*order)
    centre, size = Centre.of(n, sums), len(sums)
    same = rows.filter(F.size("vector") == size)
    axes, values, explained = fit(same, centre, components)
    if not len(values):
        return nothing.select("*", *facts(n, 0.0)).select(*order)
    weights = (axes / np.sqrt(values)[:, None]).T
    error = identity_error(same, centre, weights)
    shared = rows.sparkSession.sparkContext.broadcast((vars(centre), weights))
    k = len(values)

    def make(batches):
        known, weights = shared.value
        centre = Centre(**known)
        for batch in batches:
            matrix = _matrix(batch, 1, size)
            exact = [Decimal(d) if d < 10**38 else None for d in centre.deviations(matrix)]
            white = centre.centred(matrix) @ weights
            again = np.repeat(np.arange(len(matrix)), k)
            yield (
                batch.column(0).take(pa.array(again)), np.tile(np.arange(1, k + 1, dtype=np.int32), len(matrix)),
                pa.array(exact, pa.decimal128(38, 0)).take(pa.array(again)), white.ravel(),
            )

    made = emit(same, RESULT, make)
    part = F.element_at(F.array(*[F.lit(float(e)) for e in explained]), F.col("component"))
    return made.select("*", part.alias("explained"), *facts(n, error)).select(*order)
