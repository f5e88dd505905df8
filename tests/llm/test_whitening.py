import numpy as np
import pytest

from tidewatch.llm import whitening as op

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, data):
    return spark.createDataFrame([(k, [float(x) for x in v], 0) for k, v in enumerate(data)], SCHEMA).repartition(5)


def brute(data):
    x = np.floor(np.asarray(data, np.float32).astype(np.float64) * 1024) + 100_000
    values, vectors = np.linalg.eigh(np.cov(x.T, bias=True).reshape(x.shape[1], -1))
    return x, values[::-1], vectors[:, ::-1].T


def check(out, data, k):
    x, values, axes = brute(data)
    whole = x.astype(np.int64).tolist()
    n, sums = len(whole), [sum(c) for c in zip(*whole, strict=True)]
    assert len(out) == n * k
    for r in out:
        assert r.n == n and r.deviation == sum((n * v - s) ** 2 for v, s in zip(whole[r.vec_id], sums, strict=True))
        assert abs(r.explained / (values[r.component - 1] / values.sum()) - 1) < 1e-9 and r.identity_error < 1e-9
    for j in range(1, k + 1):
        got = np.array([w for _, w in sorted((r.vec_id, r.whitened) for r in out if r.component == j)])
        want = (x - x.mean(axis=0)) @ axes[j - 1] / np.sqrt(values[j - 1])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-6


@pytest.mark.parametrize("size", [1, 5, 24])
def test_equals_an_eigendecomposition(spark, size):
    rng = np.random.default_rng(size)
    data = (rng.normal(size=(300, size)) * np.linspace(1, 3, size) @ np.linalg.qr(rng.normal(size=(size, size)))[0]).astype(np.float32)
    check(op.whiten(frame(spark, data)).collect(), data, min(size, 8))


def test_badly_conditioned_rows(spark):
    rng = np.random.default_rng(2)
    data = (rng.normal(size=(500, 6)) * np.array([3e4, 5e2, 10, 1, 0.1, 0.02])).astype(np.float32)
    check(op.whiten(frame(spark, data)).collect(), data, 6)


def test_directions_without_variance_have_no_component(spark):
    rng = np.random.default_rng(3)
    data = rng.integers(-40, 40, size=(200, 6)) / 1024
    data[:, 2], data[:, 4] = 0.5, data[:, 0] + data[:, 1]
    check(op.whiten(frame(spark, data)).collect(), data, 4)
    assert op.whiten(frame(spark, [[1.0, 2.0]] * 9)).count() == 0 and op.whiten(frame(spark, [[1.0, 2.0]])).count() == 0


def test_exact_beyond_64_bits():
    centre = op.Centre.of(3_000_000_007, [3 * 10**14 + 5, -7])
    rows = np.array([[1.5, -2.25], [0.0, 3.0], [2.0**40, 1.0]])
    want = [sum((centre.n * x - s) ** 2 for x, s in zip(map(int, np.floor(r * 1024)), (3 * 10**14 + 5, -7), strict=True)) for r in rows]
    assert centre.deviations(rows[:2]) == want[:2] and centre.deviations(rows) == want
    assert op._exact_sum(np.full((8, 1), 2**62)) == [2**65] and op._exact_sum(np.full((8, 1), -(2**62) + 1)) == [8 - 2**65]


def test_factors_compose(spark):
    rng = np.random.default_rng(5)
    data = rng.normal(size=(200, 7)).astype(np.float32)
    rows = op.usable(frame(spark, data))
    n, sums = op.totals(rows)
    centre = op.Centre.of(n, sums)
    centred = centre.centred(data.astype(np.float64))
    found = op.factor(rows, centre)
    assert np.abs(centred.mean(axis=0)).max() < 1e-9 and np.abs(np.tril(found, -1)).max() < 1e-12 * np.abs(found).max()
    assert np.allclose(found.T @ found, centred.T @ centred, rtol=1e-12)
    q = op.solve_triangular(centred, found)
    assert np.abs(q.T @ q - np.eye(7)).max() < 1e-12


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, [0.0, 0.0], None), (3, None, 0), (4, [], 0), (5, [nan, 1.0], 0), (6, [inf, 1.0], 0), (7, [None, 1.0], 0),
        (None, [0.5, 0.25], 0), (8, [1.0, 2.0, 3.0], 0), (9, [1e30, 0.0], 0),
    ]
    given = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS n", "'x' AS vector", "2 AS component", "3 AS whitened")
    out = op.whiten(given).collect()
    assert sorted((str(r.vec_id), r.component) for r in out) == sorted((i, c) for i in ("1", "1", "2", "None") for c in (1, 2))
    assert {r.n for r in out} == {4} and all(r.deviation is not None and r.identity_error < 1e-9 for r in out)
    empty = op.whiten(given.limit(0))
    assert empty.count() == 0 and empty.dtypes == op.whiten(given).dtypes
