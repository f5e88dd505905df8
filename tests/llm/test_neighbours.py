import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import neighbours as op

SCHEMA = "vec_id long, embedding array<float>, label int"


def asked():
    return F.col("vec_id") % 10 == 0


def brute(vectors, k=10):
    out = {}
    for q, v in vectors.items():
        if q % 10 == 0:
            apart = sorted((float(np.sqrt(np.cumsum((w - v) ** 2)[-1])), i) for i, w in vectors.items() if i != q)[:k]
            out[q] = [(i, d) for d, i in apart]
    return out


@pytest.mark.parametrize("block", [op.BLOCK, 150])
@pytest.mark.parametrize("spread", [0.0, 0.5])
def test_equals_brute_force(spark, monkeypatch, block, spread):
    monkeypatch.setattr(op, "BLOCK", block)
    monkeypatch.setattr(op, "QUERIES", 40)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 24))
    data = (spread * rng.normal(size=(700, 24)) + centres[rng.integers(0, 6, 700)] + (spread == 0) * rng.normal(size=(700, 24))).astype(np.float32)
    data[5] = data[10]
    frame = spark.createDataFrame([(k, v.tolist(), 0) for k, v in enumerate(data)], SCHEMA)
    found = {}
    for r in op.nearest(frame, asked()).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute({k: v.astype(np.float64) for k, v in enumerate(data)})
    assert found.keys() == want.keys()
    recall = np.mean([len({i for i, _ in found[q]} & {i for i, _ in want[q]}) / 10 for q in want])
    assert recall >= 0.99
    for q, rows in found.items():
        exact = dict(want[q])
        assert all(exact.get(i, d) == d for i, d in rows) and rows == sorted(rows, key=lambda x: (x[1], x[0]))


def test_quantile_of_the_stopping_test():
    rng = np.random.default_rng(0)
    law = (rng.normal(size=(200_000, 10)) ** 2).sum(axis=1)
    assert abs((law <= op.chi_square_quantile(0.95, 10)).mean() - 0.95) < 0.003


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (10, [1.0, 0.0], 0), (10, [1.0, 0.0], 0), (20, [0.0, 1.0], None), (1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (2, None, 0), (3, [], 0), (30, [0.0, 0.0], 0),
        (4, [nan, 1.0], 0), (40, [inf, 1.0], 0), (5, [None, 1.0], 0), (None, [1.0, 0.5], 0), (6, [1.0, 2.0, 3.0], 0),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS vector", "2 AS score", "3 AS rank")
    out = op.nearest(frame, asked()).orderBy("query_id", "rank").collect()
    root = float(np.sqrt(2.0))
    assert [tuple(r) for r in out] == [(10, 1, 1, 0.0), (10, 2, 20, root), (20, 1, 1, root), (20, 2, 10, root)]
    empty = op.nearest(spark.createDataFrame([], SCHEMA), asked())
    assert empty.count() == 0 and empty.columns == ["query_id", "rank", "vec_id", "score"]


@pytest.mark.parametrize("size", [24, 100])
def test_copies_of_a_query_in_many_leaves(spark, size):
    rng = np.random.default_rng(8)
    data = rng.normal(size=(1500, size)).astype(np.float32)
    data[rng.permutation(1500)[:900]] = data[0]
    frame = spark.createDataFrame([(k, v.tolist(), 0) for k, v in enumerate(data)], SCHEMA).coalesce(1)
    same = [k for k, v in enumerate(data) if k and np.array_equal(v, data[0])]
    # a single query is multiplied in another order than a block of rows
    found = op.nearest(frame, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r.vec_id, r.score) for r in found] == [(k, 0.0) for k in same[:10]]


def test_an_id_of_many_vectors_is_a_candidate_with_each(spark):
    rng = np.random.default_rng(4)
    rows = [(0, [0.0, 1.0, 0.0])] + [(7, [0.0, 1.0, (k + 1) / 1000]) for k in range(4)] + [(k, [0.0, 1.0, float(k)]) for k in range(1, 30) if k != 7]
    many = [(0, [0.0, 1.0, 0.0])] + [(7, [0.0, 1.0, (k + 1) / 1000]) for k in range(50)] + rows[5:]
    for given in (rows, many):
        given = [given[k] for k in rng.permutation(len(given))]
        frame = spark.createDataFrame([(k, v, 0) for k, v in given], SCHEMA)
        found = op.nearest(frame, F.col("vec_id") == 0).orderBy("rank", "vec_id").collect()
        want = sorted((float(np.float32(v[2])), k) for k, v in given if k)[:10]
        assert [(r.rank, r.vec_id, r.score) for r in found] == [(n, k, d) for n, (d, k) in enumerate(want, 1)]
