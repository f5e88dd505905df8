import numpy as np
import pytest

from tidewatch.llm import spherical as op

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], k) for i, v, k in rows], SCHEMA).repartition(4)


def brute(rows, threshold=0.93):
    """n_links, component_id, kept per row, by all pairs."""
    ok = [
        v is not None and k is not None and len(v) > 0 and all(x is not None and np.isfinite(np.float32(x)) for x in v) and any(np.float32(x) != 0 for x in v)
        for _, v, k in rows
    ]
    unit = [np.asarray(v, np.float32).astype(np.float64) / np.linalg.norm(np.asarray(v, np.float32).astype(np.float64)) if o else None for (_, v, _), o in zip(rows, ok, strict=True)]
    near = [[j for j in range(len(rows)) if j != i and ok[i] and ok[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold] for i in range(len(rows))]
    out = []
    for i in range(len(rows)):
        seen, open_rows = {i}, [i]
        while open_rows:
            for j in near[open_rows.pop()]:
                if j not in seen:
                    seen.add(j)
                    open_rows.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        first = min(ids, default=None)
        out.append((rows[i][0], len(near[i]), first, rows[i][0] == first))
    return sorted(out, key=str)


def found(out):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in out.collect()), key=str)


def clustered(seed, n, size, spread):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, size))
    rows = centres[rng.integers(0, 12, n)] + spread * rng.normal(size=(n, size))
    return [(int(i), v, int(k)) for i, v, k in zip(rng.permutation(n), rows, rng.integers(0, 2, n), strict=True)]


@pytest.mark.parametrize("settings", [{}, {"cell": 60, "block": 25}, {"cell": 20, "block": 400, "cells": 5}, {"cell": 1, "block": 1, "cells": 3}])
@pytest.mark.parametrize("spread", [0.03, 0.3, 0.6])
def test_equals_all_pairs(spark, settings, spread):
    rows = clustered(int(100 * spread), 70 if settings.get("block") == 1 else 240, 8, spread)
    assert found(op.groups(frame(spark, rows), **settings)) == brute(rows)


def test_noise_with_few_links(spark):
    rng = np.random.default_rng(4)
    data = rng.normal(size=(300, 48))
    for k in range(0, 60, 3):
        data[k + 1] = data[k] * 3 + 0.5 * rng.normal(size=48)
    rows = [(k, v, 7) for k, v in enumerate(data)]
    got = found(op.groups(frame(spark, rows), cell=40, block=30))
    assert got == brute(rows) and sum(r[1] for r in got) >= 40


def test_a_large_group_of_near_copies_is_settled_by_counting(spark, monkeypatch):
    rng = np.random.default_rng(6)
    centre = rng.normal(size=16)
    rows = [(k, centre + 0.02 * rng.normal(size=16), 1) for k in range(400)] + [(1000 + k, rng.normal(size=16), 1) for k in range(60)]
    pairs = []
    monkeypatch.setattr(op, "_pairs", lambda *a, made=op._pairs: pairs.append(made(*a)) or pairs[-1])
    assert found(op.groups(frame(spark, rows), cell=50, block=40)) == brute(rows)
    sure = pairs[0].filter("sure").count()
    assert sure > 0.5 * pairs[0].filter("NOT visitor_b").count()


def test_tasks_hand_on_few_more_rows_than_the_fit_takes(spark, monkeypatch):
    rows = clustered(8, 900, 6, 0.3)
    kind, ordered, fitted = type(spark.range(0)), [], []
    monkeypatch.setattr(op, "SAMPLE", 40)
    monkeypatch.setattr(kind, "limit", lambda self, n, made=kind.limit: (n == 40 and ordered.append(self.count()), made(self, n))[1])
    monkeypatch.setattr(op, "spherical_kmeans", lambda given, k, made=op.spherical_kmeans: fitted.append(given) or made(given, k))
    assert found(op.groups(frame(spark, rows), cell=60, block=25)) == brute(rows)
    assert len(ordered) == 1 and 40 <= ordered[0] <= 40 + 16 * 40**0.5
    assert fitted[0].shape == (40, 6) and np.allclose(np.linalg.norm(fitted[0], axis=1), 1)


def test_the_fit_takes_the_smallest_nodes(spark, monkeypatch):
    monkeypatch.setattr(op, "SAMPLE", 30)
    nodes = spark.range(0, 3000, 1, 16).selectExpr("unhex(concat(lpad(hex(xxhash64(id)), 16, '0'), lpad(hex(id), 16, '0'))) AS node", "array(cast(id + 1 AS float), -2f) AS vector")
    smallest = sorted((bytes(r.node), r.vector) for r in nodes.collect())[:30]
    assert np.allclose(op._sample(nodes, 3000), op.unit(np.array([v for _, v in smallest])))
    assert op._sample(nodes.limit(5), 5).shape == (5, 2)


def test_copies_and_ids(spark):
    a, b = [1.0, 2.0, 3.0], [-1.0, 2.0, 0.5]
    rows = [(5, a, 1), (5, a, 1), (3, a, 1), (9, [2.0, 4.0, 6.01], 1), (None, a, 1), (1, a, 2), (7, b, 1), (None, b, 3), (None, b, 3)]
    got = found(op.groups(frame(spark, rows)))
    assert got == brute(rows) and (3, 4, 3, True) in got and (None, 1, None, True) in got
    kept = op.representatives(frame(spark, rows))
    assert kept.columns == ["vec_id", "embedding", "label"] and sorted(str(r.vec_id) for r in kept.collect()) == ["1", "3", "7", "None"]


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [1.0, 0.0], None), (3, None, 1), (4, [], 1), (5, [0.0, 0.0], 1), (6, [nan, 1.0], 1), (7, [inf, 1.0], 1), (8, [None, 1.0], 1),
        (9, [1.0, 0.0, 0.0], 1), (10, [1e30, 0.0], 1), (11, [1e-30, 0.0], 1), (12, [-1.0, 0.0], 1),
    ]
    given = frame(spark, rows).selectExpr("*", "1 AS node", "'x' AS kept", "2 AS size", "3 AS weight", "4 AS component_id", "5 AS vector")
    for settings in ({}, {"cell": 1, "block": 1}):
        got = found(op.groups(given, **settings))
        assert got == brute(rows) and (1, 2, 1, True) in got
    kept = op.representatives(given)
    assert kept.columns == given.columns and sorted(r.vec_id for r in kept.collect()) == [1, 2, 3, 4, 5, 6, 7, 8, 9, 12]
    empty = op.groups(given.limit(0))
    assert empty.count() == 0 and empty.columns == ["vec_id", "n_links", "component_id", "kept"] and op.representatives(given.limit(0)).count() == 0


def test_spanning_links_connect_the_same():
    rng = np.random.default_rng(1)
    for density in (0.0, 0.02, 0.1, 0.6, 1.0):
        links = rng.random((40, 30)) < density
        row, column = op.spanning(links)
        assert links[row, column].all() and len(row) <= 69

        def joined(pairs):
            group = list(range(70))
            for r, c in pairs:
                x, y = group[r], group[40 + c]
                group = [min(x, y) if g in (x, y) else g for g in group]
            return group

        assert joined(zip(*np.nonzero(links), strict=True)) == joined(zip(row, column, strict=True))


def test_centroids_and_angles():
    rng = np.random.default_rng(2)
    rows = op.unit(rng.normal(size=(500, 6)))
    centroids = op.spherical_kmeans(rows, 9)
    assert centroids.shape == (9, 6) and np.allclose(np.linalg.norm(centroids, axis=1), 1)
    assert len(op.spherical_kmeans(np.repeat(rows[:2], 50, axis=0), 9)) == 2
    assert abs(op.angles(np.array([[1.0, 1e-9]]), np.array([1.0, 0.0]))[0] - 1e-9) < 1e-15
