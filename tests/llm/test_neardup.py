import random

import numpy as np
import pytest
from llm_helpers import DOC, words
from pyspark.sql import functions as F

from tidewatch.llm import neardup as op


def edited(text, edits, seed):
    rng, w = random.Random(seed), text.split()
    for k in range(edits):
        w[rng.randrange(len(w))] = f"e{seed}x{k}"
    return " ".join(w)


def plain_classes(docs, threshold=0.8):
    bags = {d: op.bag(t) for d, t in docs}
    root = {d: d for d, _ in docs}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(bags)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if op.overlap(bags[a], bags[b]) >= threshold:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def frame(spark, docs):
    return spark.createDataFrame([(d, t, None, None, None) for d, t in docs], DOC)


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    element = np.arange(60, dtype=np.uint64) * np.uint64(977)
    a, b = rng.integers(1, 9, 60), rng.integers(1, 9, 60)
    owner = np.repeat([0, 1], 60)
    made = op.signatures(owner, np.tile(element, 2), np.concatenate([a, b]), 2, 4096)
    truth = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((made[0] == made[1]).mean() - truth) < 4 * np.sqrt(truth * (1 - truth) / 4096)


@pytest.mark.parametrize("rounds", [0, 2])
def test_classes_equal_all_pairs(spark, rounds):
    docs, k = [], 0
    for family in range(6):
        base = words(family, 90 + 10 * family)
        for copy in range(14):
            docs.append((k, edited(base, copy % 9, 100 * family + copy)))
            k += 1
    docs += [(k + i, t) for i, t in enumerate([docs[0][1], docs[0][1].upper(), "a b", "a, b", "a b c", "z z z z z z z z", "z z z z z z z"])]
    got = {r.doc_id: r.class_id for r in op.classes(frame(spark, docs), rounds=rounds).collect()}
    assert got == plain_classes(docs)


def test_a_dense_group_is_not_expanded_into_pairs(spark):
    base = words(5, 150)
    docs = [(k, edited(base, 3 + k % 5, k)) for k in range(120)]
    got = {r.doc_id: r.class_id for r in op.classes(frame(spark, docs)).collect()}
    assert got == plain_classes(docs)


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(bytes([k + 1]), bytes([k])) for k in range(40)] + [(b"\xf1", b"\xf0")], "a binary, b binary")
    roots = {bytes(r.node): bytes(r.root) for r in op.components(edges).collect()}
    assert roots == {bytes([k]): bytes([0]) for k in range(1, 41)} | {b"\xf1": b"\xf0"}


def test_odd_rows_and_columns(spark, odd_docs, no_docs):
    out = op.classes(odd_docs)
    assert out.count() == odd_docs.count() and out.columns == ["doc_id", "class_id", "class_rows"]
    wordless = out.filter("doc_id IN (2, 3, 4)").collect()
    assert all(r.class_id == r.doc_id and r.class_rows == 1 for r in wordless)
    assert sorted(r.class_rows for r in out.filter("doc_id = 1").collect()) == [1, 2, 2]
    kept = op.keep_first(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 1
    assert op.classes(no_docs).count() == 0 and op.keep_first(no_docs).count() == 0


def test_keep_first_keeps_the_smallest_id(spark):
    base = words(8, 100)
    docs = frame(spark, [(9, base), (4, edited(base, 1, 1)), (6, base), (2, words(3, 50))])
    assert sorted(r.doc_id for r in op.keep_first(docs).collect()) == [2, 4]
    assert op.classes(docs).agg(F.max("class_rows")).first()[0] == 3
