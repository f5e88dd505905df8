import hashlib
import random

import numpy as np
import pytest
from llm_helpers import DOC, words
from pyspark.sql import functions as F

from tidewatch.llm import mixing, shards


def water_fill(sizes, budget=1.5, epochs=2, weights=(5, 2, 1)):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    cap = {s: epochs * sizes[s] for s in names}
    target, free, left = {}, set(names), budget * sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > cap[s]}
        if not over:
            return target | {s: left * weight[s] / total for s in free}
        for s in over:
            target[s] = cap[s]
        left -= sum(cap[s] for s in over)
        free -= over
    return target


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(6)
    rows = [(k, words(k, rng.randrange(0, 60)), "en", rng.choice(["z", "é", "a", "a", "a", "B", None, "q", ""]), 0) for k in range(900)]
    return spark.createDataFrame(rows, DOC), rows


def test_targets_and_words_taken(mixed):
    docs, rows = mixed
    out = mixing.report(docs).collect()
    source = {r[0]: r[3] for r in rows}
    sizes = {}
    for k, text, _, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len(text.split())
    want = water_fill(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in out:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s]) and r.taken <= 2 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= 60 for s in sizes)
    assert sorted(out) == sorted(mixing.report(docs.repartition(7)).collect())


def test_rows_repeat_as_often_as_taken(mixed):
    docs, _ = mixed
    words_out = mixing.repeat(docs).agg(F.sum(mixing.text_size(F.col("text")))).first()[0]
    assert words_out == mixing.report(docs).agg(F.sum("taken")).first()[0]
    assert mixing.repeat(docs).columns == docs.columns


def test_size_counts_runs_between_the_six_spaces(spark):
    rows = [(" a\tb\x0bc\x0cd\r\ne ",), ("a b",), ("",), (None,), (" \n",)]
    sizes = spark.createDataFrame(rows, "text string").select(mixing.text_size(F.col("text"))).collect()
    assert [r[0] for r in sizes] == [5, 1, 0, 0, 0]


def test_mixing_odd_rows(spark, odd_docs, no_docs):
    out = mixing.report(odd_docs)
    assert out.count() == odd_docs.count() and out.filter("taken > 2 * size").count() == 0
    assert mixing.repeat(odd_docs).columns == odd_docs.columns
    assert mixing.report(no_docs).count() == 0 and mixing.repeat(no_docs).count() == 0
    wordless = mixing.report(spark.createDataFrame([(1, None, "en", "a", 0), (2, "", "en", None, 0)], DOC))
    assert [tuple(r)[1:] for r in wordless.orderBy("doc_id").collect()] == [(0, 0, 0.0, 0)] * 2


@pytest.mark.parametrize("count", [1, 2, 3, 7, 1000, 4096, 5001])
def test_permutation_is_a_bijection(count):
    slots = shards.permute(np.arange(count), count)
    assert sorted(slots) == list(range(count))
    assert np.array_equal(slots[: count // 2], shards.permute(np.arange(count // 2), count))
    if count >= 1000:
        assert (slots != shards.permute(np.arange(count), count, key=5)).mean() > 0.9
        assert abs(np.corrcoef(np.arange(count), slots)[0, 1]) < 0.1


def test_round_trip_through_the_files(spark, tmp_path):
    texts = [words(k, k * 7 % 90) for k in range(50)] + ["", None, "x\n\n  y 東京\n", words(77, 30_000), "a", "a"]
    stored = str(tmp_path / "docs")
    spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(texts)], DOC).repartition(5).write.parquet(stored)
    out = str(tmp_path / "shards")
    index = shards.materialise(spark.read.parquet(stored), out, documents=16).collect()
    assert sorted(r.slot for r in index) == list(range(len(texts)))
    encoder = shards._encoder(shards.VOCABULARY)
    by_slot = {r.slot: r for r in index}
    for shard in range(-(-len(texts) // 16)):
        (path,) = (tmp_path / "shards" / f"shard={shard}").glob("*.txt")
        content = path.read_bytes()
        assert len(content) % shards.STRIDE == 0
        records = [content[k : k + shards.STRIDE - 1] for k in range(0, len(content), shards.STRIDE)]
        stream = np.frombuffer(b"".join(records), "<u2")
        at = 0
        for slot in range(shard * 16, min(len(texts), shard * 16 + 16)):
            row = by_slot[slot]
            want = encoder.encode_ordinary(texts[row.doc_id] or "")
            assert row.first_token == at and row.n_tokens == len(want) and stream[at : at + len(want)].tolist() == want
            assert row.tokens_sha256 == hashlib.sha256(np.array(want, "<u2").tobytes()).hexdigest()
            at += len(want) + 1
        assert (stream[at:] == shards.FILL).all() and len(stream) - at < shards.RECORD


def test_stretches_join_to_the_same_tokens(monkeypatch):
    encoder = shards._encoder(shards.VOCABULARY)
    text = words(3, 400) + "\n\n  tail  of it"
    whole = encoder.encode_ordinary(text)
    monkeypatch.setattr(shards, "STRETCH", 50)
    assert shards.encode(encoder, text).tolist() == whole


def test_shards_odd_rows(spark, odd_docs, no_docs):
    index = shards.materialise(odd_docs)
    assert index.count() == odd_docs.count() and index.filter("doc_id IN (2, 3)").agg(F.sum("n_tokens")).first()[0] == 0
    assert shards.materialise(no_docs).count() == 0


def test_permutation_refuses_numbers_beyond_its_count():
    with pytest.raises(ValueError):
        shards.permute(np.array([0, 70]), 10)


@pytest.mark.parametrize("case", ["filter", "explode", "limit", "sample", "union", "columns", "view"])
def test_parts_and_multiples_of_a_stored_table(spark, tmp_path, case):
    texts = {k: words(k, 1 + k % 7) for k in range(400)}
    stored = str(tmp_path / "docs")
    spark.createDataFrame([(k, t, "en", "s", 0) for k, t in texts.items()], DOC).repartition(2).write.parquet(stored)
    docs = spark.read.parquet(stored)
    docs.createOrReplaceTempView("stored_docs")
    docs = {
        "filter": lambda: docs.filter("doc_id % 100 = 7"), "explode": lambda: docs.selectExpr("*", "explode(array(1, 2, 3)) AS copy"),
        "limit": lambda: docs.limit(30), "sample": lambda: docs.sample(0.2), "union": lambda: docs.union(docs),
        "columns": lambda: docs.withColumn("more", F.length("text")).select("text", "doc_id"), "view": lambda: spark.table("stored_docs"),
    }[case]()
    assert shards.whole_scan(docs) == (case in ("columns", "view"))
    index = shards.materialise(docs, str(tmp_path / "shards"), documents=16).collect()
    assert sorted(r.slot for r in index) == list(range(len(index)))
    copies = {"filter": 4, "explode": 1200, "limit": 30, "union": 800, "columns": 400, "view": 400}
    assert len(index) == copies.get(case, len(index)) > 0
    encoder = shards._encoder(shards.VOCABULARY)
    for r in index:
        want = np.array(encoder.encode_ordinary(texts[r.doc_id]), "<u2")
        assert r.tokens_sha256 == hashlib.sha256(want.tobytes()).hexdigest()
