import random

import numpy as np
from llm_helpers import DOC

from tidewatch.llm import langid, quality

SYLLABLES = {"aa": "ka ri mo ta le su", "bb": "sch ung ein ver ich tz", "cc": "eau oi ment que tion"}


def sentence(lang, seed, n=40):
    rng = random.Random(f"{lang}{seed}")
    parts = SYLLABLES[lang].split()
    return " ".join("".join(rng.choices(parts, k=rng.randrange(1, 4))) for _ in range(n)) + "."


def documents(spark):
    rows = [(k, sentence(lang, k), lang, "s", 0) for k in range(120) for lang in [list(SYLLABLES)[k % 3]]]
    return spark.createDataFrame(rows, DOC)


def test_languages_of_held_out_texts(spark):
    docs = documents(spark)
    out = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert any(r.held_out for r in out) and all(r.lang_pred == r.lang and 0 <= r.score <= 1 for r in out)


def test_bundle_is_the_sum_of_bound_letters():
    letters, table = langid.letter_vectors(), langid.symbol_table()
    owner, runs, counts = langid.run_counts(["Ab ab", "é!"], table)
    got = langid.bundle(owner, runs, counts.astype(np.float32), 2, letters)
    s = lambda c: letters[table[ord(c)] if c != " " else 0]
    spell = lambda t: sum(np.roll(s(x), 2) * np.roll(s(y), 1) * s(z) for x, y, z in zip(t, t[1:], t[2:], strict=False))
    assert np.array_equal(got[0], spell(" ab ab ")) and np.array_equal(got[1], spell(" é "))


def test_odd_texts_have_no_language(spark, odd_docs, no_docs):
    out = langid.identify(odd_docs)
    rows = {r.doc_id: r for r in out.collect()}
    assert out.count() == odd_docs.count() and out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    assert all((rows[d].lang_pred, rows[d].score) == ("und", 0.0) for d in (2, 3, 4))
    assert rows[6].lang_pred in ("en", "de", "fr") and not rows[None].held_out
    assert langid.identify(no_docs).count() == 0
    unlabelled = langid.identify(odd_docs.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang"))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}


def test_long_texts_are_read_whole():
    table = langid.symbol_table()
    text = sentence("bb", 1, 400_000)
    assert len(text) > langid.PIECE
    _, _, counts = langid.run_counts([text], table)
    assert counts.sum() > len(text) * 0.95


def labelled(spark):
    docs, labels = [], []
    for k in range(400):
        good = k % 4 != 0
        text = sentence("aa", k, 60)
        docs.append((k, text if good else " ".join(w + "###" for w in text.split()), "aa", "s", 0))
        labels.append((k, int(good), 0))
    return spark.createDataFrame(docs, DOC), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_of_held_out_documents(spark):
    docs, labels = labelled(spark)
    out = quality.classify(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert len(held) > 50 and sum(r.predicted == r.quality for r in held) / len(held) > 0.97
    assert all(r.predicted == int(r.score >= 0.5) for r in out)


def test_contexts_are_sums_of_neighbours():
    places, signs = quality.index_vectors()
    table = np.zeros((quality.BUCKETS, quality.DIMENSIONS), np.int64)
    quality.add_contexts(table, np.array([5, 6, 7, 6]), np.array([0, 0, 0, 1]), places, signs)
    want = np.zeros_like(table)
    for here, there in ((5, 6), (6, 5), (6, 7), (7, 6), (5, 7), (7, 5)):
        np.add.at(want[here], places[there], signs[there])
    assert np.array_equal(table, want)


def test_temperature_flattens_overconfident_scores():
    rng = np.random.default_rng(3)
    z = rng.normal(0, 2, 4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-z))).astype(float)
    assert 2.5 < quality.temperature(3 * z, y) < 3.5


def test_odd_rows_and_labels(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (1, None), (None, 1), (5, 1), (99, 0), (7, None)], "doc_id long, quality int")
    out = quality.classify(odd_docs, labels)
    assert out.count() == odd_docs.count() and out.columns == ["doc_id", "held_out", "score", "predicted"]
    assert all(0 <= r.score <= 1 for r in out.collect())
    assert {r.score for r in quality.classify(odd_docs, labels.limit(0)).collect()} == {0.5}
    assert quality.classify(no_docs, labels).count() == 0
