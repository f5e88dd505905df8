import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tidewatch.llm import decontaminate as op

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BENCH = "item_id long, text string"


def split(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(text, items):
    w, hit, found = split(text), set(), set()
    for item, t in items:
        g = split(t)
        n = min(10, len(g))
        for at in range(len(g) - n + 1 if n else 0):
            for p in range(len(w) - n + 1):
                if w[p : p + n] == g[at : at + n]:
                    hit.update(range(p, p + n))
                    found.add(str(item))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


@pytest.fixture(scope="module")
def case():
    rng = random.Random(4)
    vocabulary = [f"v{i}" for i in range(30)] + ["É", "the"]
    make = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, make(rng.choice([1, 3, 9, 10, 14, 40]))) for i in range(12)] + [(3, "the"), (10, make(25)), (100, "x y"), (101, "x y"), (102, "")]
    docs = [make(rng.randrange(0, 80)) for _ in range(60)]
    docs += [make(5) + " " + items[k][1].upper() + ", " + make(7) for k in range(len(items))] + ["", None, "X Y x y", "x"]
    return list(enumerate(docs)), items


@pytest.mark.parametrize("block", [op.BLOCK_WINDOWS, 40])
def test_equals_plain_search(spark, case, block):
    docs, items = case
    marked = op.decontaminate(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame([*items, (None, "the"), (55, None)], BENCH), block_windows=block,
    )
    got = {r[0]: tuple(r)[1:] for r in op.digest(marked).collect()}
    assert got == {d: plain(t, items) for d, t in docs}


def test_odd_rows_and_columns(spark, odd_docs, no_docs):
    items = spark.createDataFrame([(1, "one two"), (1, "one two")], BENCH)
    out = op.decontaminate(odd_docs, items)
    assert out.count() == odd_docs.count()
    assert [(r.n_hit, r["items"]) for r in out.filter("doc_id = 7").collect()] == [(2, ["1"])]
    assert out.filter("text IS NULL").agg(F.sum("n_words")).first()[0] == 0
    assert op.decontaminate(no_docs, items).count() == 0
    nothing = op.decontaminate(odd_docs, items.limit(0))
    assert nothing.filter("contaminated").count() == 0 and nothing.filter("doc_id = 7").first().n_words == 2


def test_prefixes_are_the_rarest_shingles(spark):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(["a b c a b", "b c b c", "a b", "z"])], "doc_id long, text string")
    items = spark.createDataFrame([("i", "a b c q"), ("j", "c a b c"), ("k", "z"), ("l", "b c b c b")], "item string, text string")
    vocabulary, salt = op._vocabulary(items)
    name = {r["id"]: bytes(r["word"]).decode() for r in vocabulary.collect()}
    windows = op._windows(items, 10, salt)
    chosen = op.choose_prefixes(windows, op.count_shingles(docs, op._marks(windows), salt)).collect()
    got = {r["item"]: (" ".join(name[i] for i in r["ids"]), r["offset"]) for r in chosen}
    assert got == {"i": ("a b c q", 2), "j": ("c a b c", 0), "k": ("z", 0), "l": ("b c b c b", 1)}


def test_numbers_and_shingles():
    words = [b"one", b"two", b"one"]
    plain, salted = op.numbers(words), op.numbers(words, b"\0")
    assert plain[0] == plain[2] != plain[1] and (plain != salted).all()
    assert (op.pair_keys(plain[:-1], plain[1:]) >= 0).all() and (op.single_keys(plain) < 0).all()
    assert (0 <= op.bins(op.single_keys(plain))).all()
