from fractions import Fraction
from itertools import permutations

import pytest
from llm_helpers import words

from tidewatch.llm import audit as op

LABELS = "doc_id long, quality int, toxic int"


def fails(text, smaller):
    """Filters that a text fails, read off their definition."""
    split = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text) if w]
    found = ""
    found += "A" * (len(split) < 200) + "B" * (100 * len(set(split)) < 50 * len(split))
    found += "C" * (100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text)) + "D" * any(c in "#$%&*|" for c in text)
    return found + "E" * (text in smaller)


def brute(docs, labels):
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    rows, out = [], {}
    for d, text, lang in docs:
        text = text or ""
        smaller = {t or "" for e, t, _ in docs if d is not None and e is not None and e < d}
        rows.append((lang or "", fails(text, smaller), d in good, d in toxic))
    for part in {r[0] for r in rows}:
        totals = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                every = [r for r in rows if r[0] == part and f in r[1]]
                left = [r for r in left if f not in r[1]]
                totals[f] += len(gone)
                alone = sum(r[1] == f for r in every)
                out[part, "".join(order), step] = [f, len(left), len(gone), len(every) - len(gone), alone, sum(r[2] for r in gone), sum(r[3] for r in gone)]
        for k, v in out.items():
            if k[0] == part:
                v.append(totals[v[0]])
    return {k: tuple(v[1:]) for k, v in out.items()}


def frame(spark, docs):
    return spark.createDataFrame([(d, t, lang, None, None) for d, t, lang in docs], "doc_id long, text string, lang string, source string, n_chars long")


def found(out):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in out.collect()}


def test_equals_running_every_order(spark):
    long, same = words(1, 260), " ".join(["again"] * 240)
    texts = [
        long, long, words(2, 260), words(3, 260) + " 50%", words(4, 199), words(5, 200), same, same + " #", long.upper(), None, "", "short | text",
        words(6, 240) + " " + "Ä" * 90, words(7, 230) + " A" * 40, "x y " * 210, "tab\tsep\x0bnl\nend " * 70,
    ]
    docs = [(k, t, ["en", "de", None, ""][k % 4]) for k, t in enumerate(texts * 3)]
    labels = [(k, k % 2, int(k % 3 == 0)) for k in range(0, 40, 2)] + [(4, 1, None), (None, 1, 1), (900, 1, 1)]
    got = found(op.audit(frame(spark, docs), spark.createDataFrame(labels, LABELS)))
    assert got == brute(docs, labels) and len(got) == 3 * 600


def test_shares_are_the_means_of_all_orders():
    counts = {m: (m * 7919) % 23 for m in range(op.ALL + 1)}
    removed = op.removals(counts)
    shares = op.shares(removed)
    want = [Fraction(0)] * 5
    for order in permutations(range(5)):
        before = 0
        for k in order:
            want[k] += Fraction(removed[before | 1 << k] - removed[before], 120)
            before |= 1 << k
    assert shares == want and sum(shares) == removed[op.ALL] and op.removals({})[op.ALL] == 0


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, None), (1, 0, 1), (None, 1, 1)], LABELS).selectExpr("*", "'x' AS part", "1 AS text")
    out = found(op.audit(odd_docs, labels))
    assert out == brute([(r.doc_id, r.text, r.lang) for r in odd_docs.collect()], [(1, 1, None), (1, 0, 1), (None, 1, 1)])
    assert op.audit(no_docs, labels.limit(0)).count() == 0
    assert found(op.audit(odd_docs, labels.limit(0))).keys() == out.keys()


@pytest.mark.parametrize("copies", [1, 400])
def test_copies_pass_once_across_parts(spark, copies):
    docs = [(k, words(1, 220), ["en", "de"][k % 2]) for k in range(copies, 0, -1)]
    got = found(op.audit(frame(spark, docs), spark.createDataFrame([], LABELS)))
    first = {("de" if k % 2 else "en") for k in (1,)}
    assert all(got[p, "EABCD", 1][0] == (p in first) for p in {d[2] for d in docs})
