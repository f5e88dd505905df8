"""Personal data and secrets: base spans against plain patterns, added spans by their method."""

import hashlib
import random
import re
import string

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import pii, secrets

PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SECRETS = {
    "assign": r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    "access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+",
}


def luhn(digits):
    total = 0
    for place, c in enumerate(reversed(digits)):
        doubled = int(c) * (1 + place % 2)
        total += doubled - 9 * (doubled > 9)
    return total % 10 == 0


def passes(kind, m):
    digits = re.sub("[^0-9]", "", m.group())
    if kind == "ip":
        return all(int(p) <= 255 for p in m.group().split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    if kind == "assign":
        return len(m.group(2)) >= 8
    least = {"phone": 9, "access": 16, "hex": 32}.get(kind, 0)
    return (9 <= len(digits) <= 15) if kind == "phone" else len(m.group()) >= least


def plain(text, patterns):
    found = [(m.start(), k, kind, m.end()) for k, (kind, p) in enumerate(patterns.items()) for m in re.finditer(p, text or "") if passes(kind, m)]
    return [f"{kind}:{s}:{e}" for s, _, kind, e in sorted(found)]


@pytest.fixture(scope="module")
def noisy():
    rng = random.Random(11)
    pieces = list("0123456789.@+-%_ ()=:'\"aAfzé東\n") + [
        "4111111111111111", "4111 1111-1111 1111", "1.2.3.4", "256.1.1.1", "a.b@c.de", "+1 (555) 010-9999", "00000255.1.1.001", "Password", "api_KEY", "token=",
        "AKIA", "ABCDEFGH12345678", "deadbeef", "0123456789abcdef" * 2, "secret: '", "Dr. Ada Love", "ſecret=abcdefgh1", "(555) 010-9999",
    ]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(0, 60))) for _ in range(500)]
    return [*enumerate(texts), (1000, None), (1001, ""), (1002, "9" * 40_000 + "@"), (1003, "a" * 40_000), (1004, "x@" + "y." * 20_000 + "z"), (None, "a@b.c")]


@pytest.mark.parametrize(("op", "patterns"), [(pii, PII), (secrets, SECRETS)])
def test_base_spans_equal_plain_patterns(spark, noisy, op, patterns):
    docs = spark.createDataFrame(noisy, "doc_id long, text string")
    rows = {r.doc_id: r for r in op.report(docs).collect()}
    assert len(rows) == len(noisy)
    for doc, text in noisy:
        want, row = plain(text, patterns), rows[doc]
        assert row.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), text
        for kind in patterns:
            assert row[f"n_{kind}"] == sum(w.startswith(kind) for w in want)
        everything = row.spans.split(",") if row.spans else []
        assert set(want) <= set(everything)
        order = [int(x.split(":")[1]) for x in everything]
        assert order == sorted(order)


def test_many_matches_in_one_text(spark):
    text = " ".join(f"u{k}@h.org" for k in range(3000))
    row = pii.report(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.n_email == 3000 and row.base_sha256 == hashlib.sha256(",".join(plain(text, PII)).encode()).hexdigest()


def test_votes_add_numbers_that_look_real(spark):
    rows = [(k, f"please call (212) 555-{1000 + k} now") for k in range(40)] + [(100 + k, f"mail a{k}@b.com or phone +1 212 555 {2000 + k}") for k in range(40)]
    rows += [(200 + k, f"table v{k}: {k:04d} 11 22 33 44 55, page {k}") for k in range(40)]
    spans = {r.doc_id: r.spans for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all("number:" in spans[k] for k in range(40))


def test_reliabilities_find_the_better_labeler(spark):
    rng, rows = random.Random(2), {}
    for _ in range(4000):
        real = rng.random() < 0.4
        say = lambda right: ("y" if real else "n") if rng.random() < right else ("n" if real else "y")  # noqa: B023, E731
        votes = "".join(say(p) for p in (0.95, 0.9, 0.85, 0.6, 0.55))
        rows[votes] = rows.get(votes, 0) + 1
    prior, table = pii.reliabilities(spark.createDataFrame(list(rows.items()), "votes string, n long"))
    assert abs(prior - 0.4) < 0.05 and abs(table["check", "y"][0] - 0.95) < 0.05 and abs(table["surroundings", "y"][0] - 0.55) < 0.08


def test_pii_odd_rows(spark, odd_docs, no_docs):
    assert pii.report(odd_docs).count() == odd_docs.count() and pii.report(no_docs).count() == 0


def test_battery_finds_random_tokens_and_leaves_words(spark):
    rng = random.Random(5)
    parts = "the ing tion and er on re in ed st an or nt ha th".split()
    word = lambda: "".join(rng.choices(parts, k=rng.randrange(2, 9)))
    token = lambda n: "".join(rng.choices(string.ascii_letters + string.digits, k=n))
    docs, planted = [], {}
    for k in range(300):
        text = " ".join(word() for _ in range(150))
        if k % 10 == 0:
            planted[k] = token(40)
            text = f"{text} {planted[k]} {word()}"
        docs.append((k, text))
    rows = {r.doc_id: r for r in secrets.report(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    hits = {k for k, t in planted.items() if f"random:{dict(docs)[k].index(t)}:" in rows[k].spans}
    false = sum("random" in r.spans for d, r in rows.items() if d not in planted)
    assert len(hits) >= 0.9 * len(planted) and false <= 2


def test_chance_accepts_even_and_rejects_repeated_letters():
    rng = np.random.default_rng(1)
    accepted = [secrets.chance_p(rng.integers(0, 16, 40), 16) >= secrets.REJECT for _ in range(300)]
    assert sum(accepted) >= 295 and secrets.chance_p(np.repeat([1, 2], 20), 16) < secrets.REJECT


def test_discovery_is_the_step_up_rule_within_a_length_class(spark):
    schema = "tests array<long>, candidates array<struct<start:int,end:int,encoding:string,length:int,step:int>>"
    spans = [(0, 1, "hex", 0, s) for s in (60, 50, 29, 4)] + [(0, 1, "hex", 2, 4)]
    cuts = secrets.discovery_steps(spark.createDataFrame([([4, 0, 50], spans)], schema))
    assert cuts == {0: 29}


def test_secrets_odd_rows(spark, odd_docs, no_docs):
    out = secrets.report(odd_docs)
    assert out.count() == odd_docs.count() and out.agg(F.count_if(F.col("spans") != "")).first()[0] == 0
    assert secrets.report(no_docs).count() == 0


def test_runs_are_cut_into_pieces_that_one_alphabet_holds():
    cut = lambda run: [run[s:e] for s, e in secrets.pieces(run)]
    a, b, c = "Zk3" * 7, "9fQ" * 6, "x7_" * 6
    assert cut(a) == [a] and cut(a + "==") == [a + "=="] and cut(f"{a}/{b}") == [f"{a}/{b}"]
    assert cut(f"sig={a}") == ["sig", a] and cut(f"=client_key={a}==") == ["client_key", a + "=="] and cut("=" * 20) == []
    assert cut(f"{a}+{b}_{a}{a}") == [a, f"{b}_{a}{a}"] and cut(f"dir/{c}-{b}") == [f"{c}-{b}"]
    assert cut(f"{a}/{b}/{b}_{a}==") == [f"{a}/{b}/{b}", a + "=="] and cut("a-b+" * 9) == []
    for run in ("a-b+" * 20_000 + a, f"{a}-{b}/" * 5000):
        spans = list(secrets.pieces(run))
        assert spans and all(e <= s for (_, e), (s, _) in zip(spans, spans[1:])) and all(secrets.encoding(run[s:e]) for s, e in spans)


# the piece c/... of the prefixed one is tested as a whole, which costs some power
SHAPES = [("sig={}", 0.9), ("client_key={}==", 0.9), ("?session={}", 0.9), ("ab-c/{}", 0.8), ("https://h.example/a_b/?key={}&x=1", 0.9)]


@pytest.mark.parametrize(("shape", "share"), SHAPES)
def test_battery_finds_random_tokens_after_names_and_prefixes(spark, shape, share):
    rng = random.Random(6)
    parts = "the ing tion and er on re in ed st an or nt ha th".split()
    word = lambda: "".join(rng.choices(parts, k=rng.randrange(2, 9)))
    docs, planted = [], {}
    for k in range(300):
        text = " ".join(word() for _ in range(150))
        if k % 10 == 0:
            planted[k] = "".join(rng.choices(string.ascii_letters + string.digits, k=40))
            text = f"{text} {shape.format(planted[k])} {word()}"
        docs.append((k, text))
    rows = {r.doc_id: r for r in secrets.report(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    hits = set()
    for k, token in planted.items():
        at = dict(docs)[k].index(token)
        spans = [s.split(":") for s in rows[k].spans.split(",") if s.startswith("random:")]
        if any(at - 2 <= int(start) <= at and at + 40 <= int(end) <= at + 42 for _, start, end in spans):
            hits.add(k)
    false = sum("random" in r.spans for d, r in rows.items() if d not in planted)
    assert len(hits) >= share * len(planted) and false <= 2
