"""Secret scans: base patterns, and a battery of randomness tests under false-discovery control.

Base spans (assignments to secret names, access keys, long hex strings) always stay. Every further run of at least
`SHORTEST` token characters is a candidate. Its encoding is inferred from the characters it uses (decimal, hex, base32,
alphanumeric, base64). A run is cut at = signs other than its padding, and what no alphabet holds (- or _ beside + or /) into the
longest pieces that one does, each a candidate of its own. The battery runs on the letters as numbers of the alphabet:

* chi-squared: are the letters spread evenly over the alphabet?
* runs: do low and high letters alternate as often as they would by chance?
* serial correlation: is a letter independent of the one before?

Each test is read twice. Against chance, a candidate that any test rejects (Bonferroni over the three, at `REJECT`) is no
secret. Against ordinary text, the p-value is the chance that a token drawn from the characters of this corpus would look
as even, as alternating and as uncorrelated: moments of the three statistics follow from the letter and letter-pair frequencies of all
documents, and Stouffer's sum joins the three. Benjamini-Hochberg at level `LEVEL` then decides in each length class
by itself, so many short tokens do not drown few long ones. P-values are rounded up to a fixed grid, which keeps the control and makes
the cut a matter of counts: nothing but counts per length class and grid step is gathered, whatever the corpus.

Offsets are code points, end exclusive. Null texts are empty. Added spans have the kind `random` and touch no base span. Extra columns
are ignored.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.rowwise import emit, with_columns
from tidewatch.session import materialize

#: Base kinds in their listed order: pattern, group that must be long enough, and its least length.
BASE = {
    "assign": (r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]+", 0, 32),
}
SHORTEST = 16
TOKEN = r"[A-Za-z0-9+/_=-]{%d,}" % SHORTEST
#: What lies between = signs, with the padding of the run; and the largest alphabets, which hold all others.
BETWEEN = r"[^=]+(?:=+\Z)?"
WIDEST = (r"[A-Za-z0-9+/]+=*", r"[A-Za-z0-9_-]+=*")
LEVEL, REJECT = 0.01, 1e-4
#: Steps of the p-value grid, each a factor of 2 ** (1/4).
GRID = 400
#: Length classes are [16,24), [24,32), [32,48), ... and all beyond the last.
LENGTHS = (24, 32, 48, 64, 96, 128, 256)

# Alphabets by encoding, letters in the order of their numbers: fixed values.
ALPHABETS = {
    "decimal": "0123456789",
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "alnum": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}


def numbers(alphabet: str) -> np.ndarray:
    """Number of each ASCII code in the alphabet, -1 outside."""
    table = np.full(128, -1, np.int64)
    table[np.frombuffer(alphabet.encode(), np.uint8)] = np.arange(len(alphabet))
    return table


def encoding(token: str) -> str | None:
    """The smallest alphabet that holds all letters of a token, trailing padding aside."""
    letters = set(token.rstrip("="))
    return next((name for name, alphabet in ALPHABETS.items() if letters and letters <= set(alphabet)), None)


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, place of the kind, end, kind) of the base spans of a text, in that order."""
    found = []
    for place, (kind, (pattern, group, least)) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text, re.ASCII):
            if len(m.group(group)) >= least:
                found.append((m.start(), place, m.end(), kind))
    return sorted(found)


def longest_pieces(run: str) -> list[tuple[int, int]]:
    """(start, end) of the pieces of a run that one alphabet holds: the longest first, then the longest of what is left."""
    waiting = [(m.start() - m.end(), m.start(), m.end()) for pattern in WIDEST for m in re.finditer(pattern, run)]
    heapq.heapify(waiting)
    used, found = bytearray(len(run)), []
    while waiting and -waiting[0][0] >= SHORTEST:
        _, start, end = heapq.heappop(waiting)
        first, last = start, end
        while first < last and used[first]:  # only the ends of a piece can lie in longer ones
            first += 1
        while last > first and used[last - 1]:
            last -= 1
        if (first, last) == (start, end):
            used[start:end] = b"\1" * (end - start)
            found.append((start, end))
            continue
        while first < last and first > start and run[first] in "+/_-":
            first += 1
        while first < last < end and run[last - 1] in "+/_-":
            last -= 1
        heapq.heappush(waiting, (first - last, first, last))
    return sorted(found)


def pieces(run: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the candidates in a run of token characters, in order."""
    for m in re.finditer(BETWEEN, run):
        if encoding(m.group()) is not None:
            yield m.start(), m.end()
        else:
            for start, end in longest_pieces(m.group()):
                yield m.start() + start, m.start() + end


def other_tokens(text: str, taken: list[tuple[int, int, int, str]]) -> Iterator[tuple[int, int, str]]:
    """(start, end, token) of candidates that touch no base span."""
    spans = sorted((s, e) for s, _, e, _ in taken)
    k = 0
    for m in re.finditer(TOKEN, text):
        for start, end in pieces(m.group()):
            start, end = m.start() + start, m.start() + end
            while k < len(spans) and spans[k][1] <= start:
                k += 1
            if not any(s < end and start < e for s, e in spans[k : k + 3]):
                yield start, end, text[start:end]


def statistics(codes: np.ndarray, size: int) -> tuple[float, float, float]:
    """Of letters as numbers: pairs of equal letters, changes between low and high half, and lag-one product sum."""
    counts = np.bincount(codes, minlength=size)
    high = codes >= size // 2
    level = codes - (size - 1) / 2
    return float((counts * (counts - 1) // 2).sum()), float((high[1:] != high[:-1]).sum()), float((level[1:] * level[:-1]).sum())


def moments(n: int, first: np.ndarray, pairs: np.ndarray) -> list[tuple[float, float]]:
    """Mean and variance of the three statistics for n letters with frequencies `first` and neighbour frequencies `pairs`.

    The number of equal pairs is the chi-squared statistic up to scale. Changes and products are sums over n - 1 neighbours,
    taken as independent.
    """
    size = len(first)
    p2, p3 = float((first**2).sum()), float((first**3).sum())
    two, three = n * (n - 1) / 2, n * (n - 1) * (n - 2) / 6
    equal = two * p2, two * (p2 - p2 * p2) + 6 * three * (p3 - p2 * p2)
    high = np.arange(size) >= size // 2
    change = float(pairs[high][:, ~high].sum() + pairs[~high][:, high].sum())
    level = np.arange(size) - (size - 1) / 2
    product = np.outer(level, level)
    mean, square = float((pairs * product).sum()), float((pairs * product**2).sum())
    return [equal, ((n - 1) * change, (n - 1) * change * (1 - change)), ((n - 1) * mean, (n - 1) * (square - mean * mean))]


def _score(value: float, mean: float, variance: float) -> float:
    return (value - mean) / math.sqrt(variance) if variance > 1e-12 else 0.0


def _tail(z: float) -> float:
    """Chance that a standard normal number is below z."""
    return 0.5 * math.erfc(-z / math.sqrt(2))


def chance_p(codes: np.ndarray, size: int) -> float:
    """Smallest two-sided p-value of the battery against an even, independent alphabet, times three."""
    even = np.full(size, 1 / size)
    scores = [_score(v, *m) for v, m in zip(statistics(codes, size), moments(len(codes), even, np.outer(even, even)), strict=True)]
    return min(1.0, 3 * min(2 * _tail(-abs(z)) for z in scores))


def text_p(codes: np.ndarray, first: np.ndarray, pairs: np.ndarray) -> float:
    """Chance that ordinary text looks as random as these letters."""
    size = len(first)
    found, expected = statistics(codes, size), moments(len(codes), first, pairs)
    equal, change, product = (_score(v, *m) for v, m in zip(found, expected, strict=True))
    _, even_change, even_product = moments(len(codes), np.full(size, 1 / size), np.full((size, size), 1 / size**2))
    toward = [-equal]  # fewer equal pairs, and changes and products on chance's side of what text has
    toward.append(change if even_change[0] >= expected[1][0] else -change)
    toward.append(product if even_product[0] >= expected[2][0] else -product)
    return _tail(-sum(toward) / math.sqrt(3))


def character_counts(docs: DataFrame) -> np.ndarray:
    """How often each ASCII character follows another inside a token, over all documents; 128 x 128."""

    def count(batches):
        pairs = np.zeros(128 * 128, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                codes = np.frombuffer((text or "").encode("ascii", "replace"), np.uint8).astype(np.int64)
                pairs += np.bincount(codes[:-1] * 128 + codes[1:], minlength=128 * 128)
        used = np.flatnonzero(pairs)
        yield used, pairs[used]

    rows = emit(docs.select("text"), "pair long, n long", count).groupBy("pair").agg(F.sum("n").alias("n"))
    out = np.zeros(128 * 128, np.float64)
    for pair, n in rows.collect():  # at most 128 x 128 rows
        out[pair] = n
    return out.reshape(128, 128)


def text_models(pairs: np.ndarray) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Letter and neighbour frequencies of the corpus within each alphabet."""
    models = {}
    for name, alphabet in ALPHABETS.items():
        codes = np.frombuffer(alphabet.encode(), np.uint8)
        own = pairs[np.ix_(codes, codes)] + 1e-6
        letters = own.sum(axis=0) + own.sum(axis=1)
        models[name] = letters / letters.sum(), own / own.sum()
    return models


def _length_class(n: int) -> int:
    return sum(n >= edge for edge in LENGTHS)


def _step(p: float) -> int:
    """Grid step of a p-value, rounded up: step k stands for 2 ** (-k / 4)."""
    return min(GRID, max(0, math.floor(-4 * math.log2(max(p, 1e-300)))))


def _tested(docs: DataFrame, models: dict) -> DataFrame:
    """doc_id, base spans and the candidates that chance does not reject, with length class and grid step."""
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def scan(texts):
        models, tables = shared.value, {name: numbers(a) for name, a in ALPHABETS.items()}
        base, candidates, tests = [], [], []
        for text in texts:
            taken = base_spans(text or "")
            own, seen = [], [0] * (len(LENGTHS) + 1)
            for start, end, token in other_tokens(text or "", taken):
                name = encoding(token)
                if name is None:
                    continue
                codes = tables[name][np.frombuffer(token.rstrip("=").encode(), np.uint8)]
                if len(codes) < SHORTEST:
                    continue
                kind = _length_class(len(codes))
                seen[kind] += 1
                p = text_p(codes, *models[name])
                if p < 0.5 and chance_p(codes, len(ALPHABETS[name])) >= REJECT:
                    own.append({"start": start, "end": end, "encoding": name, "length": kind, "step": _step(p)})
            base.append([{"start": s, "end": e, "kind": k} for s, _, e, k in taken])
            candidates.append(own)
            tests.append(seen)
        return base, candidates, tests

    schema = (
        "base array<struct<start:int,end:int,kind:string>>, tests array<long>, "
        "candidates array<struct<start:int,end:int,encoding:string,length:int,step:int>>"
    )
    swapped = lambda texts: (lambda b, c, t: (b, t, c))(*scan(texts))
    return with_columns(docs.select("doc_id", "text"), schema, swapped).drop("text")


def discovery_steps(tested: DataFrame) -> dict[int, int]:
    """Benjamini-Hochberg by length class: the lowest grid step that counts as found; none where nothing does."""
    sizes = tested.select(F.posexplode("tests").alias("length", "n")).groupBy("length").agg(F.sum("n").alias("n"))
    total = {r["length"]: r["n"] for r in sizes.collect()}
    spans = tested.select(F.explode("candidates").alias("c")).groupBy("c.length", "c.step").agg(F.count(F.lit(1)).alias("n"))
    found: dict[int, list[tuple[int, int]]] = {}
    for length, step, n in spans.collect():  # at most classes x grid steps
        found.setdefault(length, []).append((step, n))
    cuts = {}
    for length, steps in found.items():
        below = 0
        for step, n in sorted(steps, reverse=True):
            below += n
            if 2 ** (-step / 4) <= LEVEL * below / total[length]:
                cuts[length] = step
    return cuts


def find(docs: DataFrame) -> DataFrame:
    """doc_id, base (start, end, kind) and random (start, end, encoding) spans of every document."""
    tested = materialize(_tested(docs, text_models(character_counts(docs))), "secret_tests")
    cuts = discovery_steps(tested)
    bounds = F.create_map(*[F.lit(x) for pair in sorted(cuts.items()) for x in pair]) if cuts else None

    def holds(c: Column) -> Column:
        return c["step"] >= F.element_at(bounds, c["length"]) if cuts else F.lit(False)

    kept = F.filter("candidates", lambda c: F.coalesce(holds(c), F.lit(False)))
    return tested.select("doc_id", "base", F.transform(kept, lambda c: F.struct(c["start"], c["end"], c["encoding"])).alias("random"))


def _listed(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans as text."""
    found = find(docs)
    place = F.create_map(*[F.lit(x) for k, kind in enumerate([*BASE, "random"]) for x in (kind, k)])
    full = lambda s, kind: F.struct(s["start"].alias("start"), F.element_at(place, kind).alias("place"), s["end"].alias("end"), kind.alias("kind"))
    everything = F.array_sort(F.concat(F.transform("base", lambda s: full(s, s["kind"])), F.transform("random", lambda s: full(s, F.lit("random")))))
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[of(k) for k in BASE], F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), _listed(everything).alias("spans"))
