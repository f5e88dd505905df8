"""Language identification with hyperdimensional profiles.

Every letter has a random vector of `DIMENSIONS` signs. The vector of three neighbouring letters binds their vectors,
shifted by place: roll(a, 2) * roll(b, 1) * c. A text is the sum (bundle) of its three-letter vectors, a language prototype
the sum over all texts of the language. A text gets the language whose prototype, less the mean of the unit prototypes,
has the largest cosine with its bundle, less the same mean.

As bundling is linear, a prototype is learned from how often each three-letter run occurs in the language: tasks add these
counts up first, and what reaches the driver is bounded by the alphabet, not by the documents. Letters are
folded to lower case; anything that is no letter is one word boundary. Texts of over `PIECE` characters are read
in pieces, whose ends count as boundaries.

A null text, or one without a letter, is `und` with score 0; so is every text when nothing was learned. Ties go to the
first language by name. Extra columns are kept, those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.rowwise import emit, with_columns

DIMENSIONS = 2048
SEED = 20240117
#: Symbols: 0 is the boundary, 1 to 26 are a to z, other letters share the rest by code point.
SYMBOLS = 128
#: The first code point above all letters.
LETTER_END = 0x33480
PIECE = 1_000_000
#: Texts and three-letter runs that are multiplied at a time.
ROWS, RUNS = 256, 4096
UNKNOWN = "und"


def symbol_table() -> np.ndarray:
    """Symbol of every code point."""
    table = np.zeros(LETTER_END + 1, np.uint8)
    for code in range(LETTER_END):
        if chr(code).isalpha():
            table[code] = code - 96 if 97 <= code <= 122 else 27 + code % (SYMBOLS - 27)
    return table


def run_counts(texts: Sequence[str | None], table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, run, count) of the three-symbol runs of each text, sorted by text and run."""
    pieces = [(at, text[k : k + PIECE].lower()) for at, text in enumerate(texts) if text for k in range(0, len(text), PIECE)]
    if not pieces:
        return (np.zeros(0, np.int64),) * 3
    joined = "".join(f" {p} " for _, p in pieces)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    symbols = table[np.minimum(codes, LETTER_END)].astype(np.int64)
    piece = np.repeat(np.arange(len(pieces)), [len(p) + 2 for _, p in pieces])
    kept = np.append(True, (symbols[1:] > 0) | (symbols[:-1] > 0) | (piece[1:] != piece[:-1]))
    symbols, piece = symbols[kept], piece[kept]
    same = piece[2:] == piece[:-2]
    run = (symbols[:-2] * SYMBOLS + symbols[1:-1]) * SYMBOLS + symbols[2:]
    owner = np.array([at for at, _ in pieces], np.int64)[piece[2:]]
    keys, counts = np.unique((owner * SYMBOLS**3 + run)[same], return_counts=True)
    return keys // SYMBOLS**3, keys % SYMBOLS**3, counts


def letter_vectors() -> np.ndarray:
    signs = np.random.default_rng(SEED).integers(0, 2, (SYMBOLS, DIMENSIONS), dtype=np.int8)
    return (signs * 2 - 1).astype(np.float32)


def run_vectors(runs: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Bound and permuted vectors of three-symbol runs."""
    first, second, third = runs // SYMBOLS**2, runs // SYMBOLS % SYMBOLS, runs % SYMBOLS
    return np.roll(letters, 2, axis=1)[first] * np.roll(letters, 1, axis=1)[second] * letters[third]


def bundle(owner: np.ndarray, runs: np.ndarray, counts: np.ndarray, rows: int, letters: np.ndarray) -> np.ndarray:
    """Sum of the run vectors of each text."""
    distinct, column = np.unique(runs, return_inverse=True)
    out = np.zeros((rows, DIMENSIONS), np.float32)
    for first in range(0, len(distinct), RUNS):
        block = distinct[first : first + RUNS]
        dense = np.zeros((rows, len(block)), np.float32)
        here = (column >= first) & (column < first + len(block))
        dense[owner[here], column[here] - first] = counts[here]
        out += dense @ run_vectors(block, letters)
    return out


def _blocks(texts: Sequence[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of at most ROWS texts and about PIECE characters."""
    first, held = 0, 0
    for at, text in enumerate(texts):
        size = len(text) if text else 0
        if at > first and (held + size > PIECE or at - first == ROWS):
            yield first, at
            first, held = at, 0
        held += size
    if first < len(texts):
        yield first, len(texts)


def language_counts(docs: DataFrame, lang: str = "lang") -> DataFrame:
    """(lang, run, n): three-letter runs of all texts with a language."""

    def count(batches):
        table, names = symbol_table(), {}
        keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

        def merged():
            distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
            return [distinct], [np.bincount(place, np.concatenate(counts), len(distinct)).astype(np.int64)]

        for batch in batches:
            langs, texts = (c.to_pylist() for c in batch.columns)
            number = np.array([names.setdefault(x, len(names)) for x in langs], np.int64)
            for first, last in _blocks(texts):
                owner, run, n = run_counts(texts[first:last], table)
                keys.append(number[first:last][owner] * SYMBOLS**3 + run)
                counts.append(n)
                if sum(map(len, keys)) > 2_000_000:
                    keys, counts = merged()
        keys, counts = merged()
        listed = list(names)
        for k in range(0, len(keys[0]), 100_000):
            part = keys[0][k : k + 100_000]
            yield [listed[x] for x in part // SYMBOLS**3], part % SYMBOLS**3, counts[0][k : k + 100_000]

    rows = docs.select(F.col(lang).alias("lang"), "text").dropna()
    return emit(rows, "lang string, run long, n long", count).groupBy("lang", "run").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, lang: str = "lang") -> dict:
    """Language names and their prototypes, from the rows with a text and a language."""
    rows = [r for r in language_counts(docs, lang).collect() if r["run"]]
    names = sorted({r["lang"] for r in rows})
    place = {name: k for k, name in enumerate(names)}
    owner = np.array([place[r["lang"]] for r in rows], np.int64)
    runs, counts = (np.array([r[c] for r in rows], np.int64) for c in ("run", "n"))
    order = np.lexsort((runs, owner))
    sums = bundle(owner[order], runs[order], counts[order].astype(np.float32), len(names), letter_vectors())
    sums /= np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    mean = sums.mean(axis=0) if len(names) > 1 else np.zeros(DIMENSIONS, np.float32)
    return {"names": names, "mean": mean, "prototypes": sums - mean}


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """The documents with lang_pred and score, the cosine cut off at 0."""
    shared, made = docs.sparkSession.sparkContext.broadcast(model), {}

    def classify(texts):
        if not made:
            made.update(table=symbol_table(), letters=letter_vectors())
        model, table, letters = shared.value, made["table"], made["letters"]
        names, prototypes = model["names"], model["prototypes"]
        lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not names:
            return lang, score
        length = np.maximum(np.linalg.norm(prototypes, axis=1), 1e-9)
        for first, last in _blocks(texts):
            owner, runs, counts = run_counts(texts[first:last], table)
            lettered = runs > 0
            vectors = bundle(owner[lettered], runs[lettered], counts[lettered].astype(np.float32), last - first, letters)
            norm = np.linalg.norm(vectors, axis=1, keepdims=True)
            centred = vectors / np.maximum(norm, 1e-9) - model["mean"]
            size = np.maximum(np.linalg.norm(centred, axis=1, keepdims=True), 1e-9)
            cosine = (centred @ prototypes.T) / size / length
            best = cosine.argmax(axis=1)
            for k in np.unique(owner[lettered]).tolist():
                lang[first + k] = names[best[k]]
                score[first + k] = min(max(float(cosine[k, best[k]]), 0.0), 1.0)
        return lang, score

    return with_columns(docs, "lang_pred string, score double", classify)


def held_out(key: Column, modulus: int, rest: int) -> Column:
    """Rows kept out of learning: the CRC of the key's text leaves `rest`. A null key is never held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % modulus == rest, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the rows that are not held out, then predict all: doc_id, held_out, lang_pred, score."""
    out = held_out(F.col("doc_id"), 4, 2)
    model = learn(docs.filter(~out & F.col("doc_id").isNotNull()))
    rows = docs.select("doc_id", out.alias("held_out"), "text")
    return predict(rows, model).drop("text")
