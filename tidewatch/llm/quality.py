"""Quality classifier: random-indexing word vectors, pooled per document, and a small calibrated network.

Random indexing gives each word a sparse random index vector; the context vector of a word adds up the index vectors of the
words around it, over all documents. Words share `BUCKETS` hash buckets, so the table of vectors has a fixed size however
large the vocabulary; tasks add up their own table and only sums are shuffled. A document is the mean and the
spread of its word vectors, how alike neighbouring words are, and its length. A network of two layers, trained in numpy on a bounded sample of labelled
documents, scores it; a temperature fitted on documents it was not trained on calibrates the probabilities.

Null and empty texts have no words and are scored like a document of zero vectors. Documents labelled several times
count with the mean label, null labels do not count. Without any label every score is 0.5. Extra columns are kept, those
named like a result are replaced.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.langid import held_out
from tidewatch.llm.rowwise import emit, with_columns
from tidewatch.llm.words import steps

BUCKETS = 1 << 14
DIMENSIONS = 48
#: Non-zero entries of an index vector, and words on either side that are its context.
ENTRIES, REACH = 2, 2
SEED = 77
#: Labelled documents the network is fitted on: those with the smallest hash of their id. A bound on the
#: driver's work only; word vectors and scores cover all documents.
TRAINING_ROWS = 20_000
HIDDEN, EPOCHS, BATCH, RATE = 32, 40, 256, 3e-3
#: Every k-th training document calibrates instead.
CALIBRATION = 5
CACHED_WORDS = 100_000

_TOKEN = re.compile(r"\w+|[^\w\s]+")


class Buckets(dict):
    """Token to bucket; emptied when full, which changes no result."""

    def __missing__(self, token: str) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[token] = bucket = zlib.crc32(token.encode("utf-8", "replace")) % BUCKETS
        return bucket

    def of(self, text: str | None) -> np.ndarray:
        tokens = _TOKEN.findall(text) if text else []
        return np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero entries of every bucket's index vector."""
    rng = np.random.default_rng(SEED)
    return rng.integers(0, DIMENSIONS, (BUCKETS, ENTRIES)), rng.integers(0, 2, (BUCKETS, ENTRIES)) * 2 - 1


def add_contexts(table: np.ndarray, tokens: np.ndarray, owner: np.ndarray, places: np.ndarray, signs: np.ndarray) -> None:
    """Add the index vectors of the neighbours of each token to its row of `table`."""
    flat = table.reshape(-1)
    for gap in range(1, REACH + 1):
        same = owner[gap:] == owner[:-gap]
        left, right = tokens[:-gap][same], tokens[gap:][same]
        for here, there in ((left, right), (right, left)):
            for k in range(ENTRIES):
                np.add.at(flat, here * DIMENSIONS + places[there, k], signs[there, k])


def context_table(docs: DataFrame) -> np.ndarray:
    """Context vectors of all buckets over all documents; BUCKETS x DIMENSIONS whole numbers."""
    width = pa.binary()

    def local(batches):
        buckets, (places, signs) = Buckets(), index_vectors()
        table = np.zeros((BUCKETS, DIMENSIONS), np.int64)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for first, last in steps(texts):
                found = [buckets.of(t) for t in texts[first:last]]
                owner = np.repeat(np.arange(len(found)), [len(f) for f in found])
                add_contexts(table, np.concatenate(found), owner, places, signs)
        used = np.flatnonzero(table.any(axis=1))
        yield used, pa.array([table[k].tobytes() for k in used], width)

    def summed(batches):
        table = np.zeros((BUCKETS, DIMENSIONS), np.int64)
        for batch in batches:
            rows = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64).reshape(-1, DIMENSIONS)
            np.add.at(table, batch.column(0).to_numpy(), rows)
        used = np.flatnonzero(table.any(axis=1))
        yield used, pa.array([table[k].tobytes() for k in used], width)

    schema = "bucket long, context binary"
    sums = emit(emit(docs.select("text"), schema, local).repartition("bucket"), schema, summed)
    table = np.zeros((BUCKETS, DIMENSIONS), np.int64)
    for bucket, context in sums.collect():  # at most BUCKETS rows
        table[bucket] += np.frombuffer(context, np.int64)
    return table


def word_vectors(table: np.ndarray) -> np.ndarray:
    """Unit vectors; counts are damped so that frequent neighbours do not cover the rest."""
    damped = np.sign(table) * np.log1p(np.abs(table))
    return (damped / np.maximum(np.linalg.norm(damped, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def _likeness(vectors: np.ndarray, tokens: np.ndarray, gap: int) -> float:
    """Mean cosine of words `gap` apart; 0 for a text that has no such words."""
    total = 0.0
    for first in range(0, len(tokens) - gap, 100_000):
        left, right = vectors[tokens[first : first + 100_000]], vectors[tokens[first + gap : first + gap + 100_000]]
        total += float(np.einsum("ij,ij->", left[: len(right)], right))
    return total / (len(tokens) - gap) if len(tokens) > gap else 0.0


def pool(texts: list[str | None], vectors: np.ndarray, buckets: Buckets) -> np.ndarray:
    """Mean and spread of the word vectors of each text, the likeness of neighbours one and two apart, and its length."""
    out = np.zeros((len(texts), 2 * DIMENSIONS + 3), np.float32)
    for at, text in enumerate(texts):
        tokens = buckets.of(text)
        if len(tokens):
            distinct, counts = np.unique(tokens, return_counts=True)
            share = (counts / len(tokens)).astype(np.float32)
            rows = vectors[distinct]
            mean = share @ rows
            out[at, :DIMENSIONS] = mean
            out[at, DIMENSIONS:-3] = np.sqrt(np.maximum(share @ (rows * rows) - mean * mean, 0))
            out[at, -3:] = _likeness(vectors, tokens, 1), _likeness(vectors, tokens, 2), np.log1p(len(tokens))
    return out


def _forward(x: np.ndarray, net: dict) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.tanh(x @ net["w1"] + net["b1"])
    return hidden, hidden @ net["w2"] + net["b2"]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def train(x: np.ndarray, y: np.ndarray) -> dict:
    """Two layers fitted by Adam on the cross-entropy; the same data give the same network."""
    rng = np.random.default_rng(SEED)
    mean, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    x = ((x - mean) / spread).astype(np.float64)
    net = {
        "w1": rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), "b1": np.zeros(HIDDEN),
        "w2": rng.normal(0, HIDDEN**-0.5, HIDDEN), "b2": np.zeros(1),
    }
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.items()}
    turn = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for first in range(0, len(x), BATCH):
            rows = order[first : first + BATCH]
            hidden, z = _forward(x[rows], net)
            error = (_sigmoid(z) - y[rows]) / len(rows)
            back = np.outer(error, net["w2"]) * (1 - hidden**2)
            slope = {"w1": x[rows].T @ back + 1e-4 * net["w1"], "b1": back.sum(axis=0), "w2": hidden.T @ error, "b2": error.sum(keepdims=True)}
            turn += 1
            for k, g in slope.items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                net[k] = net[k] - RATE * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.999**turn)) + 1e-8)
    return net | {"mean": mean, "spread": spread, "temperature": 1.0}


def logits(x: np.ndarray, net: dict) -> np.ndarray:
    return _forward((x - net["mean"]) / net["spread"], net)[1]


def temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the smallest cross-entropy, from a fixed grid."""
    grid = np.exp(np.linspace(np.log(0.25), np.log(8.0), 81))
    loss = [np.mean(np.logaddexp(0, z / t) - y * z / t) for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", *, rows: int = TRAINING_ROWS) -> dict:
    """Word vectors of all documents and a network for the labels; `labels` has doc_id and the label column."""
    vectors = word_vectors(context_table(docs))
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.avg(label).alias("y")).dropna()
    order = F.xxhash64("doc_id")
    sample = known.orderBy(order, "doc_id").limit(rows)
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # `rows` short rows
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def make(batches):
        buckets = Buckets()
        for batch in batches:
            ids, y = batch.column(0), batch.column(2)
            pooled = pool(batch.column(1).to_pylist(), shared.value, buckets)
            yield ids.cast(pa.string()), y, pa.array([p.tobytes() for p in pooled], pa.binary())

    found = emit(chosen.select("doc_id", "text", "y"), "doc_id string, y double, pooled binary", make).collect()
    found = sorted((zlib.crc32(r["doc_id"].encode()), r["doc_id"], r["pooled"], r["y"]) for r in found)[:rows]
    if not found:
        return {"vectors": vectors, "net": None}
    x = np.array([np.frombuffer(bytes(r[2]), np.float32) for r in found])
    y = np.array([r[3] for r in found])
    apart = np.arange(len(x)) % CALIBRATION == CALIBRATION - 1
    net = train(x[~apart], y[~apart])
    if apart.any():
        net["temperature"] = temperature(logits(x[apart], net), y[apart])
    return {"vectors": vectors, "net": net}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """The documents with score (chance of label 1) and predicted (1 if score >= 0.5)."""
    shared, buckets = docs.sparkSession.sparkContext.broadcast(model), Buckets()

    def make(texts):
        net = shared.value["net"]
        if net is None:
            return np.full(len(texts), 0.5), np.ones(len(texts), np.int32)
        out = np.zeros(len(texts))
        for first, last in steps(texts):
            z = logits(pool(texts[first:last], shared.value["vectors"], buckets), net)
            out[first:last] = _sigmoid(z / net["temperature"])
        return out, (out >= 0.5).astype(np.int32)

    return with_columns(docs, "score double, predicted int", make)


def fit_held_in(docs: DataFrame, labels: DataFrame) -> dict:
    """Fit with the labels of rows that are not held out (CRC of the id modulo 3 is not 1)."""
    return fit(docs, labels.filter(~held_out(F.col("doc_id"), 3, 1)))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = fit_held_in(docs, labels)
    rows = docs.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "text")
    return score(rows, model).drop("text")
