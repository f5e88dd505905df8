"""Benchmark decontamination by a prefix-filtered set join with exact verification.

Items are cut into windows of ten consecutive words (an item of fewer words is one window). A window is a set of
shingles (word pairs; a one-word window has its word), ordered by how often they occur in the documents. As a document
must contain all shingles of a window, its rarest one, the necessary prefix, has to occur: documents meet windows on that shingle
only, a bound on position and length leaves the starts where the window fits, and the words are then compared one by one.

Windows, their shingles, how often those occur and the prefixes are tables that Spark makes: shingles are counted in one scan of
the documents, in a fixed number of bins that the benchmark marks (bins that shingles share only make a prefix less rare). The
finished table is dealt into blocks of about `BLOCK_WINDOWS` windows, and a block is shipped to the tasks that read the documents; a
larger benchmark is worked off block by block, with the document hits so far carried along. The driver holds one block, as word
numbers, never texts. Documents are never shuffled, so no passage, source or group of copies can overload a task.

Words are numbered by a 64-bit hash; should two words of the benchmark share a number, all are numbered anew by another hash. Words of
documents are looked up by their letters, so hits are exact.

Null or wordless texts have no words and no hits. Items whose id or text is null take no part, repeated items
count once, and items with equal windows are all reported. Extra columns of the documents are kept, those named like
a result are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.rowwise import emit, with_columns, without
from tidewatch.llm.words import WordHashes, combine, ids_of, mix, split_words
from tidewatch.operators.lookup import join_lookup
from tidewatch.session import materialize, scratch_path

WINDOW = 10
#: Words in a shingle.
SHINGLE = 2
#: Windows of the benchmark that are in memory at a time.
BLOCK_WINDOWS = 250_000
#: Bins in which shingles are counted, as a power of two.
BIN_BITS = 20
#: Windows of an item that are handed on together, and tasks that join the marks of all others.
STEP, FAN_IN = 20_000, 16

_HASHES = WordHashes()


def numbers(words: list[bytes], salt: bytes = b"") -> np.ndarray:
    """Numbers of words, never 0."""
    found = _HASHES.of([salt + w for w in words] if salt else words).view(np.int64)
    return np.where(found == 0, 1, found)


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Shingles of two words, from the numbers of both: not negative."""
    return (combine([first.view(np.uint64), second.view(np.uint64)]) >> np.uint64(1)).astype(np.int64)


def single_keys(word: np.ndarray) -> np.ndarray:
    """Shingles of one word: negative."""
    return -(mix(word.view(np.uint64)) >> np.uint64(1)).astype(np.int64) - 1


def bins(keys: np.ndarray) -> np.ndarray:
    return keys & (2**BIN_BITS - 1)


def _vocabulary(items: DataFrame) -> tuple[DataFrame, bytes]:
    """(word, id) of all words of the benchmark, and the salt that keeps the ids apart."""
    for turn in count():
        salt = b"\0" * turn

        def make(batches, salt=salt):
            for batch in batches:
                words = sorted({w for text in batch.column(1).to_pylist() for w in split_words(text)})
                yield words, numbers(words, salt)

        found = materialize(emit(items, "word binary, id long", make).distinct(), "vocabulary")
        if found.groupBy("id").count().filter("count > 1").isEmpty():
            return found, salt


def _windows(items: DataFrame, window: int, salt: bytes) -> DataFrame:
    """(item, ids, keys) of every different window of an item: word numbers and shingles in their order."""

    def make(batches):
        for batch in batches:
            for item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = numbers(split_words(text), salt)
                size = min(window, len(ids))
                if not size:
                    continue
                rows = np.lib.stride_tricks.sliding_window_view(ids, size)
                for first in range(0, len(rows), STEP):
                    own = np.unique(rows[first : first + STEP], axis=0)
                    keys = single_keys(own) if size == 1 else pair_keys(own[:, :-1].copy(), own[:, 1:].copy())
                    yield [item] * len(own), pa.array(list(own), pa.list_(pa.int64())), pa.array(list(keys), pa.list_(pa.int64()))

    return emit(items, "item string, ids array<long>, keys array<long>", make)


def _marks(windows: DataFrame) -> np.ndarray:
    """Which bins hold a shingle of the benchmark, and whether it is a pair or a single word: two rows of flags."""
    size = 2**BIN_BITS

    def packed(flags: np.ndarray):
        return [TaskContext.get().partitionId()], [np.packbits(flags).tobytes()]

    def partial(batches):
        flags = np.zeros((2, size), bool)
        for batch in batches:
            keys = batch.column(0).flatten().to_numpy()
            flags[(keys < 0).astype(np.int64), bins(keys)] = True
        if flags.any():
            yield packed(flags)

    def join(batches):
        flags = np.zeros((2, size), bool)
        for batch in batches:
            for value in batch.column(1).to_pylist():
                flags |= np.unpackbits(np.frombuffer(value, np.uint8)).reshape(2, size).astype(bool)
        if flags.any():
            yield packed(flags)

    kind = "task long, flags binary"
    dealt = emit(windows.select("keys"), kind, partial).repartition(FAN_IN, F.pmod("task", F.lit(FAN_IN)))
    out = np.zeros((2, size), bool)
    for row in emit(dealt, kind, join).collect():
        out |= np.unpackbits(np.frombuffer(bytes(row["flags"]), np.uint8)).reshape(2, size).astype(bool)
    return out


def count_shingles(docs: DataFrame, marks: np.ndarray, salt: bytes) -> DataFrame:
    """(bin, n): how often the shingles of marked bins occur in all documents; a row per bin and task is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast((np.packbits(marks), bool(marks[0].any()), bool(marks[1].any())))

    def make(batches):
        flags, pairs, singles = shared.value
        marked = np.unpackbits(flags).reshape(2, -1).astype(bool)
        seen = np.zeros(2**BIN_BITS, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                ids = numbers(split_words(text), salt)
                for kind, keys in ((0, pair_keys(ids[:-1], ids[1:]) if pairs and len(ids) > 1 else ids[:0]), (1, single_keys(ids) if singles else ids[:0])):
                    at = bins(keys)
                    np.add.at(seen, at[marked[kind][at]], 1)
        at = np.flatnonzero(seen)
        yield at, seen[at]

    return emit(docs.select("text"), "bin long, n long", make).groupBy("bin").agg(F.sum("n").alias("n"))


def choose_prefixes(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """(item, ids, key, offset): the rarest shingle of every window; ties go to the smaller key, repeats to the first place."""
    places = windows.select("item", "ids", F.posexplode("keys").alias("offset", "key"))
    places = places.withColumn("bin", F.col("key").bitwiseAND(F.lit(2**BIN_BITS - 1)))
    known = join_lookup(places, counts, ["bin"], "left")
    rank = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "key", "offset")).alias("r")
    return known.groupBy("item", "ids").agg(rank).select("item", "ids", "r.key", "r.offset")


@dataclass
class Index:
    """Windows of one block: sorted prefix shingles and, for each, its windows and the place of the shingle in them."""

    vocabulary: dict[bytes, int]
    keys: np.ndarray
    first: np.ndarray
    window: np.ndarray
    offset: np.ndarray
    words: np.ndarray
    lengths: np.ndarray
    items: list[list[str]]


def build_index(prefixes: pa.Table, words: pa.Table) -> Index:
    """The index of a block (item, ids, key, offset) with its vocabulary (word, id)."""
    prefixes = prefixes.combine_chunks()
    ids = prefixes.column("ids").combine_chunks()
    lengths = ids.value_lengths().to_numpy().astype(np.int64)
    matrix = np.zeros((len(lengths), max(int(lengths.max()), 1)), np.int64)
    matrix[np.arange(matrix.shape[1]) < lengths[:, None]] = ids.flatten().to_numpy()
    rows, first, owner = np.unique(matrix, axis=0, return_index=True, return_inverse=True)
    items: list[list[str]] = [[] for _ in rows]
    for item, row in zip(prefixes.column("item").to_pylist(), owner.ravel().tolist(), strict=True):
        items[row].append(item)
    key, offset = (prefixes.column(c).to_numpy()[first].astype(np.int64) for c in ("key", "offset"))
    order = np.argsort(key, kind="stable")
    keys, starts = np.unique(key[order], return_index=True)
    vocabulary = dict(zip(words.column("word").to_pylist(), words.column("id").to_pylist(), strict=True))
    return Index(vocabulary, keys, np.append(starts, len(key)), order, offset[order], rows, lengths[first], items)


def _document_keys(ids: np.ndarray, pairs: bool, singles: bool) -> list[tuple[np.ndarray, np.ndarray]]:
    """(positions, keys) of the shingles of known words."""
    found = []
    if pairs and len(ids) > 1:
        at = np.flatnonzero((ids[:-1] != 0) & (ids[1:] != 0))
        found.append((at, pair_keys(ids[at], ids[at + 1])))
    if singles:
        at = np.flatnonzero(ids)
        found.append((at, single_keys(ids[at])))
    return found


def _matches(index: Index, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, window) of every occurrence of a window in the words `ids` of one document."""
    starts, windows = [], []
    pairs, singles = bool((index.keys >= 0).any()), bool((index.keys < 0).any())
    for at, found in _document_keys(ids, pairs, singles):
        slot = np.minimum(np.searchsorted(index.keys, found), len(index.keys) - 1)
        same = index.keys[slot] == found
        at, slot = at[same], slot[same]
        many = index.first[slot + 1] - index.first[slot]
        entry = np.repeat(index.first[slot], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        start, window = np.repeat(at, many) - index.offset[entry], index.window[entry]
        fits = (start >= 0) & (start + index.lengths[window] <= len(ids))
        start, window = start[fits], window[fits]
        reach = np.arange(index.words.shape[1])
        inside = reach < index.lengths[window][:, None]
        there = ids[np.minimum(start[:, None] + reach, len(ids) - 1)]
        equal = ((there == index.words[window]) | ~inside).all(axis=1)
        starts.append(start[equal])
        windows.append(window[equal])
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(starts), np.concatenate(windows)


def _covered(spans: np.ndarray) -> list[int]:
    """Disjoint [start, end) runs, flat, that cover the same words as the given spans."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.append(True, spans[1:, 0] > reach[:-1])
    first = np.flatnonzero(new)
    return np.column_stack([spans[first, 0], reach[np.append(first[1:], len(spans)) - 1]]).ravel().tolist()


def _scan(docs: DataFrame, index: Index) -> DataFrame:
    """Adds the hits of one block to the columns _runs and _items, which earlier blocks may have filled."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(index))
    carried = docs.withColumnsRenamed({"_runs": "_runs_before", "_items": "_items_before"})

    def scan(texts, runs_before, items_before):
        index = Index(**shared.value)
        n_words, runs, items = [], [], []
        for text, run, item in zip(texts, runs_before, items_before, strict=True):
            ids = ids_of(split_words(text), index.vocabulary)
            start, window = _matches(index, ids)
            run, item = run or [], set(item or [])
            if len(start):
                own = np.column_stack([start, start + index.lengths[window]])
                run = _covered(np.concatenate([own, np.array(run, np.int64).reshape(-1, 2)]))
                item.update(i for w in np.unique(window).tolist() for i in index.items[w])
            n_words.append(len(ids))
            runs.append(run)
            items.append(sorted(item))
        return n_words, runs, items

    of = ("text", "_runs_before", "_items_before")
    added = with_columns(carried, "n_words long, _runs array<long>, _items array<string>", scan, of)
    return added.drop("_runs_before", "_items_before")


def _blocks(docs: DataFrame, benchmark: DataFrame, window: int, block_windows: int):
    """The indexes of all blocks of the benchmark, one after the other."""
    spark = docs.sparkSession
    items = materialize(benchmark.select(F.col("item_id").cast("string").alias("item"), "text").dropna().distinct(), "items")
    vocabulary, salt = _vocabulary(items)
    windows = materialize(_windows(items, window, salt), "windows")
    number = -(-windows.count() // block_windows)
    if not number:
        return
    prefixes = choose_prefixes(windows, materialize(count_shingles(docs, _marks(windows), salt), "shingle_counts"))
    path = scratch_path(spark, "prefixes")
    dealt = prefixes.withColumn("block", F.pmod(F.xxhash64("ids"), F.lit(number)).cast("int"))
    dealt.repartition("block").write.partitionBy("block").parquet(path)
    stored = spark.read.parquet(path)
    for block in sorted(r["block"] for r in stored.select("block").distinct().collect()):
        own = stored.filter(F.col("block") == block).drop("block")
        known = own.select(F.explode("ids").alias("id")).distinct().join(vocabulary, "id").select("word", "id")
        yield build_index(own.toArrow(), known.toArrow())


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, block_windows: int = BLOCK_WINDOWS
) -> DataFrame:
    """The documents with n_words, n_hit, n_items, items (sorted ids) and contaminated.

    A word inside any occurrence of a window is hit. `docs` needs a column text, `benchmark` item_id and text.
    """
    results = ["n_words", "n_hit", "n_items", "items", "contaminated", "_runs", "_items"]
    rows = without(docs, results).withColumns(
        {"_runs": F.lit(None).cast("array<long>"), "_items": F.lit(None).cast("array<string>")}
    )
    scanned = False
    for index in _blocks(docs, benchmark, window, block_windows):
        if scanned:
            rows = materialize(rows, "decontaminated")
        rows = _scan(rows, index)
        scanned = True
    if not scanned:
        none = lambda texts: ([len(split_words(t)) for t in texts],)
        rows = with_columns(rows, "n_words long", none)
    hit = "aggregate(sequence(0, size(_runs) div 2 - 1), 0L, (n, i) -> n + _runs[2 * i + 1] - _runs[2 * i])"
    return (
        rows.withColumn("n_hit", F.expr(f"if(coalesce(size(_runs), 0) > 0, {hit}, 0L)"))
        .withColumn("items", F.coalesce("_items", F.array().cast("array<string>")))
        .withColumn("n_items", F.size("items").cast("long"))
        .withColumn("contaminated", F.col("n_hit") > 0)
        .drop("_runs", "_items")
    )


def digest(docs: DataFrame) -> DataFrame:
    """The report of the check: item lists as the SHA-256 of their comma-joined ids."""
    listed = F.sha2(F.concat_ws(",", "items").cast("binary"), 256)
    return docs.select("doc_id", "n_words", "n_hit", "n_items", listed.alias("items_sha256"), "contaminated")
