"""Token output in training order: fixed-stride binary shards in the order of a keyed permutation.

Every document is a sequence of tokens and gets a number from its place in the stored table (file, then row in the file), which no
partitioning changes. A keyed Feistel network over the next even power of two, walked along its cycles until it falls below
the number of documents, turns the number into the global slot: a bijection that needs no shuffle, no sort
and no state. Shard s holds the slots from s * `DOCUMENTS` on; texts are dealt to the shards by slot, and the task of a
shard reads them in slot order, encodes them and packs the token stream, each sequence closed by `END`, into records of
`RECORD` tokens. The last record is filled up with `FILL`.

A shard is one file of records of 2 * RECORD bytes (little-endian 16-bit ids) and a newline byte, so record r starts at byte
r * STRIDE and a reader resumes at any record by one seek. The index names for every document its slot, shard and
token range, read back from the written bytes. A lost task writes its shard again; the committer keeps one copy.

Null and empty texts are sequences of no tokens. Rows that repeat are sequences of their own. Extra columns are ignored.
The vocabulary is a file given by its path.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tidewatch.llm.rowwise import emit
from tidewatch.llm.words import mix
from tidewatch.operators.lookup import join_lookup
from tidewatch.session import materialize, scratch_path

#: Documents per shard and tokens per record.
DOCUMENTS, RECORD = 4096, 2048
STRIDE = 2 * RECORD + 1
#: Ids beyond the vocabulary: end of a sequence, and filling.
END, FILL = 50256, 65535
KEY, ROUNDS = 0x7469646573, 6
#: Default vocabulary: ranks of a byte-level BPE, one base64 token and its id per line.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: How that vocabulary cuts text before merging: a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Longest stretch encoded at once; cut where the pattern always cuts, before a space that follows a word character.
STRETCH = 400_000


def permute(numbers: np.ndarray, count: int, key: int = KEY) -> np.ndarray:
    """The slot of each number below `count`: a Feistel network with cycle-walking."""
    if len(numbers) and not 0 <= numbers.min() <= numbers.max() < count:
        raise ValueError(f"numbers must lie in [0, {count})")  # others would walk for ever or share a slot
    half = max(1, ((max(count, 2) - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out = numbers.astype(np.uint64)
    walking = np.ones(len(out), bool)
    while walking.any():
        left, right = out[walking] >> np.uint64(half), out[walking] & mask
        for turn in range(ROUNDS):
            keyed = mix(right + np.uint64((key * (2 * turn + 1) + turn * 0x9E3779B97F4A7C15) & (2**64 - 1)))
            left, right = right, left ^ (keyed & mask)
        out[walking] = (left << np.uint64(half)) | right
        walking = out >= np.uint64(count)
    return out.astype(np.int64)


def whole_scan(docs: DataFrame) -> bool:
    """Whether the rows are those of stored files, each once: nothing but columns is chosen between the scan and here."""
    node = docs._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "SubqueryAlias", "View"):
        node = node.children().head()
    return node.nodeName() == "LogicalRelation"


def numbered(docs: DataFrame) -> tuple[DataFrame, int]:
    """doc_id, text and number (0, 1, ... in stored order), and how many there are. Rows that are no whole stored table are stored first."""
    place = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    try:
        rows = docs.select("doc_id", "text", *place) if whole_scan(docs) else None
    except AnalysisException:
        rows = None
    if rows is None:
        docs = materialize(docs.select("doc_id", "text"), "documents")
        rows = docs.select("doc_id", "text", *place)
    files = docs.select(place[0]).groupBy("file").agg(F.count(F.lit(1)).alias("held"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    files = materialize(files.withColumn("before", F.coalesce(F.sum("held").over(before), F.lit(0))), "files")
    count = files.agg(F.coalesce(F.sum("held"), F.lit(0))).first()[0]
    rows = join_lookup(rows, files.select("file", "before"), ["file"])
    return rows.select("doc_id", "text", (F.col("before") + F.col("row")).alias("number")), count


def with_slots(rows: DataFrame, count: int, key: int = KEY, documents: int = DOCUMENTS) -> DataFrame:
    @pandas_udf("long")
    def slot(number):
        import pandas as pd

        return pd.Series(permute(number.to_numpy(), count, key))

    return rows.withColumn("slot", slot("number")).withColumn("shard", F.floor(F.col("slot") / documents).cast("int"))


def _encoder(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(encoder, text: str | None) -> np.ndarray:
    """Token ids of a whole text as 16-bit numbers."""
    parts, at, text = [], 0, text or ""
    while at < len(text):
        end = at + STRETCH
        if end < len(text):
            found = text.rfind(" ", at + 1, end)
            while found > at and not (text[found - 1].isalnum() and found + 1 < len(text) and text[found + 1].isalnum()):
                found = text.rfind(" ", at + 1, found)
            end = found if found > at else len(text)
        parts.append(encoder.encode_to_numpy(text[at:end], disallowed_special=()).astype("<u2"))
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, "<u2")


def _pack(path: str):
    """Batches of (slot, shard, text) in slot order to (shard, record) rows, one stream of records per shard."""

    def run(batches):
        encoder = None
        held, shard = np.zeros(0, "<u2"), None
        for batch in batches:
            encoder = encoder or _encoder(path)
            done_shards, done = [], []

            def flush(last: bool):
                nonlocal held
                full = len(held) // RECORD * RECORD
                if last and len(held) > full:
                    held = np.append(held, np.full(full + RECORD - len(held), FILL, "<u2"))
                    full += RECORD
                for k in range(0, full, RECORD):
                    done_shards.append(shard)
                    done.append(held[k : k + RECORD].tobytes())
                held = held[full:]

            streams = []
            for of, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if of != shard and shard is not None:
                    held = np.concatenate([held, *streams])
                    streams = []
                    flush(True)
                shard = of
                streams += [encode(encoder, text), np.array([END], "<u2")]
            held = np.concatenate([held, *streams])
            flush(False)
            if done:
                yield done_shards, pa.array(done, pa.binary())
        if len(held):
            held = np.append(held, np.full(-len(held) % RECORD, FILL, "<u2"))
            yield [shard] * (len(held) // RECORD), pa.array([held[k : k + RECORD].tobytes() for k in range(0, len(held), RECORD)], pa.binary())

    return run


def write_shards(slotted: DataFrame, count: int, path: str, vocabulary: str = VOCABULARY, documents: int = DOCUMENTS) -> None:
    """Write the shards below `path`, a folder shard=s with one file for each."""
    shards = max(1, -(-count // documents))
    dealt = slotted.select("slot", "shard", "text").repartitionById(shards, "shard").sortWithinPartitions("shard", "slot")
    records = emit(dealt, "shard int, record binary", _pack(vocabulary))
    # the text writer stores the bytes of a string as they are and closes each with a newline
    raw = records.select("shard", F.col("record").cast("string").alias("value"))
    raw.write.partitionBy("shard").text(path)


def read_index(spark: SparkSession, path: str, documents: int = DOCUMENTS) -> DataFrame:
    """slot, shard, first_token (in the stream of its shard), n_tokens, tokens_sha256, from the shards alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(path)
    shard = F.regexp_extract("path", r"shard=([0-9]+)", 1).cast("int")

    def parse(batches):
        for batch in batches:
            for of, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                records = np.frombuffer(content, np.uint8).reshape(-1, STRIDE)
                stream = np.ascontiguousarray(records[:, :-1]).view("<u2").reshape(-1)
                ends = np.flatnonzero(stream == END)
                starts = np.append(0, ends[:-1] + 1) if len(ends) else ends
                sums = [hashlib.sha256(stream[s:e].tobytes()).hexdigest() for s, e in zip(starts, ends, strict=True)]
                yield of * documents + np.arange(len(ends)), np.full(len(ends), of, np.int32), starts, ends - starts, sums

    return emit(files.select(shard, "content"), "slot long, shard int, first_token long, n_tokens long, tokens_sha256 string", parse)


def materialise(docs: DataFrame, path: str | None = None, *, vocabulary: str = VOCABULARY, key: int = KEY, documents: int = DOCUMENTS) -> DataFrame:
    """Write the shards and return their index: doc_id, slot, shard, first_token, n_tokens, tokens_sha256; a row per document."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "shards")
    rows, count = numbered(docs)
    slotted = with_slots(rows, count, key, documents)
    if not count:
        return slotted.select("doc_id", "slot", "shard", *[F.lit(None).cast(t).alias(n) for n, t in (("first_token", "long"), ("n_tokens", "long"), ("tokens_sha256", "string"))])
    write_shards(slotted, count, path, vocabulary, documents)
    index = read_index(spark, path, documents)
    return slotted.select("doc_id", "slot").join(index, "slot").select("doc_id", "slot", "shard", "first_token", "n_tokens", "tokens_sha256")
