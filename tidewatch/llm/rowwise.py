"""Running numpy code over Arrow batches of a DataFrame, one output row per input row."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


#: Rows that are turned into Python values together. Arrow batches may be large; a slice of one is no copy.
SLICE_ROWS = 512


#: Bytes of an Arrow batch, and the setting for it with Spark's own default. Every task holds some batches outside the heap of its executor.
BATCH_BYTES, BATCH_CONF, BATCH_DEFAULT = "8m", "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches be small, unless the session has a limit of its own."""
    if spark.conf.get(BATCH_CONF, None) == BATCH_DEFAULT:
        spark.conf.set(BATCH_CONF, BATCH_BYTES)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in slices; afterwards the worker, which may wait for long, gives back the memory of the batches."""
    for batch in batches:
        for first in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(first, SLICE_ROWS)
    batch = None
    pa.default_memory_pool().release_unused()


def without(docs: DataFrame, names: Sequence[str]) -> DataFrame:
    """`docs` without columns of these names, in any case: results replace them."""
    taken = {n.lower() for n in names}
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in taken])


def with_columns(docs: DataFrame, schema: str, make: Callable[..., Sequence], of: Sequence[str] = ("text",)) -> DataFrame:
    """Append the columns that `make` computes from the values of the columns `of`, batch by batch.

    `make` gets a list of values per column and returns one list or array per new column. A column of `docs` with the
    name of a result is replaced. Rows, their order and their partitions stay; nothing is shuffled. `make` is called often: what it
    keeps from call to call belongs in an object it closes over, of which every task has its own.
    """
    added = T.StructType.fromDDL(schema)
    kept = without(docs, [f.name for f in added])
    lower = [c.lower() for c in kept.columns]
    index = [lower.index(c.lower()) for c in of]
    out = T.StructType([*kept.schema.fields, *added.fields])
    arrow = to_arrow_schema(added)
    names = [*kept.columns, *arrow.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = make(*[batch.column(i).to_pylist() for i in index])
            new = [m if isinstance(m, pa.Array) else pa.array(m, f.type) for m, f in zip(made, arrow, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=names)

    small_batches(docs.sparkSession)
    return kept.mapInArrow(run, out)


def emit(rows: DataFrame, schema: str, make: Callable[[Iterator[pa.RecordBatch]], Iterator[Sequence]]) -> DataFrame:
    """Rows of another shape: `make` turns the batches of a partition into lists of columns."""
    out = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for made in make(slices(batches)):
            new = [m if isinstance(m, pa.Array) else pa.array(m, f.type) for m, f in zip(made, arrow, strict=True)]
            yield pa.RecordBatch.from_arrays(new, names=arrow.names)

    small_batches(rows.sparkSession)
    return rows.mapInArrow(run, out)
