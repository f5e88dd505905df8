"""Neighbours in time per key without putting one key's whole history into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.calendar import epoch_micros
from tidewatch.operators.lookup import join_lookup
from tidewatch.session import materialize

SLICE_SECONDS = 3600
SLICE_ROWS = 1_000_000


def with_slices(
    rows: DataFrame,
    keys: Sequence[str],
    ts: str,
    *,
    slice_seconds: int = SLICE_SECONDS,
    max_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add `_slice`, the start of a time slice that holds at most about `max_rows` rows of its key.

    Slices start out equally wide. Those that are too full are cut into narrower parts of the time they
    really cover, again until all fit or hold a single instant. Each round is one pass that counts rows
    per slice, combined before its shuffle; with few rows per key and slice there is one round.
    """
    keys = list(keys)
    at = epoch_micros(F.col(ts))
    sliced = rows.withColumn("_slice", at - F.pmod(at, F.lit(slice_seconds * 1_000_000)))
    while True:
        parts = F.ceil(F.col("_n") * F.lit(2.0) / F.lit(max_rows))
        full = materialize(
            sliced.groupBy(*keys, "_slice")
            .agg(F.count(F.lit(1)).alias("_n"), F.min(at).alias("_from"), F.max(at).alias("_to"))
            .filter((F.col("_n") > max_rows) & (F.col("_to") > F.col("_from")))
            .select(
                *keys, "_slice", "_from",
                F.greatest(F.floor((F.col("_to") - F.col("_from")) / parts), F.lit(1)).cast("long").alias("_width"),
            ),
            "full-slices",
        )
        if full.isEmpty():
            return sliced
        offset = at - F.col("_from")
        cut = F.col("_from") + offset - F.pmod(offset, F.col("_width"))
        sliced = (
            join_lookup(sliced, full, [*keys, "_slice"], "left")
            .withColumn("_slice", F.coalesce(cut, F.col("_slice")))
            .drop("_from", "_width")
        )


def with_previous(
    rows: DataFrame,
    keys: Sequence[str],
    ts: str,
    carry: Sequence[str],
    tiebreak: Sequence[str] = (),
    *,
    out: str = "prev",
    **slicing,
) -> DataFrame:
    """Add struct `out` with the `carry` columns of the preceding row of the same key, NULL on the first.

    `lag` runs inside (key, time slice); the last row of each slice, one per slice, is handed on to the
    first row of the key's next slice. The window over a key alone sees slices, never rows.
    """
    keys = list(keys)
    order = [ts, *tiebreak]
    sliced = with_slices(rows, keys, ts, **slicing)
    in_slice = Window.partitionBy(*keys, "_slice").orderBy(*order)
    before = F.struct(*[F.lag(c).over(in_slice).alias(c) for c in carry])
    tagged = sliced.withColumn("_before", F.when(F.lag(F.lit(1)).over(in_slice).isNotNull(), before))

    ends = sliced.groupBy(*keys, "_slice").agg(F.max_by(F.struct(*carry), F.struct(*order)).alias("_end"))
    over_slices = Window.partitionBy(*keys).orderBy("_slice")
    handed_on = ends.select(*keys, "_slice", F.lag("_end").over(over_slices).alias("_handed"))

    return (
        tagged.join(handed_on, [*keys, "_slice"])
        .withColumn(out, F.coalesce("_before", "_handed"))
        .drop("_slice", "_before", "_handed")
    )
