"""Joins of a large table to a per-key lookup that stay balanced when one key is hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 32


def fits_broadcast(lookup: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure rows and text size of at most `max_rows + 1` rows: is shipping the lookup whole safe?"""
    size = F.octet_length(F.to_json(F.struct(*lookup.columns)))
    rows, size = lookup.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def join_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    *,
    max_broadcast_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Join every row to its lookup rows.

    A lookup of checked size is broadcast, so `rows` is not shuffled. A larger one is repeated once per
    salt and joined on key + salt, which spreads each key of `rows` over `salts` tasks. The salt comes
    from the row and the partition it lies in, so copies of one row spread too and retries agree.
    The planner takes the copies for as small as the lookup's files, hence the hint that keeps it from broadcasting them.
    """
    on = list(on)
    if how not in ("inner", "left"):
        raise ValueError(f"lookup joins are inner or left, not {how}")
    if fits_broadcast(lookup, max_broadcast_rows):
        return rows.join(F.broadcast(lookup), on, how)
    salt = F.pmod(F.xxhash64(*rows.columns, F.spark_partition_id()), F.lit(salts))
    spread = rows.withColumn("_salt", salt.cast("int"))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(copies.hint("merge"), [*on, "_salt"], how).drop("_salt")
