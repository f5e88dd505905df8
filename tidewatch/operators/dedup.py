"""One row per key, chosen the same way on every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the row with the smallest `order` per key; copies of a key collapse before the shuffle."""
    return _pick(rows, keys, order, F.min_by)


def last_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the row with the largest `order` per key; NULLs sort lowest."""
    return _pick(rows, keys, order, F.max_by)


def _pick(rows: DataFrame, keys: Sequence[str], order: Sequence[str], chooser) -> DataFrame:
    keys = list(keys)
    rest = [c for c in rows.columns if c not in keys]
    picked = rows.groupBy(*keys).agg(chooser(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in rows.columns])


def row_order(rows: DataFrame) -> list[str]:
    """Source position where the rows carry one, else all columns: a stable order for ties."""
    position = [c for c in ("kafka_partition", "kafka_offset") if c in rows.columns]
    return position if len(position) == 2 else list(rows.columns)


def dedup(rows: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Deduplicate on `keys`, keeping the earliest row by source position."""
    return first_per_key(rows, keys, order or row_order(rows))
