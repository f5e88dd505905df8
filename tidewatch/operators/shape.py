"""Keeping expensive columns from being computed more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def computed_once(rows: DataFrame) -> DataFrame:
    """The same rows; later filters read the finished columns instead of repeating their expressions.

    A filter on a computed column is normally moved below the projection with the expression copied into
    it. Filters do not move below a generator, so a one-row `inline` keeps parsing and casts in one place.
    """
    packed = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"))
    return packed.select(F.inline(F.array("_row")))


def first_rows(rows: DataFrame, n: int | None) -> DataFrame:
    """The first `n` rows, or all where no number is given."""
    return rows if n is None else rows.limit(n)
