"""Vector distances without UDFs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def squared_distance(parts: Sequence[Column], centre: Sequence[Column]) -> Column:
    """Sum of squared differences, unrolled so that it stays in generated code."""
    total = None
    for part, mid in zip(parts, centre, strict=True):
        diff = part - mid
        total = diff * diff if total is None else total + diff * diff
    return total


def squared_distances(parts: Sequence[Column], centres: Sequence[Sequence[float]]) -> Column:
    """Squared distance to each centre, as one array."""
    return F.array(*[squared_distance(parts, [F.lit(float(v)) for v in centre]) for centre in centres])


def nearest(squares: Column) -> Column:
    """Number of the nearest centre; the lowest one when several are equally near."""
    return (F.array_position(squares, F.array_min(squares)) - 1).cast("int")


def array_distance(a: Column, b: Column) -> Column:
    """Euclidean distance of two arrays of equal length."""
    squares = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x))
