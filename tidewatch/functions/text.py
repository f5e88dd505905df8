"""Lenient casts and text clean-up as column expressions; none of them raises under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "UNKNOWN"


def blank_to_null(col: Column) -> Column:
    """Trimmed text, or NULL where nothing is left."""
    return F.nullif(F.trim(col), F.lit(""))


def default_unknown(col: Column) -> Column:
    return F.coalesce(blank_to_null(col), F.lit(UNKNOWN))


def as_double(col: Column) -> Column:
    return col.try_cast("double")


def as_int(col: Column) -> Column:
    """Integer text; a decimal part is cut off ('70.9' -> 70), junk is NULL."""
    whole = F.regexp_extract(col, r"^\s*([+-]?[0-9]+)\.[0-9]*\s*$", 1)
    return F.coalesce(col.try_cast("int"), whole.try_cast("int"))


def as_timestamp(col: Column, pattern: str | None = None) -> Column:
    if pattern is None:
        return col.try_cast("timestamp")
    return F.try_to_timestamp(col, F.lit(pattern))
