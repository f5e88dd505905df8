"""Calendar and time-slice columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def calendar_columns(ts: Column) -> dict[str, Column]:
    """The partition date and six integer features; weeks start on Sunday = 1."""
    return {
        "date": F.to_date(ts),
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "hour": F.hour(ts),
        "day_of_week": F.dayofweek(ts),
        "quarter": F.quarter(ts),
    }


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970, cut off rather than rounded."""
    return F.unix_seconds(ts.cast("timestamp"))


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def time_slice(ts: Column, seconds: int) -> Column:
    """Number of the `seconds`-wide slice that `ts` falls into."""
    return F.floor(epoch_seconds(ts) / F.lit(seconds))
