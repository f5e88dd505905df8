"""Data checks around the daily jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


class CheckFailed(RuntimeError):
    """A table the day depends on is missing or empty."""


def require_rows(rows: DataFrame, what: str) -> DataFrame:
    """Pass `rows` on, or fail when there is none; looks at one row only."""
    if rows.isEmpty():
        raise CheckFailed(f"no rows in {what}")
    return rows


def row_counts(tables: Mapping[str, DataFrame], date_column: Mapping[str, str] | None = None) -> DataFrame:
    """Rows per table and day."""
    days = date_column or {}
    parts = [
        rows.groupBy(F.to_date(days.get(name, "kpi_date")).alias("kpi_date"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "kpi_date", "row_count")
        for name, rows in tables.items()
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def row_counts_for_date(tables: Mapping[str, DataFrame], day: str, date_column: Mapping[str, str] | None = None) -> DataFrame:
    """Rows per table on one day, zero where there are none."""
    days = date_column or {}
    parts = [
        rows.filter(F.to_date(days.get(name, "kpi_date")) == F.lit(day).cast("date"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name, rows in tables.items()
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def verify_day(tables: Mapping[str, DataFrame], day: str, must_have: Sequence[str] = ("fleet_daily_kpis", "vessel_behavior_clusters")) -> dict[str, int]:
    """Row counts of the day; fails when a required table has none."""
    counts = {r["table_name"]: r["row_count"] for r in row_counts_for_date(tables, day).collect()}
    empty = [name for name in must_have if counts.get(name, 0) == 0]
    if empty:
        raise CheckFailed(f"no rows on {day} in {', '.join(empty)}")
    return counts


def uniqueness_violations(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def observed(rows: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows on the way through, without a pass of their own."""
    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def processing_summary(raw: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows read, kept and removed."""
    counts = raw.agg(F.count(F.lit(1)).alias("n")).select(F.lit("raw").alias("_side"), "n").unionByName(
        kept.agg(F.count(F.lit(1)).alias("n")).select(F.lit("kept").alias("_side"), "n")
    )
    side = lambda name: F.coalesce(F.sum(F.when(F.col("_side") == name, F.col("n"))), F.lit(0))
    return counts.agg(
        side("raw").alias("raw_records"),
        side("kept").alias("processed_records"),
        (side("raw") - side("kept")).alias("removed_records"),
    )
