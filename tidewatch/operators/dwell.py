"""Port visits: pings near a port, cut into sessions by gaps in time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.calendar import epoch_seconds, time_slice
from tidewatch.functions.numbers import steady_round
from tidewatch.operators.spatial import DEFAULT_RADIUS_NM, near_ports

GAP_SECONDS = 7200
DAY_KEYS = ["kpi_date", "mmsi", "port_id"]


def session_slices(rows: DataFrame, keys: list[str], ts: str, gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """One row per key and time slice as wide as the gap: first and last time, and count.

    Rows of one key inside such a slice can never be split, so this loses nothing; slices of several
    batches add up through `merge_slices`.
    """
    return (
        rows.withColumn("slice", time_slice(F.col(ts), gap_seconds))
        .groupBy(*keys, "slice")
        .agg(F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("pings"))
    )


def merge_slices(slices: DataFrame, keys: list[str]) -> DataFrame:
    return slices.groupBy(*keys, "slice").agg(
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.sum("pings").alias("pings")
    )


def sessions_from_slices(slices: DataFrame, keys: list[str], gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """`entry_ts`, `exit_ts` and `ping_count` per key and session; a gap above `gap_seconds` splits.

    The windows run over slices, so a hot key costs its time span, not its rows.
    """
    in_time = Window.partitionBy(*keys).orderBy("slice")
    gap = epoch_seconds(F.col("first_ts")) - epoch_seconds(F.lag("last_ts").over(in_time))
    opened = slices.withColumn("_opens", F.coalesce((gap > gap_seconds).cast("int"), F.lit(1)))
    numbered = opened.withColumn(
        "session_id", F.sum("_opens").over(in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    return numbered.groupBy(*keys, "session_id").agg(
        F.min("first_ts").alias("entry_ts"), F.max("last_ts").alias("exit_ts"), F.sum("pings").alias("ping_count")
    )


def sessions(rows: DataFrame, keys: list[str], ts: str, gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """Gap-split sessions of a bounded table."""
    return sessions_from_slices(session_slices(rows, keys, ts, gap_seconds), keys, gap_seconds)


def dwell_minutes(entry_ts: Column, exit_ts: Column) -> Column:
    return F.round((epoch_seconds(exit_ts) - epoch_seconds(entry_ts)) / 60.0, 2)


def port_visits(pings: DataFrame, ports: DataFrame, default_radius_nm: float = DEFAULT_RADIUS_NM) -> DataFrame:
    """Vessel, port, day and time of every ping near a port."""
    near = near_ports(pings.select("MMSI", "BaseDateTime", "LAT", "LON"), ports, default_radius_nm)
    return near.select(
        F.to_date("BaseDateTime").alias("kpi_date"), F.col("MMSI").cast("long").alias("mmsi"), "port_id", "BaseDateTime"
    )


def port_dwell_sessions(
    pings: DataFrame,
    ports: DataFrame,
    default_radius_nm: float = DEFAULT_RADIUS_NM,
    gap_seconds: int = GAP_SECONDS,
    *,
    split_days: bool = True,
) -> DataFrame:
    """Sessions per vessel and port; with `split_days` a visit never spans midnight."""
    visits = port_visits(pings, ports, default_radius_nm)
    keys = DAY_KEYS if split_days else ["mmsi", "port_id"]
    found = sessions(visits, keys, "BaseDateTime", gap_seconds)
    if not split_days:
        found = found.withColumn("kpi_date", F.to_date("entry_ts"))
    return found.withColumn("dwell_minutes", dwell_minutes(F.col("entry_ts"), F.col("exit_ts")))


def port_dwell_times(pings: DataFrame, ports: DataFrame, **options) -> DataFrame:
    """The serving table of port visits."""
    return port_dwell_sessions(pings, ports, **options).select(
        "kpi_date", "mmsi", "port_id", "entry_ts", "exit_ts", "dwell_minutes"
    )


def turnaround_by_port_day(dwell: DataFrame) -> DataFrame:
    """Visits, vessels, mean stay and berth use per port and day; berth use is stay over 24 hours."""
    return dwell.groupBy("kpi_date", "port_id").agg(
        F.count(F.lit(1)).alias("visits"),
        F.countDistinct("mmsi").alias("vessels"),
        steady_round(F.avg("dwell_minutes"), 2).alias("avg_turnaround_minutes"),
        steady_round(F.sum("dwell_minutes") / F.lit(1440.0), 4).alias("avg_berths_used"),
    )
