"""Fleet speed profile, route density and speed alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.geo import grid_snap, valid_position
from tidewatch.functions.labels import vessel_type_label
from tidewatch.functions.numbers import steady_round

SOG_SENTINEL = 102.2
ALERT_KNOTS = 20.0


def fleet_daily_kpis(pings: DataFrame, digits: int = 2) -> DataFrame:
    """Speed statistics per day and ship type over pings with a real speed."""
    sog = F.col("SOG")
    return (
        pings.filter((sog >= 0.0) & (sog < SOG_SENTINEL))
        .groupBy(F.to_date("BaseDateTime").alias("kpi_date"), "VesselType")
        .agg(
            steady_round(F.avg(sog), digits).alias("avg_sog"),
            F.round(F.min(sog), digits).alias("min_sog"),
            F.round(F.max(sog), digits).alias("max_sog"),
            steady_round(F.coalesce(F.stddev(sog), F.lit(0.0)), digits).alias("stddev_sog"),
            F.count(F.lit(1)).alias("ping_count"),
        )
        .select(
            "kpi_date", vessel_type_label(F.col("VesselType")).alias("vessel_type"),
            "avg_sog", "min_sog", "max_sog", "stddev_sog", "ping_count",
        )
    )


def route_density_grid(pings: DataFrame, cell_deg: float = 0.05) -> DataFrame:
    """Pings per day and grid cell."""
    return (
        pings.filter(valid_position(F.col("LAT"), F.col("LON")))
        .groupBy(
            F.to_date("BaseDateTime").alias("kpi_date"),
            grid_snap(F.col("LAT"), cell_deg).alias("grid_lat"),
            grid_snap(F.col("LON"), cell_deg).alias("grid_lon"),
        )
        .agg(F.count(F.lit(1)).alias("ping_count"))
    )


def density_trend(grid: DataFrame) -> DataFrame:
    """Pings per cell and day with the change since the cell's last day with traffic."""
    by_day = Window.partitionBy("grid_lat", "grid_lon").orderBy("kpi_date")
    return grid.withColumn("change", F.col("ping_count") - F.lag("ping_count").over(by_day))


def speed_alerts(pings: DataFrame, threshold_knots: float = ALERT_KNOTS) -> DataFrame:
    """One row per ping above the threshold, stamped with the time of the ping."""
    return pings.filter(F.col("SOG") > threshold_knots).select(
        F.col("BaseDateTime").alias("detected_at"),
        F.col("MMSI").cast("long").alias("mmsi"),
        F.col("VesselName").cast("string").alias("vessel_name"),
        F.round("SOG", 2).alias("sog_knots"),
        F.round("LAT", 6).alias("lat"),
        F.round("LON", 6).alias("lon"),
        F.col("Status").cast("string").alias("nav_status"),
        F.lit("SPEED_VIOLATION").alias("alert_type"),
        F.lit(float(threshold_knots)).alias("threshold_knots"),
    )


def alert_messages(pings: DataFrame, threshold_knots: float = ALERT_KNOTS, detected_at=None) -> DataFrame:
    """`key` and JSON `value` for the alert topic; NULL fields are left out of the JSON."""
    stamp = F.current_timestamp() if detected_at is None else detected_at
    body = F.struct(
        F.col("MMSI").alias("mmsi"),
        F.col("VesselName").alias("vessel_name"),
        F.col("SOG").alias("sog_knots"),
        F.col("LAT").alias("lat"),
        F.col("LON").alias("lon"),
        F.col("BaseDateTime").alias("base_date_time"),
        F.col("Status").alias("nav_status"),
        F.lit("SPEED_VIOLATION").alias("alert_type"),
        F.lit(float(threshold_knots)).alias("threshold_knots"),
        stamp.alias("detected_at"),
    )
    return pings.filter(F.col("SOG") > threshold_knots).select(
        F.col("MMSI").cast("string").alias("key"), F.to_json(body).alias("value")
    )


def top_speeders(pings: DataFrame, n: int = 20) -> DataFrame:
    """Vessels by their highest speed."""
    return (
        pings.filter(F.col("SOG").isNotNull())
        .groupBy(F.col("MMSI").cast("long").alias("mmsi"))
        .agg(F.max("SOG").alias("max_sog"), F.count(F.lit(1)).alias("ping_count"))
        .orderBy(F.desc("max_sog"), "mmsi")
        .limit(n)
    )
