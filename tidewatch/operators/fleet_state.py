"""The newest known state of every vessel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.geo import valid_position, wkt_lat, wkt_lon, wkt_point
from tidewatch.operators.dedup import last_per_key, row_order
from tidewatch.operators.shape import first_rows

STATE_COLUMNS = (
    "mmsi", "vessel_name", "point", "sog_knots", "cog_degrees", "heading_degrees", "nav_status",
    "base_date_time", "last_updated",
)


def latest_pings(pings: DataFrame, tiebreak: list[str] | None = None) -> DataFrame:
    """The newest ping per vessel; ties in time go to the later source position."""
    ties = tiebreak if tiebreak is not None else [c for c in row_order(pings) if c not in ("MMSI", "BaseDateTime")]
    return last_per_key(pings, ["MMSI"], ["BaseDateTime", *ties])


def fleet_rows(pings: DataFrame, last_updated: Column | None = None) -> DataFrame:
    """Pings shaped as fleet state rows; without a position a ping is left out."""
    updated = F.current_timestamp() if last_updated is None else last_updated
    return pings.filter(F.col("LAT").isNotNull() & F.col("LON").isNotNull()).select(
        F.col("MMSI").cast("long").alias("mmsi"),
        F.col("VesselName").alias("vessel_name"),
        wkt_point(F.col("LON"), F.col("LAT")).alias("point"),
        F.col("SOG").alias("sog_knots"),
        F.col("COG").alias("cog_degrees"),
        F.col("Heading").alias("heading_degrees"),
        F.col("Status").cast("string").alias("nav_status"),
        F.col("BaseDateTime").alias("base_date_time"),
        updated.alias("last_updated"),
    )


def latest_fleet_state(pings: DataFrame, tiebreak: list[str] | None = None, last_updated: Column | None = None) -> DataFrame:
    located = pings.filter(F.col("LAT").isNotNull() & F.col("LON").isNotNull())
    return fleet_rows(latest_pings(located, tiebreak), last_updated)


def merge_state(current: DataFrame, changes: DataFrame) -> DataFrame:
    """Keyed upsert guarded by event time: an older ping never replaces a newer one."""
    both = current.unionByName(changes)
    return last_per_key(both, ["mmsi"], ["base_date_time", "last_updated", "point"])


def fleet_state_view(state: DataFrame) -> DataFrame:
    """The state with the point taken apart into lat and lon."""
    return state.select(
        "mmsi", "vessel_name", wkt_lat(F.col("point")).alias("lat"), wkt_lon(F.col("point")).alias("lon"),
        "sog_knots", "cog_degrees", "heading_degrees", "nav_status", "last_updated",
    )


def stale_vessels(state: DataFrame, now: Column, older_than: str = "INTERVAL 1 HOUR") -> DataFrame:
    """Vessels not heard of for a while."""
    return state.filter(F.col("last_updated") < now - F.expr(older_than))


def mapped_points(view: DataFrame, n: int | None = None) -> DataFrame:
    """Map points with a position: all of them, or the first `n` by vessel."""
    return first_rows(view.filter(valid_position(F.col("lat"), F.col("lon"))).orderBy("mmsi"), n)
