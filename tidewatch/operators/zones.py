"""Geofences: which zone a ping lies in, and the events of entering and leaving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import geo
from tidewatch.operators.lookup import join_lookup
from tidewatch.operators.sequences import with_previous
from tidewatch.operators.spatial import CELL_DEG, ring_cells


def pings_in_zones(pings: DataFrame, zones: DataFrame, cell_deg: float = CELL_DEG) -> DataFrame:
    """Every ping inside a zone's ring, with `zone_id`."""
    cells = ring_cells(zones, cell_deg).select("zone_id", "edges", "cell_lat", "cell_lon")
    located = pings.withColumn("cell_lat", geo.lat_cell(F.col("LAT"), cell_deg)).withColumn(
        "cell_lon", geo.lon_cell(F.col("LON"), cell_deg)
    )
    return (
        join_lookup(located, cells, ["cell_lat", "cell_lon"])
        .filter(geo.in_ring(F.col("edges"), F.col("LON"), F.col("LAT")))
        .drop("cell_lat", "cell_lon", "edges")
    )


def geofence_events(
    pings: DataFrame, zones: DataFrame, tiebreak: list[str], cell_deg: float = CELL_DEG
) -> DataFrame:
    """ENTER, INSIDE and EXIT per vessel and zone, from each ping and the one before it.

    A ping is looked up by its own cell (ENTER or INSIDE) and by its predecessor's (EXIT), so zones far
    from both are never touched.
    """
    cells = ring_cells(zones, cell_deg).select("zone_id", "edges", "cell_lat", "cell_lon")
    track = pings.filter(geo.valid_position(F.col("LAT"), F.col("LON"))).select(
        F.col("MMSI").cast("long").alias("mmsi"), "BaseDateTime", *tiebreak, "LAT", "LON"
    )
    steps = with_previous(track, ["mmsi"], "BaseDateTime", ["LAT", "LON"], tiebreak)

    def side(name: str, lat, lon):
        return F.struct(
            F.lit(name).alias("side"),
            geo.lat_cell(lat, cell_deg).alias("cell_lat"),
            geo.lon_cell(lon, cell_deg).alias("cell_lon"),
        )

    sides = F.array(
        side("now", F.col("LAT"), F.col("LON")), side("before", F.col("prev.LAT"), F.col("prev.LON"))
    )
    probes = steps.withColumn("_p", F.explode(sides)).select("*", "_p.*").drop("_p").filter("cell_lat IS NOT NULL")
    now = geo.in_ring(F.col("edges"), F.col("LON"), F.col("LAT"))
    before = F.col("prev").isNotNull() & geo.in_ring(F.col("edges"), F.col("prev.LON"), F.col("prev.LAT"))
    event = (
        F.when((F.col("side") == "now") & F.col("_now") & ~F.col("_before"), "ENTER")
        .when((F.col("side") == "now") & F.col("_now"), "INSIDE")
        .when((F.col("side") == "before") & F.col("_before") & ~F.col("_now"), "EXIT")
    )
    return (
        join_lookup(probes, cells, ["cell_lat", "cell_lon"])
        .withColumn("_now", now)
        .withColumn("_before", F.coalesce(before, F.lit(False)))
        .withColumn("event_type", event)
        .filter("event_type IS NOT NULL")
        .select("mmsi", "zone_id", "event_type", F.col("BaseDateTime").alias("event_time"), *tiebreak)
    )
