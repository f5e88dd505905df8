"""Positions joined to circles and polygons through shared grid cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import geo
from tidewatch.operators.lookup import join_lookup

CELL_DEG = 0.25
DEFAULT_RADIUS_NM = 3.0


def circle_cells(circles: DataFrame, cell_deg: float = CELL_DEG, default_radius_nm: float = DEFAULT_RADIUS_NM) -> DataFrame:
    """One row per grid cell a port's circle touches; a missing radius becomes the default first."""
    radius = F.coalesce("radius_nm", F.lit(float(default_radius_nm)))
    lat, lon = F.col("port_lat"), F.col("port_lon")
    dlat = geo.circle_lat_margin(radius)
    dlon = geo.circle_lon_margin(lat, radius)
    return (
        circles.withColumn("radius_nm", radius)
        .withColumn("cell_lat", F.explode(geo.cells_between_lat(lat - dlat, lat + dlat, cell_deg)))
        .withColumn("cell_lon", F.explode(geo.cells_between_lon(lon - dlon, lon + dlon, cell_deg)))
    )


def ring_cells(zones: DataFrame, cell_deg: float = CELL_DEG) -> DataFrame:
    """One row per grid cell of a zone's bounding box, with the ring as edges."""
    lats = F.transform("ring", lambda p: p["lat"])
    lons = F.transform("ring", lambda p: p["lon"])
    return (
        zones.withColumn("edges", geo.ring_edges(F.col("ring")))
        .withColumn("cell_lat", F.explode(geo.cells_between_lat(F.array_min(lats), F.array_max(lats), cell_deg)))
        .withColumn("cell_lon", F.explode(geo.cells_between_lon(F.array_min(lons), F.array_max(lons), cell_deg)))
        .drop("ring")
    )


def near_ports(
    pings: DataFrame,
    ports: DataFrame,
    default_radius_nm: float = DEFAULT_RADIUS_NM,
    cell_deg: float = CELL_DEG,
) -> DataFrame:
    """Every ping within a port's radius, with `port_id` and `dist_nm`.

    The cell equi-join replaces a cross join with ports; the exact distance decides.
    """
    cells = circle_cells(ports, cell_deg, default_radius_nm).select(
        "port_id", "port_lat", "port_lon", "radius_nm", "cell_lat", "cell_lon"
    )
    located = pings.withColumn("cell_lat", geo.lat_cell(F.col("LAT"), cell_deg)).withColumn(
        "cell_lon", geo.lon_cell(F.col("LON"), cell_deg)
    )
    distance = geo.haversine_nm(F.col("port_lat"), F.col("port_lon"), F.col("LAT"), F.col("LON"))
    return (
        join_lookup(located, cells, ["cell_lat", "cell_lon"])
        .withColumn("dist_nm", distance)
        .filter(F.col("dist_nm") <= F.col("radius_nm"))
        .drop("cell_lat", "cell_lon", "port_lat", "port_lon", "radius_nm")
    )
