"""Great-circle, grid, polygon and closest-approach maths as native column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_NM = 3440.065
#: Highest speed that cleaning lets through.
MAX_SOG_KNOTS = 102.2
METERS_PER_NM = 1852.0
KMH_PER_KNOT = 1.852


def haversine_nm(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in nautical miles."""
    h = F.pow(F.sin(F.radians(lat2 - lat1) / 2.0), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(F.radians(lon2 - lon1) / 2.0), F.lit(2.0))
    return F.lit(2.0 * EARTH_RADIUS_NM) * F.atan2(F.sqrt(h), F.sqrt(F.abs(F.lit(1.0) - h)))


def speed_kmh(knots: Column, digits: int | None = None) -> Column:
    kmh = knots * F.lit(KMH_PER_KNOT)
    return kmh if digits is None else F.round(kmh, digits)


def grid_snap(degrees: Column, step: float) -> Column:
    """Nearest grid line, half away from zero, as a 4-digit coordinate."""
    return F.round(F.round(degrees / F.lit(float(step))) * F.lit(float(step)), 4)


def wkt_point(lon: Column, lat: Column) -> Column:
    """`POINT(lon lat)`, NULL where a coordinate is missing."""
    text = F.concat(F.lit("POINT("), lon.cast("string"), F.lit(" "), lat.cast("string"), F.lit(")"))
    return F.when(lon.isNotNull() & lat.isNotNull(), text)


def wkt_lon(point: Column) -> Column:
    return F.regexp_extract(point, r"^POINT\((\S+) (\S+)\)$", 1).try_cast("double")


def wkt_lat(point: Column) -> Column:
    return F.regexp_extract(point, r"^POINT\((\S+) (\S+)\)$", 2).try_cast("double")


def wkt_ring(polygon: Column) -> Column:
    """Corners of a one-ring `POLYGON((lon lat, ...))` as array<struct<lon,lat>>."""
    body = F.regexp_extract(polygon, r"^\s*POLYGON\s*\(\(([^()]*)\)\)\s*$", 1)
    return F.transform(
        F.split(body, r"\s*,\s*"),
        lambda pair: F.struct(
            F.split(F.trim(pair), r"\s+")[0].try_cast("double").alias("lon"),
            F.split(F.trim(pair), r"\s+")[1].try_cast("double").alias("lat"),
        ),
    )


def valid_position(lat: Column, lon: Column) -> Column:
    """True, false, or NULL where a NULL coordinate leaves it open."""
    return (lat >= -90) & (lat <= 90) & (lon >= -180) & (lon <= 180)


# --- grid cells: lat/lon squares of `cell_deg`, longitude wrapped at 180 degrees -----------------

def lat_cell(lat: Column, cell_deg: float) -> Column:
    return F.floor(lat / F.lit(cell_deg)).cast("long")


def lon_cell(lon: Column, cell_deg: float) -> Column:
    return F.pmod(F.floor(lon / F.lit(cell_deg)).cast("long"), F.lit(cells_around(cell_deg)))


def cells_around(cell_deg: float) -> int:
    """Cells on a full circle of longitude; the cell width must divide it."""
    n = round(360.0 / cell_deg)
    if not math.isclose(n * cell_deg, 360.0, rel_tol=1e-9):
        raise ValueError(f"cell width {cell_deg} does not divide 360 degrees")
    return n


def circle_lat_margin(radius_nm: Column) -> Column:
    """Latitude half-width of a circle in degrees, with a hair of slack for rounding."""
    return F.degrees(radius_nm / F.lit(EARTH_RADIUS_NM)) * 1.0001 + 1e-9


def circle_lon_margin(lat: Column, radius_nm: Column) -> Column:
    """Longitude half-width of a circle in degrees; the whole circle where it reaches a pole."""
    ratio = F.sin(radius_nm / F.lit(EARTH_RADIUS_NM)) / F.greatest(F.cos(F.radians(lat)), F.lit(1e-12))
    reaches_pole = (F.abs(lat) + circle_lat_margin(radius_nm) >= 90.0) | (ratio >= 1.0)
    return F.when(reaches_pole, F.lit(180.0)).otherwise(
        F.degrees(F.asin(F.least(ratio, F.lit(1.0)))) * 1.0001 + 1e-9
    )


def cells_between_lat(lat_min: Column, lat_max: Column, cell_deg: float) -> Column:
    return F.sequence(lat_cell(lat_min, cell_deg), lat_cell(lat_max, cell_deg))


def cells_between_lon(lon_min: Column, lon_max: Column, cell_deg: float) -> Column:
    """Wrapped longitude cells from `lon_min` to `lon_max`, each once."""
    n = cells_around(cell_deg)
    lo = F.floor(lon_min / F.lit(cell_deg)).cast("long")
    hi = F.floor(lon_max / F.lit(cell_deg)).cast("long")
    walk = F.sequence(lo, F.least(hi, lo + F.lit(n - 1)))
    return F.transform(walk, lambda c: F.pmod(c, F.lit(n)))


# --- polygons -----------------------------------------------------------------------------------

def ring_edges(ring: Column) -> Column:
    """Edges of a ring as structs (x1, y1, x2, y2); the ring is closed if it is not yet."""
    shifted = F.concat(F.slice(ring, F.lit(2), F.size(ring) - 1), F.slice(ring, 1, 1))
    return F.zip_with(
        ring,
        shifted,
        lambda a, b: F.struct(
            a["lon"].alias("x1"), a["lat"].alias("y1"), b["lon"].alias("x2"), b["lat"].alias("y2")
        ),
    )


def in_ring(edges: Column, lon: Column, lat: Column) -> Column:
    """Even-odd ray cast to the east; lower and left borders count as inside."""

    def crosses(edge: Column) -> Column:
        straddles = (edge["y1"] > lat) != (edge["y2"] > lat)
        at = edge["x1"] + F.try_divide((edge["x2"] - edge["x1"]) * (lat - edge["y1"]), edge["y2"] - edge["y1"])
        return F.when(straddles, lon < at).otherwise(F.lit(False))

    return F.aggregate(edges, F.lit(False), lambda odd, edge: odd != crosses(edge))


# --- closest point of approach on a local plane ---------------------------------------------------

def velocity_east(sog: Column, cog: Column) -> Column:
    """Knots to the east; a ship without speed or course counts as lying still."""
    return F.coalesce(sog * F.sin(F.radians(cog)), F.lit(0.0))


def velocity_north(sog: Column, cog: Column) -> Column:
    return F.coalesce(sog * F.cos(F.radians(cog)), F.lit(0.0))


def wrap_degrees(diff: Column) -> Column:
    """A longitude difference brought into [-180, 180)."""
    return F.pmod(diff + 180.0, F.lit(360.0)) - 180.0


def minutes_to_closest(dx: Column, dy: Column, dvx: Column, dvy: Column) -> Column:
    """Minutes until two ships are closest; 0 when they draw apart or hold station."""
    closing = -(dx * dvx + dy * dvy)
    speed_sq = dvx * dvx + dvy * dvy
    return F.greatest(F.try_divide(closing * 60.0, speed_sq), F.lit(0.0))


def degrees_east(ping: Column, hours: Column) -> Column:
    """Degrees of longitude that a ping (struct with LAT, SOG, COG) goes east along its course in some hours."""
    return velocity_east(ping["SOG"], ping["COG"]) * hours / 60.0 / F.greatest(F.cos(F.radians(ping["LAT"])), F.lit(1e-6))


def moved(ping: Column, hours: Column) -> Column:
    """A ping (struct with LAT, LON, SOG, COG) carried along its course on a local plane for some hours."""
    north = velocity_north(ping["SOG"], ping["COG"])
    lat = F.greatest(F.lit(-90.0), F.least(F.lit(90.0), ping["LAT"] + north * hours / 60.0))
    lon = wrap_degrees(ping["LON"] + degrees_east(ping, hours))
    return ping.withField("LAT", lat).withField("LON", lon)
