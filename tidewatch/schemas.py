"""Schemas of pings and serving tables, and the fixed reference values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.functions.geo import wkt_ring

RAW_FIELDS = (
    "MMSI", "BaseDateTime", "LAT", "LON", "SOG", "COG", "Heading", "VesselName", "IMO",
    "CallSign", "VesselType", "Status", "Length", "Width", "Draft", "Cargo", "TransceiverClass",
)
CORRUPT = "_corrupt_record"

DOUBLE_FIELDS = ("LAT", "LON", "SOG", "COG", "Heading", "Length", "Width", "Draft")
INT_FIELDS = ("VesselType", "Status", "Cargo")
TEXT_FIELDS = ("VesselName", "IMO", "CallSign", "TransceiverClass")
VESSEL_INFO_FIELDS = (
    "VesselName", "IMO", "CallSign", "VesselType", "Length", "Width", "Draft", "Cargo",
    "TransceiverClass",
)

RAW_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in RAW_FIELDS])
RAW_SCHEMA_WITH_CORRUPT = T.StructType([*RAW_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

LEGACY_CSV_SCHEMA = T.StructType([
    T.StructField("mmsi", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lon", T.DoubleType()),
    T.StructField("sog", T.DoubleType()),
    T.StructField("cog", T.DoubleType()),
])

CALENDAR_FIELDS = ("year", "month", "day", "hour", "day_of_week", "quarter")

CLEAN_SCHEMA = T.StructType([
    T.StructField("kafka_partition", T.IntegerType()),
    T.StructField("kafka_offset", T.LongType()),
    T.StructField("kafka_timestamp", T.TimestampType()),
    T.StructField("MMSI", T.LongType()),
    T.StructField("BaseDateTime", T.TimestampType()),
    T.StructField("LAT", T.DoubleType()),
    T.StructField("LON", T.DoubleType()),
    T.StructField("SOG", T.DoubleType()),
    T.StructField("COG", T.DoubleType()),
    T.StructField("Heading", T.DoubleType()),
    T.StructField("VesselName", T.StringType()),
    T.StructField("IMO", T.StringType()),
    T.StructField("CallSign", T.StringType()),
    T.StructField("VesselType", T.IntegerType()),
    T.StructField("Status", T.IntegerType()),
    T.StructField("Length", T.DoubleType()),
    T.StructField("Width", T.DoubleType()),
    T.StructField("Draft", T.DoubleType()),
    T.StructField("Cargo", T.IntegerType()),
    T.StructField("TransceiverClass", T.StringType()),
    T.StructField("speed_kmh", T.DoubleType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("hour", T.IntegerType()),
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("quarter", T.IntegerType()),
    T.StructField("date", T.DateType()),
])

# Serving tables: unique keys that hold per table.
SERVING_KEYS = {
    "port_dwell_times": ("kpi_date", "mmsi", "port_id", "entry_ts"),
    "fleet_daily_kpis": ("kpi_date", "vessel_type"),
    "route_density_grid": ("kpi_date", "grid_lat", "grid_lon"),
    "vessel_behavior_clusters": ("kpi_date", "mmsi", "model_run_ts"),
    "active_fleet_state": ("mmsi",),
}

# Ship type codes of the AIS standard.
VESSEL_TYPES = {
    0: "Not available / Default",
    20: "Wing in Ground",
    30: "Fishing",
    31: "Towing",
    32: "Towing: length exceeds 200m or breadth exceeds 25m",
    33: "Dredging or underwater ops",
    34: "Diving ops",
    35: "Military ops",
    36: "Sailing",
    37: "Pleasure Craft",
    40: "High Speed Craft (HSC)",
    50: "Pilot Vessel",
    51: "Search and Rescue vessel",
    52: "Tug",
    53: "Port Tender",
    54: "Anti-pollution equipment",
    55: "Law Enforcement",
    56: "Spare - Local Vessel",
    57: "Spare - Local Vessel",
    58: "Medical Transport",
    60: "Passenger",
    70: "Cargo",
    71: "Cargo - Hazard A",
    72: "Cargo - Hazard B",
    73: "Cargo - Hazard C",
    74: "Cargo - Hazard D",
    79: "Cargo - No additional info",
    80: "Tanker",
    81: "Tanker - Hazard A",
    82: "Tanker - Hazard B",
    83: "Tanker - Hazard C",
    84: "Tanker - Hazard D",
    89: "Tanker - No additional info",
    90: "Other Type",
}

PORT_COLUMNS = ("port_id", "port_name", "port_lat", "port_lon", "radius_nm")

# Seeded ports (id, name, lat, lon, radius in NM).
PORTS = (
    ("US_HOU", "Port of Houston", 29.8, -95.1, 5.0),
    ("US_SAN", "Port of San Diego", 32.7, -117.2, 3.5),
    ("US_PEV", "Port Everglades", 26.09, -80.12, 3.0),
    ("US_FOU", "Port Fourchon", 29.11, -90.2, 4.0),
    ("US_SEA", "Port of Seattle", 47.6, -122.35, 3.5),
    ("US_NYC", "Port of New York & New Jersey", 40.67, -74.05, 4.5),
    ("US_NOR", "Port of New Orleans", 29.93, -90.06, 4.0),
    ("EG_PSD", "Port Said", 31.25, 32.3, 3.0),
    ("EG_SUZ", "Suez Port", 29.97, 32.56, 3.0),
    ("EG_ALY", "Alexandria Port", 31.19, 29.88, 3.0),
)

# Seeded zones (name, type, country, corners as WKT, longitude first).
ZONES = (
    ("Port Said", "port", "EG", "POLYGON((32.25 31.20, 32.35 31.20, 32.35 31.30, 32.25 31.30, 32.25 31.20))"),
    ("Suez Port", "port", "EG", "POLYGON((32.52 29.95, 32.60 29.95, 32.60 30.05, 32.52 30.05, 32.52 29.95))"),
    ("Alexandria Port", "port", "EG", "POLYGON((29.85 31.17, 29.95 31.17, 29.95 31.23, 29.85 31.23, 29.85 31.17))"),
)


def inline_rows(spark: SparkSession, rows: Sequence[Sequence], columns: Sequence[str]) -> DataFrame:
    """A small literal table; the planner sees its exact size."""
    values = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, float):
        return f"{value!r}D"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def ports(spark: SparkSession) -> DataFrame:
    """The seeded port reference as a DataFrame."""
    return inline_rows(spark, PORTS, PORT_COLUMNS)


def zones(spark: SparkSession) -> DataFrame:
    """The seeded zones; `ring` holds the corners."""
    rows = inline_rows(spark, ZONES, ("zone_id", "zone_type", "country", "wkt"))
    return rows.select("zone_id", "zone_type", "country", wkt_ring(F.col("wkt")).alias("ring"))


def vessel_types(spark: SparkSession) -> DataFrame:
    """The ship type codes as a table."""
    return inline_rows(spark, tuple(VESSEL_TYPES.items()), ("code", "name"))
