"""Ping tables derived from the `events` table, as SQL text that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import schemas
from tidewatch.operators import clustering, fleet_state, kpis
from tidewatch.operators.dwell import port_dwell_times

# The ten seeded ports, numbered.
PORTS_SQL = """
SELECT CAST(idx AS BIGINT) AS idx, port_id, CAST(port_lat AS DOUBLE) AS port_lat,
 CAST(port_lon AS DOUBLE) AS port_lon, CAST(radius_nm AS DOUBLE) AS radius_nm
FROM (VALUES (0,'US_HOU',29.8,-95.1,5.0),(1,'US_SAN',32.7,-117.2,3.5),(2,'US_PEV',26.09,-80.12,3.0),
 (3,'US_FOU',29.11,-90.2,4.0),(4,'US_SEA',47.6,-122.35,3.5),(5,'US_NYC',40.67,-74.05,4.5),
 (6,'US_NOR',29.93,-90.06,4.0),(7,'EG_PSD',31.25,32.3,3.0),(8,'EG_SUZ',29.97,32.56,3.0),
 (9,'EG_ALY',31.19,29.88,3.0)) AS p(idx,port_id,port_lat,port_lon,radius_nm)
"""

_PINGS_SQL = """
SELECT e.event_id, 100000000 + {vessel} AS mmsi, e.ts AS base_date_time,
 p.port_lat + CAST((e.event_id * 7919) % 2001 - 1000 AS DOUBLE) / 10000.0 AS lat,
 p.port_lon + CAST((e.event_id * 104729) % 2001 - 1000 AS DOUBLE) / 10000.0 AS lon,
 CASE WHEN e.value / 2.0 >= 102.2 THEN NULL ELSE e.value / 2.0 END AS sog,
 CASE WHEN (e.event_id * 37) % 400 >= 360 THEN NULL ELSE CAST((e.event_id * 37) % 400 AS DOUBLE) END AS cog,
 CASE WHEN e.event_id % 10 = 0 THEN NULL ELSE CAST((e.event_id * 53) % 360 AS DOUBLE) END AS heading,
 CASE WHEN e.event_id % 7 = 0 THEN 'UNKNOWN' ELSE e.event_type END AS vessel_name,
 CASE e.user_id % 6 WHEN 0 THEN 30 WHEN 1 THEN 52 WHEN 2 THEN 70 WHEN 3 THEN 80 WHEN 4 THEN 99 END AS vessel_type,
 CAST(e.event_id % 16 AS INT) AS status
FROM events e JOIN ports p ON p.idx = e.user_id % 10
"""

# Five vessels, so that each holds a fifth of all rows.
PINGS_SQL = _PINGS_SQL.format(vessel="e.user_id % 5")
# One vessel per user.
FLEET_SQL = _PINGS_SQL.format(vessel="e.user_id")

RAW_PINGS_SQL = """
SELECT event_id,
 CASE WHEN event_id % 97 = 0 THEN 'MMSI' WHEN event_id % 89 = 0 THEN '12345' WHEN event_id % 83 = 0 THEN NULL
      ELSE concat(' ', CAST(100000000 + user_id % 5 AS STRING)) END AS mmsi,
 CASE WHEN event_id % 53 = 0 THEN 'bad-time' ELSE concat('2024-01-', lpad(CAST(event_id % 28 + 1 AS STRING), 2, '0'), 'T',
      lpad(CAST(event_id % 24 AS STRING), 2, '0'), ':', lpad(CAST(event_id % 60 AS STRING), 2, '0'), ':00') END AS base_date_time,
 CASE WHEN event_id % 71 = 0 THEN '95.5' WHEN event_id % 73 = 0 THEN 'n/a' WHEN event_id % 79 = 0 THEN NULL
      ELSE CAST(event_id % 180 - 90 AS STRING) END AS lat,
 CASE WHEN event_id % 67 = 0 THEN '-181' ELSE CAST(event_id % 360 - 180 AS STRING) END AS lon,
 CASE WHEN event_id % 61 = 0 THEN '102.3' WHEN event_id % 59 = 0 THEN '' ELSE CAST(event_id % 40 AS STRING) END AS sog,
 CAST((event_id * 37) % 400 AS STRING) AS cog,
 CASE WHEN event_id % 10 = 0 THEN '511' ELSE CAST((event_id * 53) % 360 AS STRING) END AS heading,
 CASE WHEN event_id % 7 = 0 THEN '  ' ELSE concat(' V', CAST(user_id AS STRING), ' ') END AS vessel_name,
 CASE WHEN event_id % 5 = 0 THEN 'IMO0000000' ELSE concat('IMO', CAST(1000000 + user_id AS STRING)) END AS imo,
 CASE WHEN event_id % 11 = 0 THEN '' ELSE CAST(30 + user_id % 60 AS STRING) END AS vessel_type
FROM events
"""

_NAMES = {
    "mmsi": "MMSI", "base_date_time": "BaseDateTime", "lat": "LAT", "lon": "LON", "sog": "SOG", "cog": "COG",
    "heading": "Heading", "vessel_name": "VesselName", "imo": "IMO", "vessel_type": "VesselType", "status": "Status",
}

# Centres for repeatable clusters; shift and scale are powers of two apart so that sums are exact alike.
CENTRES = clustering.Centres(
    inputs=clustering.FEATURES,
    shift=(16.0, 180.0, 32.0, -64.0),
    scale=(8.0, 128.0, 4.0, 64.0),
    points=(
        (-1.0, -0.5, 0.0, 0.0), (-1.0, 1.0, 0.0, 0.0), (1.0, -0.5, 0.0, 0.0),
        (1.0, 1.0, 0.0, 1.0), (4.0, 0.0, 0.0, 0.0),
    ),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _renamed(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.col(c).alias(_NAMES.get(c, c)) for c in rows.columns])


def _run(sql: str, events: DataFrame) -> DataFrame:
    spark = events.sparkSession
    text = sql.replace("FROM events e JOIN ports p", "FROM {events} e JOIN {ports} p").replace("\nFROM events\n", "\nFROM {events}\n")
    return _renamed(spark.sql(text, events=events, ports=spark.sql(PORTS_SQL)))


def pings_of(events: DataFrame) -> DataFrame:
    return _run(PINGS_SQL, events)


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pings of five vessels."""
    return pings_of(table(spark, sf_dir, "events"))


def fleet_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pings of one vessel per user."""
    return fleet_pings_of(table(spark, sf_dir, "events"))


def fleet_pings_of(events: DataFrame) -> DataFrame:
    return _run(FLEET_SQL, events)


def raw_pings_of(events: DataFrame) -> DataFrame:
    return _renamed(events.sparkSession.sql(RAW_PINGS_SQL.replace("\nFROM events\n", "\nFROM {events}\n"), events=events))


def raw_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Untyped pings with every kind of fault."""
    return raw_pings_of(table(spark, sf_dir, "events"))


def messages_of(events: DataFrame) -> DataFrame:
    """Raw pings as messages; every 101st body is cut off in the middle."""
    raw = raw_pings_of(events)
    body = F.to_json(F.struct(*[F.col(c) for c in raw.columns if c != "event_id"]))
    return raw.select(
        F.col("MMSI").cast("binary").alias("key"),
        F.when(F.col("event_id") % 101 == 0, F.lit('{"MMSI":')).otherwise(body).cast("binary").alias("value"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.lit("2024-02-01 00:00:00").cast("timestamp").alias("timestamp"),
    )


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream; its times become zoned, as watermarks need."""
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def event_batches(spark: SparkSession, sf_dir: str, path: str, batches: int = 4) -> DataFrame:
    """The events as a stream of several batches, up to six minutes out of order where one batch ends."""
    events = table(spark, sf_dir, "events")
    arrival = F.col("ts") + F.make_dt_interval(mins=(F.col("event_id") % 7).cast("int"))
    first, last = events.agg(F.min(arrival), F.max(arrival)).first()
    edges = [first + (last - first) * k / batches for k in range(1, batches)] if first else []
    place = sum(((arrival >= F.lit(e)).cast("int") for e in edges), F.lit(0))
    for batch in range(batches):  # one file after the other, as the file source orders them by age
        events.filter(place == batch).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", "1").parquet(path)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def port_reference(spark: SparkSession) -> DataFrame:
    return schemas.ports(spark)


def dwell(spark: SparkSession, sf_dir: str) -> DataFrame:
    return port_dwell_times(pings(spark, sf_dir), schemas.ports(spark))


def fleet_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.fleet_daily_kpis(pings(spark, sf_dir))


def density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.route_density_grid(pings(spark, sf_dir))


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpis.speed_alerts(pings(spark, sf_dir))


def state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fleet state whose update time is the time of the ping."""
    return fleet_state.latest_fleet_state(
        fleet_pings(spark, sf_dir), ["event_id"], last_updated=F.col("BaseDateTime")
    )


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster results of every day, on the fixed centres and with exact thresholds."""
    features = clustering.feature_rows(fleet_pings(spark, sf_dir), carry=["event_id"])
    return clustering.cluster_vessels(
        features, CENTRES, F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"), exact=True, tiebreak=["event_id"]
    )
