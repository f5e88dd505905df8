"""SQL for DuckDB that checks the registered queries on the same tables."""

from __future__ import annotations

from tidewatch import schemas
from tidewatch import surrogates as src
from tidewatch.registry import DAY, EMPTY_DAY, NOW

_SQL: dict[str, str] = {}


def all_sql() -> dict[str, str]:
    return dict(_SQL)


def half_up(x: str, digits: int) -> str:
    """Round on the decimal text of a double, as Spark does."""
    return f"CAST(round(CAST({x} AS DECIMAL(28, 12)), {digits}) AS DOUBLE)"


def nm(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    h = (
        f"(power(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * power(sin(radians({lon2} - {lon1}) / 2), 2))"
    )
    return f"(2 * 3440.065 * atan2(sqrt({h}), sqrt(1 - {h})))"


_secs = "(epoch_us({}) // 1000000)".format

_VISITS = f"""
SELECT CAST(g.base_date_time AS DATE) AS kpi_date, g.event_id, g.mmsi, g.base_date_time AS ts, p.port_id,
 {nm('p.port_lat', 'p.port_lon', 'g.lat', 'g.lon')} AS dist_nm
FROM {{pings}} g JOIN ports p ON {nm('p.port_lat', 'p.port_lon', 'g.lat', 'g.lon')} <= p.radius_nm
"""


def _sessions(keys: str) -> str:
    return f"""
SELECT {keys}, min(ts) AS entry_ts, max(ts) AS exit_ts, count(*) AS ping_count
FROM (SELECT *, sum(opens) OVER (PARTITION BY {keys} ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session_id
  FROM (SELECT *, CASE WHEN {_secs('ts')} - {_secs('lag(ts) OVER (PARTITION BY ' + keys + ' ORDER BY ts)')} <= 7200
    THEN 0 ELSE 1 END AS opens FROM visits) v) s
GROUP BY {keys}, session_id
"""


_MINUTES = f"round(({_secs('exit_ts')} - {_secs('entry_ts')}) / 60.0, 2)"

_LABEL = "CASE WHEN vessel_type IS NULL THEN 'Unknown' " + " ".join(
    f"WHEN vessel_type = {code} THEN '{name} ({code})'" for code, name in schemas.VESSEL_TYPES.items()
) + " ELSE 'Type ' || CAST(vessel_type AS VARCHAR) END"

_FLEET_KPIS = f"""
SELECT CAST(base_date_time AS DATE) AS kpi_date, {_LABEL} AS vessel_type,
 {half_up('avg(sog)', 2)} AS avg_sog, {half_up('min(sog)', 2)} AS min_sog, {half_up('max(sog)', 2)} AS max_sog,
 {half_up('coalesce(stddev_samp(sog), 0)', 2)} AS stddev_sog, count(*) AS ping_count
FROM pings WHERE sog >= 0 AND sog < 102.2 GROUP BY 1, 2
"""

_GRID = """
SELECT CAST(base_date_time AS DATE) AS kpi_date, round(round(lat / CAST(0.05 AS DOUBLE)) * CAST(0.05 AS DOUBLE), 4) AS grid_lat,
 round(round(lon / CAST(0.05 AS DOUBLE)) * CAST(0.05 AS DOUBLE), 4) AS grid_lon, count(*) AS ping_count
FROM pings WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 GROUP BY 1, 2, 3
"""

_ALERTS = f"""
SELECT base_date_time AS detected_at, mmsi, vessel_name, {half_up('sog', 2)} AS sog_knots, round(lat, 6) AS lat,
 round(lon, 6) AS lon, CAST(status AS VARCHAR) AS nav_status, 'SPEED_VIOLATION' AS alert_type,
 CAST(20.0 AS DOUBLE) AS threshold_knots
FROM pings WHERE sog > 20.0
"""

_STATE = """
SELECT mmsi, vessel_name, lat, lon, sog AS sog_knots, cog AS cog_degrees, heading AS heading_degrees,
 CAST(status AS VARCHAR) AS nav_status, base_date_time, base_date_time AS last_updated
FROM (SELECT *, row_number() OVER (PARTITION BY mmsi ORDER BY base_date_time DESC, event_id DESC) AS rn FROM fleet_pings) t
WHERE rn = 1
"""

_FEATURES = """
SELECT CAST(base_date_time AS DATE) AS kpi_date, mmsi, base_date_time, sog AS sog_knots, cog AS cog_degrees, lat, lon, event_id
FROM fleet_pings WHERE mmsi > 0 AND sog BETWEEN 0 AND 100 AND cog BETWEEN 0 AND 360 AND lat BETWEEN -90 AND 90
 AND lon BETWEEN -180 AND 180
"""


def _square(point: tuple[float, ...]) -> str:
    parts = [
        f"(({name} - ({shift})) * {1.0 / scale} - ({at}))"
        for name, shift, scale, at in zip(src.CENTRES.inputs, src.CENTRES.shift, src.CENTRES.scale, point, strict=True)
    ]
    return " + ".join(f"{p} * {p}" for p in parts)


_NEAREST = ", ".join(f"d{i}" for i in range(len(src.CENTRES.points)))
_ASSIGNED = f"""
SELECT *, CASE {' '.join(f'WHEN d{i} = least({_NEAREST}) THEN {i}' for i in range(len(src.CENTRES.points)))} END AS cluster_id,
 sqrt(least({_NEAREST})) AS distance
FROM (SELECT *, {', '.join(f'{_square(p)} AS d{i}' for i, p in enumerate(src.CENTRES.points))} FROM features) f
"""

_THRESHOLDS = """
SELECT kpi_date, cluster_id, min(distance) AS threshold_distance
FROM (SELECT kpi_date, cluster_id, distance, row_number() OVER (PARTITION BY kpi_date, cluster_id ORDER BY distance) AS rn,
  count(*) OVER (PARTITION BY kpi_date, cluster_id) AS n FROM assigned) r
WHERE rn >= ceil(CAST(0.95 AS DOUBLE) * n) GROUP BY kpi_date, cluster_id
"""

_CLUSTERS = f"""
SELECT kpi_date, mmsi, CAST(cluster_id AS INTEGER) AS cluster_id, round(lat, 6) AS lat, round(lon, 6) AS lon,
 {half_up('sog_knots', 2)} AS sog_knots, {half_up('cog_degrees', 2)} AS cog_degrees,
 {half_up('distance', 4)} AS distance_to_centroid, is_anomaly, TIMESTAMP '2024-02-01 00:00:00' AS model_run_ts
FROM (SELECT a.*, a.distance > t.threshold_distance AS is_anomaly,
  row_number() OVER (PARTITION BY a.kpi_date, a.mmsi ORDER BY a.base_date_time DESC, a.event_id DESC) AS rn
  FROM assigned a JOIN thresholds t ON t.kpi_date = a.kpi_date AND t.cluster_id = a.cluster_id) x
WHERE rn = 1
"""

# Typed raw pings with the reasons of the two profiles.
_TYPED = """
SELECT event_id, mmsi AS raw_mmsi, CASE WHEN regexp_full_match(trim(mmsi), '[0-9]{9}') THEN CAST(trim(mmsi) AS BIGINT) END AS mmsi,
 TRY_CAST(base_date_time AS TIMESTAMP) AS base_date_time, TRY_CAST(lat AS DOUBLE) AS lat, TRY_CAST(lon AS DOUBLE) AS lon,
 CASE WHEN TRY_CAST(sog AS DOUBLE) >= 102.2 THEN NULL ELSE TRY_CAST(sog AS DOUBLE) END AS sog,
 CASE WHEN TRY_CAST(cog AS DOUBLE) >= 360 THEN NULL ELSE TRY_CAST(cog AS DOUBLE) END AS cog,
 CASE WHEN TRY_CAST(heading AS DOUBLE) = 511 THEN NULL ELSE TRY_CAST(heading AS DOUBLE) END AS heading,
 nullif(trim(vessel_name), '') AS vessel_name, nullif(trim(imo), '') AS imo, TRY_CAST(vessel_type AS INTEGER) AS vessel_type,
 base_date_time AS raw_time, lat AS raw_lat, lon AS raw_lon, sog AS raw_sog, vessel_type AS raw_type
FROM raw_pings
"""

_REASONED = """
SELECT *, CASE WHEN raw_mmsi IS NULL THEN 'MMSI_MISSING' WHEN raw_mmsi = 'MMSI' THEN 'HEADER' WHEN mmsi IS NULL THEN 'MMSI_FORMAT'
 WHEN base_date_time IS NULL THEN 'TIMESTAMP'
 WHEN lat < -90 OR lat > 90 OR lon < -180 OR lon > 180 THEN 'LATLON_RANGE'
 WHEN lat IS NULL OR lon IS NULL THEN 'LATLON_MISSING' END AS reject_reason
FROM typed
"""

_FEATURE_COLUMNS = """
CAST(year(base_date_time) AS INTEGER) AS year, CAST(month(base_date_time) AS INTEGER) AS month,
 CAST(day(base_date_time) AS INTEGER) AS day, CAST(hour(base_date_time) AS INTEGER) AS hour,
 CAST(dayofweek(base_date_time) + 1 AS INTEGER) AS day_of_week, CAST(quarter(base_date_time) AS INTEGER) AS quarter,
 CAST(base_date_time AS DATE) AS date
"""

_CTES = {
    "ports": src.PORTS_SQL,
    "pings": src.PINGS_SQL,
    "fleet_pings": src.FLEET_SQL,
    "raw_pings": src.RAW_PINGS_SQL,
    "visits": _VISITS.format(pings="pings"),
    "dwell": f"SELECT *, {_MINUTES} AS dwell_minutes FROM ({_sessions('kpi_date, mmsi, port_id')}) q",
    "fleet_kpis": _FLEET_KPIS,
    "grid": _GRID,
    "alerts": _ALERTS,
    "state": _STATE,
    "features": _FEATURES,
    "assigned": _ASSIGNED,
    "thresholds": _THRESHOLDS,
    "clusters": _CLUSTERS,
    "typed": _TYPED,
    "reasoned": _REASONED,
}
_NEEDS = {
    "pings": ["ports"], "fleet_pings": ["ports"], "visits": ["pings"], "dwell": ["visits"], "fleet_kpis": ["pings"],
    "grid": ["pings"], "alerts": ["pings"], "state": ["fleet_pings"], "features": ["fleet_pings"],
    "assigned": ["features"], "thresholds": ["assigned"], "clusters": ["thresholds"], "typed": ["raw_pings"],
    "reasoned": ["typed"],
}


def _with(uses: list[str], body: str) -> str:
    order: list[str] = []

    def need(name: str) -> None:
        for other in _NEEDS.get(name, []):
            need(other)
        if name not in order:
            order.append(name)

    for name in uses:
        need(name)
    ctes = ",\n".join(f"{name} AS ({_CTES[name]})" for name in order)
    return f"WITH {ctes}\n{body}" if order else body


def check(name: str, uses: list[str], body: str) -> None:
    _SQL[name] = _with(uses, body)


# --- port visits, fleet speed, density, alerts

_DWELL_COLUMNS = "kpi_date, mmsi, port_id, entry_ts, exit_ts, ping_count, dwell_minutes"
check("port_dwell_sessions", ["dwell"], f"SELECT {_DWELL_COLUMNS} FROM dwell")
check("session_dwell_stream", ["dwell"], f"SELECT {_DWELL_COLUMNS} FROM dwell")
check("session_dwell_batches", ["dwell"], f"SELECT {_DWELL_COLUMNS} FROM dwell")
check("port_dwell_across_days", ["visits"], f"""
SELECT CAST(entry_ts AS DATE) AS kpi_date, mmsi, port_id, entry_ts, exit_ts, ping_count, {_MINUTES} AS dwell_minutes
FROM ({_sessions('mmsi, port_id')}) q""")
check("port_proximity_join", ["visits"], "SELECT event_id, port_id, round(dist_nm, 6) AS dist_nm FROM visits")
check("fleet_speed_kpis", ["fleet_kpis"], "SELECT * FROM fleet_kpis")
check("route_density_grid", ["grid"], "SELECT * FROM grid")
check("density_trend", ["grid"], """
SELECT *, ping_count - lag(ping_count) OVER (PARTITION BY grid_lat, grid_lon ORDER BY kpi_date) AS change FROM grid""")
check("speed_alerts", ["alerts"], "SELECT * FROM alerts")
check("alert_json", ["pings"], """
SELECT CAST(mmsi AS VARCHAR) AS key, mmsi, vessel_name, sog AS sog_knots, lat, lon, status AS nav_status,
 'SPEED_VIOLATION' AS alert_type, CAST(20.0 AS DOUBLE) AS threshold_knots FROM pings WHERE sog > 20.0""")
check("top_speeders", ["fleet_pings"], """
SELECT mmsi, max(sog) AS max_sog, count(*) AS ping_count FROM fleet_pings WHERE sog IS NOT NULL GROUP BY mmsi
ORDER BY max_sog DESC, mmsi LIMIT 20""")
check("turnaround_by_port_day", ["dwell"], f"""
SELECT kpi_date, port_id, count(*) AS visits, count(DISTINCT mmsi) AS vessels,
 {half_up('avg(dwell_minutes)', 2)} AS avg_turnaround_minutes, {half_up('sum(dwell_minutes) / 1440.0', 4)} AS avg_berths_used
FROM dwell GROUP BY kpi_date, port_id""")

# --- cleaning

check("clean_sentinels", ["typed"], 'SELECT event_id, sog AS "SOG", cog AS "COG", heading AS "Heading" FROM typed')
check("clean_ranges", ["reasoned"], """
SELECT event_id, mmsi AS "MMSI", base_date_time AS "BaseDateTime", lat AS "LAT", lon AS "LON", sog AS "SOG", cog AS "COG",
 heading AS "Heading" FROM reasoned WHERE reject_reason IS NULL AND coalesce(sog >= 0, true) AND coalesce(cog >= 0, true)
 AND coalesce(heading >= 0 AND heading < 360, true)""")
check("mmsi_rejects", ["reasoned"], """
SELECT event_id, raw_mmsi AS mmsi_text, reject_reason FROM reasoned WHERE reject_reason IN ('MMSI_MISSING', 'MMSI_FORMAT')""")
check("reject_reasons", ["reasoned"], """
SELECT coalesce(reject_reason, 'ACCEPTED') AS reject_reason, count(*) AS row_count FROM reasoned GROUP BY 1""")
check("reject_union", ["reasoned"], """
SELECT raw_mmsi AS "MMSI", raw_time AS "BaseDateTime",
 CASE WHEN reject_reason NOT LIKE 'MMSI%' THEN raw_lat END AS "LAT", CASE WHEN reject_reason NOT LIKE 'MMSI%' THEN raw_lon END AS "LON",
 CASE WHEN reject_reason = 'TIMESTAMP' THEN raw_type END AS "VesselType", reject_reason
FROM reasoned WHERE reject_reason IS NOT NULL AND reject_reason <> 'HEADER'""")
_raw_names = {
    "mmsi": "MMSI", "base_date_time": "BaseDateTime", "lat": "LAT", "lon": "LON", "sog": "SOG", "cog": "COG",
    "heading": "Heading", "vessel_name": "VesselName", "imo": "IMO", "vessel_type": "VesselType",
}
check("blank_to_null", ["raw_pings"], "SELECT event_id, " + ", ".join(
    f"nullif(trim({c}), '') AS \"{n}\"" for c, n in _raw_names.items()
) + " FROM raw_pings")
check("vessel_type_label", ["pings"], f"SELECT event_id, {_LABEL} AS vessel_type FROM pings")
check("calendar_features", ["pings"], f"SELECT event_id, {_FEATURE_COLUMNS} FROM pings")
check("dedup_positions", ["reasoned"], """
SELECT event_id, mmsi AS "MMSI", base_date_time AS "BaseDateTime", lat AS "LAT", lon AS "LON"
FROM (SELECT *, row_number() OVER (PARTITION BY mmsi, base_date_time ORDER BY event_id) AS rn FROM reasoned WHERE reject_reason IS NULL) r
WHERE rn = 1""")
check("stream_dedup", ["reasoned"], """
SELECT DISTINCT mmsi AS "MMSI", base_date_time AS "BaseDateTime" FROM reasoned WHERE reject_reason IS NULL""")
check("uniqueness_violations", ["reasoned"], """
SELECT mmsi AS "MMSI", base_date_time AS "BaseDateTime", count(*) AS copies FROM reasoned WHERE reject_reason IS NULL
GROUP BY 1, 2 HAVING count(*) > 1""")
check("recover_vessel_info", ["fleet_pings"], """
, named AS (SELECT event_id, mmsi, base_date_time, nullif(vessel_name, 'UNKNOWN') AS vessel_name, vessel_type FROM fleet_pings),
first_name AS (SELECT mmsi, vessel_name FROM (SELECT *, row_number() OVER (PARTITION BY mmsi ORDER BY base_date_time, event_id) AS rn
  FROM named WHERE vessel_name IS NOT NULL) x WHERE rn = 1),
first_type AS (SELECT mmsi, vessel_type FROM (SELECT *, row_number() OVER (PARTITION BY mmsi ORDER BY base_date_time, event_id) AS rn
  FROM named WHERE vessel_type IS NOT NULL) x WHERE rn = 1)
SELECT n.event_id, n.mmsi AS "MMSI", coalesce(n.vessel_name, f.vessel_name) AS "VesselName",
 coalesce(n.vessel_type, t.vessel_type) AS "VesselType"
FROM named n LEFT JOIN first_name f ON f.mmsi = n.mmsi LEFT JOIN first_type t ON t.mmsi = n.mmsi""")


def _cleaned(source: str, kmh: str) -> str:
    return f"""
SELECT event_id, mmsi AS "MMSI", base_date_time AS "BaseDateTime", lat AS "LAT", lon AS "LON", sog AS "SOG", cog AS "COG",
 heading AS "Heading", vessel_name AS "VesselName", imo AS "IMO", vessel_type AS "VesselType", {kmh} AS speed_kmh,
 {_FEATURE_COLUMNS} FROM {source}"""


check("clean_stream_profile", ["reasoned"], _cleaned("""
(SELECT event_id, mmsi, base_date_time, lat, lon, sog, cog, heading, coalesce(vessel_name, 'UNKNOWN') AS vessel_name,
  coalesce(nullif(imo, 'IMO0000000'), 'UNKNOWN') AS imo, vessel_type
 FROM (SELECT *, row_number() OVER (PARTITION BY mmsi, base_date_time ORDER BY event_id) AS rn FROM reasoned WHERE reject_reason IS NULL) r
 WHERE rn = 1) c""", "round(sog * 1.852, 6)"))
check("clean_batch_profile", ["reasoned"], """
, kept AS (SELECT event_id, mmsi, base_date_time, lat, lon, sog, cog, heading, vessel_name, nullif(imo, 'IMO0000000') AS imo, vessel_type
 FROM (SELECT *, row_number() OVER (PARTITION BY mmsi, base_date_time, lat, lon ORDER BY event_id) AS rn
   FROM reasoned WHERE reject_reason IS NULL AND coalesce(sog >= 0, true) AND coalesce(cog >= 0, true)
   AND coalesce(heading >= 0 AND heading < 360, true)) r WHERE rn = 1),
known AS (SELECT mmsi,
  arg_min(vessel_name, k) FILTER (WHERE vessel_name IS NOT NULL) AS vessel_name,
  arg_min(imo, k) FILTER (WHERE imo IS NOT NULL) AS imo,
  arg_min(vessel_type, k) FILTER (WHERE vessel_type IS NOT NULL) AS vessel_type
 FROM (SELECT *, row_number() OVER (PARTITION BY mmsi ORDER BY base_date_time, event_id) AS k FROM kept) x GROUP BY mmsi),
filled AS (SELECT p.event_id, p.mmsi, p.base_date_time, p.lat, p.lon, p.sog, p.cog, p.heading,
  coalesce(p.vessel_name, k.vessel_name, 'UNKNOWN') AS vessel_name, coalesce(p.imo, k.imo, 'UNKNOWN') AS imo,
  coalesce(p.vessel_type, k.vessel_type) AS vessel_type FROM kept p JOIN known k ON k.mmsi = p.mmsi)
""" + _cleaned("filled", half_up("sog * 1.852", 2)))

_MINIMAL = """
(SELECT *, TRY_CAST(raw_sog AS DOUBLE) AS speed, row_number() OVER (PARTITION BY raw_mmsi, base_date_time, lat, lon ORDER BY event_id) AS rn
 FROM typed WHERE raw_mmsi IS NOT NULL AND base_date_time IS NOT NULL AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180
 AND coalesce(TRY_CAST(raw_sog AS DOUBLE) >= 0, true)) m"""
check("clean_minimal", ["typed"], f"""
SELECT event_id, raw_mmsi AS "MMSI", base_date_time AS "BaseDateTime", lat AS "LAT", lon AS "LON", speed AS "SOG",
 {half_up('speed * 1.852', 2)} AS speed_kmh FROM {_MINIMAL} WHERE rn = 1""")
check("processing_summary", ["typed"], f"""
SELECT raw_records, processed_records, raw_records - processed_records AS removed_records
FROM (SELECT (SELECT count(*) FROM typed) AS raw_records, (SELECT count(*) FROM {_MINIMAL} WHERE rn = 1) AS processed_records) c""")
check("clean_legacy", ["raw_pings"], """
SELECT event_id, mmsi, "timestamp", lat, lon, sog, cog, round(sog * 1.852, 6) AS speed_kmh, '2024-02-01' AS run_date
FROM (SELECT *, row_number() OVER (PARTITION BY mmsi, "timestamp" ORDER BY event_id) AS rn
  FROM (SELECT event_id, trim(mmsi) AS mmsi, base_date_time AS "timestamp", TRY_CAST(lat AS DOUBLE) AS lat, TRY_CAST(lon AS DOUBLE) AS lon,
    TRY_CAST(sog AS DOUBLE) AS sog, TRY_CAST(cog AS DOUBLE) AS cog FROM raw_pings) t
  WHERE mmsi IS NOT NULL AND sog >= 0 AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180) r WHERE rn = 1""")
check("json_parse_split", ["raw_pings"], """
SELECT event_id, CASE WHEN event_id % 101 <> 0 THEN mmsi END AS "MMSI", event_id % 101 = 0 AS is_corrupt FROM raw_pings""")
check("props_json_fields", [], """
SELECT event_id, TRY_CAST(regexp_extract(props, '"k": (-?[0-9]+)', 1) AS INTEGER) AS k FROM events""")
check("csv_replay", ["raw_pings"], """
SELECT trim(mmsi) AS key, trim(base_date_time) AS "BaseDateTime", coalesce(trim(lat), '') AS "LAT", trim(lon) AS "LON", trim(sog) AS "SOG",
 trim(vessel_name) AS "VesselName" FROM raw_pings WHERE mmsi IS NOT NULL AND trim(mmsi) NOT IN ('', 'MMSI')""")

check("legacy_csv", ["raw_pings"], """
SELECT DISTINCT CAST(mmsi AS VARCHAR) AS mmsi, "timestamp", '2024-02-01' AS run_date
FROM (SELECT trim(mmsi) AS mmsi, base_date_time AS "timestamp", TRY_CAST(lat AS DOUBLE) AS lat, TRY_CAST(lon AS DOUBLE) AS lon,
  TRY_CAST(sog AS DOUBLE) AS sog FROM raw_pings) t
WHERE mmsi IS NOT NULL AND sog >= 0 AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180""")
check("delimited_customers", [], "SELECT CAST(c_nationkey AS INTEGER) AS c_nationkey, count(*) AS v FROM customer WHERE c_nationkey < 10 GROUP BY 1")
check("csv_columns_union", [], """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS priority, count(*) AS n FROM orders GROUP BY 1, 2""")
check("history_archive", ["reasoned"], """
, judged AS (SELECT *, CASE WHEN reject_reason IS NOT NULL THEN reject_reason WHEN NOT (coalesce(sog >= 0, true) AND coalesce(cog >= 0, true)
  AND coalesce(heading >= 0 AND heading < 360, true)) THEN 'MOTION' END AS reason FROM reasoned WHERE event_id % 101 <> 0)
SELECT DISTINCT 'kept' AS part, CAST(mmsi AS VARCHAR) AS "MMSI", base_date_time AS "BaseDateTime", lat AS "LAT", lon AS "LON", CAST(base_date_time AS DATE) AS date
FROM judged WHERE reason IS NULL
UNION ALL SELECT 'rejected:' || reason || ':' || count(*), NULL, NULL, NULL, NULL, NULL FROM judged WHERE reason <> 'HEADER' GROUP BY reason""")
check("replaced_days", ["dwell"], f"""
SELECT kpi_date, mmsi, port_id, entry_ts, dwell_minutes FROM dwell
WHERE kpi_date <> DATE '{EMPTY_DAY}' AND (kpi_date <> DATE '{DAY}' OR dwell_minutes >= 10)""")
check("voyage_layout", ["dwell"], """
SELECT kpi_date AS voyage_date, port_id AS port, mmsi, entry_ts, dwell_minutes FROM dwell WHERE port_id = 'US_HOU'""")

# --- fleet state, motion, zones, proximity

check("latest_fleet_state", ["state"], """
SELECT mmsi, vessel_name, sog_knots, cog_degrees, heading_degrees, nav_status, base_date_time, last_updated FROM state""")
check("fleet_state_view", ["state"], """
SELECT mmsi, vessel_name, lat, lon, sog_knots, cog_degrees, heading_degrees, nav_status, last_updated FROM state""")
check("fleet_staleness", ["state"], f"""
SELECT mmsi, last_updated FROM state WHERE last_updated < TIMESTAMP '{NOW}' - INTERVAL 24 HOURS""")
check("fleet_map_points", ["state"], "SELECT mmsi, lat, lon FROM state ORDER BY mmsi")
check("movement_distance", ["pings"], f"""
SELECT mmsi, count(*) AS ping_count, round(sum(coalesce(leg, 0)), 4) AS distance_nm
FROM (SELECT mmsi, {nm('plat', 'plon', 'lat', 'lon')} AS leg
  FROM (SELECT mmsi, lat, lon, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon FROM pings
    WINDOW w AS (PARTITION BY mmsi ORDER BY base_date_time, event_id)) p) l
GROUP BY mmsi""")
_acceleration = """
SELECT mmsi, window_start, ping_count, round((last_sog - first_sog) / ((epoch_us(last_at) - epoch_us(first_at)) / CAST(1000000 AS DOUBLE)), 9) AS acceleration
FROM (SELECT mmsi, date_trunc('minute', base_date_time) - to_minutes(k) AS window_start, count(*) AS ping_count,
  min(base_date_time) AS first_at, max(base_date_time) AS last_at, arg_min(sog, struct_pack(t := base_date_time, e := event_id)) AS first_sog,
  arg_max(sog, struct_pack(t := base_date_time, e := event_id)) AS last_sog
  FROM pings, (SELECT unnest(range(5)) AS k) s WHERE sog IS NOT NULL GROUP BY 1, 2) w
WHERE last_at > first_at"""
check("sliding_acceleration", ["pings"], _acceleration)
check("sliding_acceleration_stream", ["pings"], _acceleration)

_ZONE_ROWS = "(VALUES ('Port Said',32.25,31.20,32.35,31.30),('Suez Port',32.52,29.95,32.60,30.05),('Alexandria Port',29.85,31.17,29.95,31.23)) AS z(zone_id,x1,y1,x2,y2)"


def _inside(lon: str, lat: str) -> str:
    return " AND ".join([
        f"{lon} >= CAST(z.x1 AS DOUBLE)", f"{lon} < CAST(z.x2 AS DOUBLE)",
        f"{lat} >= CAST(z.y1 AS DOUBLE)", f"{lat} < CAST(z.y2 AS DOUBLE)",
    ])


check("pings_in_zones", ["pings"], f"""
SELECT event_id, zone_id FROM pings p JOIN {_ZONE_ROWS} ON {_inside('p.lon', 'p.lat')}""")
_geofence = f"""
SELECT mmsi, zone_id, CASE WHEN is_in AND was_in THEN 'INSIDE' WHEN is_in THEN 'ENTER' ELSE 'EXIT' END AS event_type,
 base_date_time AS event_time, event_id
FROM (SELECT p.mmsi, z.zone_id, p.base_date_time, p.event_id, {_inside('p.lon', 'p.lat')} AS is_in,
  coalesce({_inside('p.plon', 'p.plat')}, false) AS was_in
  FROM (SELECT *, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon FROM pings
    WINDOW w AS (PARTITION BY mmsi ORDER BY base_date_time, event_id)) p CROSS JOIN {_ZONE_ROWS}) e
WHERE is_in OR was_in"""
check("geofence_events", ["pings"], _geofence)
check("geofence_events_stream", ["pings"], _geofence)

_VE = "coalesce({0}.sog * sin(radians({0}.cog)), 0)".format
_VN = "coalesce({0}.sog * cos(radians({0}.cog)), 0)".format
_collisions = f"""
-- every two pings of different vessels at most 180 s apart, the earlier one (b) moved to the time of the later one (a)
, met AS (SELECT a.mmsi AS ma, b.mmsi AS mb, a.lat AS alat, a.lon AS alon, {_VE('a')} AS ave, {_VN('a')} AS avn, {_VE('b')} AS bve, {_VN('b')} AS bvn,
  a.base_date_time AS created_at, b.lat + {_VN('b')} * h / 60.0 AS blat,
  b.lon + {_VE('b')} * h / 60.0 / cos(radians(b.lat)) AS blon
  FROM (SELECT a, b, (epoch_us(a.base_date_time) - epoch_us(b.base_date_time)) / 3.6e9 AS h FROM fleet_pings a JOIN fleet_pings b
    ON epoch_us(a.base_date_time) // 180000000 - epoch_us(b.base_date_time) // 180000000 IN (0, 1) AND a.mmsi <> b.mmsi
    AND (b.base_date_time < a.base_date_time OR (b.base_date_time = a.base_date_time AND b.mmsi < a.mmsi))
    AND epoch_us(a.base_date_time) - epoch_us(b.base_date_time) <= 180000000 AND abs(a.lat - b.lat) < 0.2)),
pairs AS (SELECT *, {nm('alat', 'alon', 'blat', 'blon')} AS dist, least(ma, mb) AS m1, greatest(ma, mb) AS m2,
  (blon - alon) * 60.0 * cos(radians((alat + blat) / 2.0)) AS dx, (blat - alat) * 60.0 AS dy, bve - ave AS dvx, bvn - avn AS dvy,
  (alat + blat) / 2.0 AS mid_lat, (alon + blon) / 2.0 AS mid_lon, epoch_us(created_at) // 600000000 AS slice FROM met),
timed AS (SELECT *, greatest(CASE WHEN dvx * dvx + dvy * dvy <> 0 THEN -(dx * dvx + dy * dvy) * 60.0 / (dvx * dvx + dvy * dvy) END, 0) AS minutes
  FROM pairs WHERE dist < 1.0),
best AS (SELECT *, row_number() OVER (PARTITION BY slice, m1, m2 ORDER BY round(dist * 1852.0, 3), round(minutes, 6), created_at,
  round(mid_lat, 6), round(mid_lon, 6)) AS pick FROM timed WHERE minutes < 20)
SELECT slice, m1 AS vessel_1_mmsi, m2 AS vessel_2_mmsi, round(dist * 1852.0, 3) AS distance_meters, round(minutes, 6) AS cpa_minutes,
 CASE WHEN dist < 0.5 AND minutes < 10 THEN 'HIGH' ELSE 'MEDIUM' END AS risk_level, round(mid_lat, 6) AS mid_lat,
 round(mid_lon, 6) AS mid_lon, created_at
FROM best WHERE pick = 1"""
check("collision_pairs", ["fleet_pings"], _collisions)
check("collision_pairs_stream", ["fleet_pings"], _collisions)
_congestion = f"""
SELECT p.port_id, count(s.mmsi) AS active_vessels_count, {half_up('avg(s.sog_knots)', 6)} AS avg_speed_knots,
 CASE WHEN count(s.mmsi) >= 15 THEN 'HIGH' WHEN count(s.mmsi) >= 5 THEN 'MEDIUM' ELSE 'LOW' END AS congestion_risk
FROM ports p LEFT JOIN state s ON {nm('p.port_lat', 'p.port_lon', 's.lat', 's.lon')} <= p.radius_nm
GROUP BY p.port_id"""
check("port_congestion", ["state"], _congestion)
check("port_congestion_stream", ["state"], _congestion)

# --- clustering

check("stored_model_facts", ["features"], "SELECT count(*) AS rows, CAST(5 AS BIGINT) AS clusters, CAST(0 AS BIGINT) AS moved FROM features")

check("cluster_features", ["features"], "SELECT * FROM features")
_facts = ", ".join(
    f"('{c}', (SELECT round(avg({c}), 6) FROM {{0}}), (SELECT round(stddev_samp({c}), 6) FROM {{0}}))"
    for c in ("sog_knots", "cog_degrees", "lat", "lon")
)
check("kmeans_fit_facts", ["features"], f"""
SELECT input, mean, deviation, (SELECT count(*) FROM features) AS fitted_rows, 0 AS misassigned, true AS share_fits
FROM (VALUES {_facts.format('features')}) AS v(input, mean, deviation)""")
_headed = "headed AS (SELECT f.*, p.heading AS heading_degrees FROM features f JOIN fleet_pings p USING (event_id) WHERE p.heading BETWEEN 0 AND 360)"
check("kmeans_heading_fit_facts", ["features"], f"""
, {_headed}
SELECT input, mean, deviation, (SELECT count(*) FROM headed) AS fitted_rows, 0 AS misassigned, true AS share_fits
FROM (VALUES {_facts.format('headed')}, ('heading_degrees', (SELECT round(avg(heading_degrees), 6) FROM headed),
  (SELECT round(stddev_samp(heading_degrees), 6) FROM headed))) AS v(input, mean, deviation)""")
check("hash_sampled_lines", ["pings"], """
SELECT concat_ws(chr(9), CAST(event_id AS VARCHAR), CAST(CAST(round(lat * 10000) AS BIGINT) AS VARCHAR), CAST(CAST(round(lon * 10000) AS BIGINT) AS VARCHAR)) AS line
FROM pings WHERE left(md5('1234:' || event_id), 8) < 'd999999a'""")
check("cluster_assignment", ["assigned"], """
SELECT event_id, mmsi, CAST(cluster_id AS INTEGER) AS cluster_id, round(distance, 9) AS distance_to_centroid FROM assigned""")
check("distance_percentile_exact", ["thresholds"], """
SELECT kpi_date, CAST(cluster_id AS INTEGER) AS cluster_id, round(threshold_distance, 9) AS threshold_distance FROM thresholds""")
check("cluster_vessels", ["clusters"], """
SELECT kpi_date, mmsi, cluster_id, lat, lon, sog_knots, cog_degrees, is_anomaly, model_run_ts FROM clusters""")
check("embedding_distance", [], """
WITH parts AS (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
means AS (SELECT label, pos, avg(CAST(x AS DOUBLE)) AS mean FROM parts GROUP BY label, pos)
SELECT p.vec_id, p.label, round(sqrt(sum((CAST(p.x AS DOUBLE) - m.mean) * (CAST(p.x AS DOUBLE) - m.mean))), 6) AS distance
FROM parts p JOIN means m ON m.label = p.label AND m.pos = p.pos GROUP BY p.vec_id, p.label""")

# --- serving queries

_on_day = f"kpi_date = DATE '{DAY}'"
check("busiest_ports", ["dwell"], f"""
SELECT port_id, count(*) AS total_visits, {half_up('avg(dwell_minutes)', 1)} AS avg_dwell_minutes,
 {half_up('max(dwell_minutes)', 1)} AS max_dwell_minutes FROM dwell WHERE {_on_day} GROUP BY port_id
ORDER BY total_visits DESC, port_id LIMIT 5""")
check("dwell_events_by_port", ["dwell"], f"""
SELECT kpi_date, port_id, count(*) AS completed_dwell_events, {half_up('avg(dwell_minutes)', 1)} AS avg_dwell_mins
FROM dwell WHERE {_on_day} GROUP BY kpi_date, port_id""")
check("dwell_by_port", ["dwell"], f"""
SELECT port_id, {half_up('avg(dwell_minutes)', 1)} AS avg_dwell_mins, count(*) AS dwell_events FROM dwell GROUP BY port_id
ORDER BY avg_dwell_mins DESC, port_id""")
check("pings_by_type_top", ["fleet_kpis"], f"""
SELECT vessel_type, avg_sog AS avg_speed_kts, max_sog AS max_speed_kts, ping_count AS total_pings FROM fleet_kpis WHERE {_on_day}
ORDER BY total_pings DESC, vessel_type LIMIT 5""")
check("fleet_kpi_top", ["fleet_kpis"], f"""
SELECT kpi_date, vessel_type, ping_count, avg_sog AS avg_sog_kts, max_sog AS max_sog_kts FROM fleet_kpis WHERE {_on_day}
ORDER BY ping_count DESC, vessel_type LIMIT 5""")
check("speed_by_type", ["fleet_kpis"], f"""
SELECT vessel_type, CAST(sum(ping_count) AS BIGINT) AS total_pings, {half_up('avg(avg_sog)', 2)} AS avg_speed_kts,
 max(max_sog) AS max_speed_kts FROM fleet_kpis GROUP BY vessel_type ORDER BY total_pings DESC, vessel_type""")
check("grid_top_cells", ["grid"], f"""
SELECT grid_lat, grid_lon, ping_count AS density_pings FROM grid WHERE {_on_day}
ORDER BY density_pings DESC, grid_lat, grid_lon LIMIT 5""")
check("active_vessels", ["state"], "SELECT count(DISTINCT mmsi) AS active_vessels FROM state")
check("fleet_size", ["state"], "SELECT count(*) AS fleet_rows FROM state")
check("vessel_roster", ["state"], """
SELECT mmsi, vessel_name, sog_knots, cog_degrees, nav_status, last_updated FROM state ORDER BY last_updated DESC, mmsi LIMIT 100""")
check("latest_updates", ["state"], """
SELECT mmsi, vessel_name, sog_knots, last_updated FROM state ORDER BY last_updated DESC, mmsi LIMIT 10""")
check("violation_count", ["alerts"], "SELECT count(*) AS speed_violations FROM alerts")
check("alert_log", ["alerts"], """
SELECT detected_at, mmsi, vessel_name, sog_knots, threshold_knots, lat, lon FROM alerts
ORDER BY detected_at DESC, mmsi, lat, lon LIMIT 100""")

_anom = "count(*) FILTER (WHERE is_anomaly)"
_avg_sog = half_up("avg(sog_knots)", 2)
_avg_cog = half_up("avg(cog_degrees)", 1)
_avg_dist = half_up("avg(distance_to_centroid)", 4)
_summary = f"""
SELECT cluster_id, count(*) AS total_vessels, {_anom} AS anomaly_count, {_avg_sog} AS avg_sog_knots, {_avg_dist} AS avg_distance
FROM clusters {{where}} GROUP BY cluster_id"""
check("cluster_summary_for_day", ["clusters"], _summary.format(where=f"WHERE {_on_day}"))
check("cluster_summary", ["clusters"], _summary.format(where=""))
check("cluster_geometry", ["clusters"], f"""
SELECT kpi_date, cluster_id, count(*) AS vessel_count, {_anom} AS anomalies_flagged, {_avg_sog} AS avg_sog_kts,
 count(*) FILTER (WHERE lat IS NOT NULL AND lon IS NOT NULL) AS valid_points FROM clusters WHERE {_on_day} GROUP BY kpi_date, cluster_id""")
check("top_anomalous_vessels", ["clusters"], f"""
SELECT mmsi, cluster_id, sog_knots, cog_degrees, distance_to_centroid, lon, lat FROM clusters WHERE {_on_day} AND is_anomaly
ORDER BY distance_to_centroid DESC, mmsi LIMIT 5""")
check("anomalies_with_names", ["clusters", "state"], f"""
SELECT c.mmsi, s.vessel_name, c.cluster_id, c.sog_knots AS cluster_sog, c.distance_to_centroid, c.is_anomaly
FROM clusters c LEFT JOIN state s ON s.mmsi = c.mmsi WHERE {_on_day} AND c.is_anomaly
ORDER BY c.distance_to_centroid DESC, c.mmsi LIMIT 5""")
check("flagged_anomalies", ["clusters"], f"SELECT {_anom} AS flagged_anomalies FROM clusters")
check("vessels_per_cluster", ["clusters"], """
SELECT cluster_id, count(*) AS vessel_count FROM clusters GROUP BY cluster_id ORDER BY vessel_count DESC, cluster_id""")
check("cluster_behaviour", ["clusters"], f"""
SELECT cluster_id, count(*) AS vessels, {_anom} AS anomalies_flagged, {_avg_sog} AS avg_speed_kts, {_avg_dist} AS avg_centroid_dist
FROM clusters GROUP BY cluster_id ORDER BY cluster_id""")
check("cluster_label_counts", ["clusters"], """
SELECT 'Cluster ' || CAST(cluster_id AS VARCHAR) AS cluster_label, count(*) AS vessel_count FROM clusters GROUP BY cluster_id""")
check("anomaly_split", ["clusters"], """
SELECT CASE WHEN is_anomaly THEN 'Outlier / Anomaly (Distance > P95)' ELSE 'Normal Navigation Profile' END AS fleet_status,
 count(*) AS vessel_count FROM clusters GROUP BY is_anomaly""")
_rate = half_up(f"100.0 * {_anom} / count(*)", 2)
check("cluster_anomaly_pct", ["clusters"], f"""
SELECT 'Cluster ' || CAST(cluster_id AS VARCHAR) AS cluster_name, count(*) AS total_fleet,
 count(*) FILTER (WHERE NOT is_anomaly) AS normal_vessels, {_anom} AS anomalous_vessels, {_rate} AS anomaly_pct
FROM clusters GROUP BY cluster_id""")
check("cluster_averages", ["clusters"], f"""
SELECT 'Cluster ' || CAST(cluster_id AS VARCHAR) AS cluster_name, {_avg_sog} AS avg_sog_knots, {_avg_cog} AS avg_cog_degrees,
 {_avg_dist} AS avg_distance_to_centroid FROM clusters GROUP BY cluster_id""")
check("anomaly_trend", ["clusters"], f"""
SELECT CAST(kpi_date AS VARCHAR) AS partition_date, count(*) AS total_active_vessels, {_anom} AS anomalous_vessels,
 {_rate} AS anomaly_rate_pct FROM clusters GROUP BY kpi_date""")
check("top_outliers", ["clusters"], f"""
SELECT mmsi, CAST(kpi_date AS VARCHAR) AS observation_date, cluster_id, distance_to_centroid, sog_knots,
 {half_up('cog_degrees', 1)} AS cog_degrees, round(lat, 4) AS latitude, round(lon, 4) AS longitude, is_anomaly
FROM clusters WHERE is_anomaly ORDER BY distance_to_centroid DESC, mmsi, kpi_date LIMIT 20""")
check("cluster_share", ["clusters"], f"""
SELECT cluster_id, count(*) AS vessel_count, {_anom} AS anomaly_count, {_avg_sog} AS avg_sog, min(sog_knots) AS min_sog,
 max(sog_knots) AS max_sog, {_avg_dist} AS avg_dist, max(distance_to_centroid) AS max_dist,
 {half_up('100.0 * count(*) / (SELECT count(*) FROM clusters)', 1)} AS share_pct, {_rate} AS anomaly_rate_pct
FROM clusters GROUP BY cluster_id""")
check("cluster_totals", ["clusters"], f"""
SELECT count(*) AS total_rows, count(DISTINCT mmsi) AS unique_vessels, count(DISTINCT kpi_date) AS num_dates,
 min(kpi_date) AS first_date, max(kpi_date) AS last_date, {_anom} AS total_anomalies FROM clusters""")
check("boxplot_stats", ["clusters"], """
, boxes AS (SELECT cluster_id, count(*) AS vessel_count, quantile_cont(sog_knots, 0.25) AS q1, quantile_cont(sog_knots, 0.5) AS median,
  quantile_cont(sog_knots, 0.75) AS q3 FROM clusters GROUP BY cluster_id),
fenced AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM boxes)
SELECT f.cluster_id, f.vessel_count, round(f.q1, 6) AS q1, round(f.median, 6) AS median, round(f.q3, 6) AS q3,
 round(min(c.sog_knots) FILTER (WHERE c.sog_knots BETWEEN lo AND hi), 6) AS low_whisker,
 round(max(c.sog_knots) FILTER (WHERE c.sog_knots BETWEEN lo AND hi), 6) AS high_whisker,
 count(*) FILTER (WHERE NOT (c.sog_knots BETWEEN lo AND hi)) AS fliers
FROM fenced f JOIN clusters c ON c.cluster_id = f.cluster_id GROUP BY f.cluster_id, f.vessel_count, f.q1, f.median, f.q3""")
check("distance_histogram", ["clusters"], """
SELECT c.cluster_id, CAST(least(floor(coalesce((c.distance_to_centroid - lo) / nullif(hi - lo, 0), 0) * 30), 29) AS INTEGER) AS bin,
 count(*) AS vessel_count
FROM clusters c JOIN (SELECT cluster_id, min(distance_to_centroid) AS lo, max(distance_to_centroid) AS hi FROM clusters GROUP BY cluster_id) e
 ON e.cluster_id = c.cluster_id GROUP BY 1, 2""")
check("cluster_matrix", ["clusters"], f"""
SELECT cluster_id, count(*) AS fleet_count, {_anom} AS anomaly_count, {_rate} AS anomaly_rate_pct, {_avg_sog} AS avg_sog_knots,
 {_avg_cog} AS avg_cog_degrees, {_avg_dist} AS avg_distance, max(distance_to_centroid) AS max_distance,
 count(*) FILTER (WHERE lat IS NOT NULL AND lon IS NOT NULL) AS vessels_with_geom FROM clusters GROUP BY cluster_id""")
check("row_counts_by_date", ["fleet_kpis", "dwell", "grid", "alerts"], """
SELECT 'fleet_daily_kpis' AS table_name, kpi_date, count(*) AS row_count FROM fleet_kpis GROUP BY kpi_date
UNION ALL SELECT 'port_dwell_times', kpi_date, count(*) FROM dwell GROUP BY kpi_date
UNION ALL SELECT 'route_density_grid', kpi_date, count(*) FROM grid GROUP BY kpi_date
UNION ALL SELECT 'vessel_speed_alerts', CAST(detected_at AS DATE), count(*) FROM alerts GROUP BY 2""")
check("row_counts_for_date", ["fleet_kpis", "dwell", "grid", "clusters"], f"""
SELECT 'fleet_daily_kpis' AS table_name, count(*) AS row_count FROM fleet_kpis WHERE {_on_day}
UNION ALL SELECT 'port_dwell_times', count(*) FROM dwell WHERE {_on_day}
UNION ALL SELECT 'route_density_grid', count(*) FROM grid WHERE {_on_day}
UNION ALL SELECT 'vessel_behavior_clusters', count(*) FROM clusters WHERE {_on_day}""")
check("serving_key_violations", ["dwell", "fleet_kpis", "grid", "clusters", "state"], """
SELECT 'port_dwell_times' AS table_name, count(*) AS copies FROM dwell GROUP BY kpi_date, mmsi, port_id, entry_ts HAVING count(*) > 1
UNION ALL SELECT 'fleet_daily_kpis', count(*) FROM fleet_kpis GROUP BY kpi_date, vessel_type HAVING count(*) > 1
UNION ALL SELECT 'route_density_grid', count(*) FROM grid GROUP BY kpi_date, grid_lat, grid_lon HAVING count(*) > 1
UNION ALL SELECT 'vessel_behavior_clusters', count(*) FROM clusters GROUP BY kpi_date, mmsi, model_run_ts HAVING count(*) > 1
UNION ALL SELECT 'active_fleet_state', count(*) FROM state GROUP BY mmsi HAVING count(*) > 1""")

# --- streams

_counts = "SELECT event_type, count(*) AS pv FROM events GROUP BY event_type"
check("running_counts_stream", [], _counts)
check("running_total_stream", [], "SELECT max(ts) AS max_time, count(*) AS total FROM events")
_tumbling = """
SELECT time_bucket(INTERVAL 5 SECONDS, ts, TIMESTAMP '1970-01-01') AS start_time, event_type, count(*) AS pv FROM events GROUP BY 1, 2"""
check("tumbling_counts", [], _tumbling)
check("tumbling_counts_stream", [], _tumbling)
check("stream_fanout", ["reasoned"], """
, good AS (SELECT mmsi, base_date_time, min(sog) AS low_sog, max(sog) AS high_sog FROM reasoned
  WHERE reject_reason IS NULL AND event_id % 101 <> 0 GROUP BY mmsi, base_date_time)
SELECT 'fleet_state' AS sink, count(DISTINCT mmsi) AS row_count FROM good
UNION ALL SELECT 'archive', count(*) FROM good
UNION ALL SELECT 'rejects', count(*) FROM reasoned WHERE reject_reason IS NOT NULL AND reject_reason <> 'HEADER' AND event_id % 101 <> 0
UNION ALL SELECT 'json_rejects', count(*) FROM events WHERE event_id % 101 = 0
UNION ALL SELECT 'speed_alerts', count(*) FROM (SELECT *, row_number() OVER (PARTITION BY mmsi, base_date_time ORDER BY event_id) AS rn
  FROM reasoned WHERE reject_reason IS NULL AND event_id % 101 <> 0) r WHERE rn = 1 AND sog > 20""")

_good = "reject_reason IS NULL AND event_id % 101 <> 0"
check("archive_sink", ["reasoned"], f"""
SELECT mmsi AS "MMSI", base_date_time AS "BaseDateTime", {_FEATURE_COLUMNS}, CAST(0 AS BIGINT) AS batch_id
FROM (SELECT DISTINCT mmsi, base_date_time FROM reasoned WHERE {_good}) g""")
check("rejects_sink", ["reasoned"], """
SELECT event_id AS kafka_offset, raw_mmsi AS "MMSI", raw_time AS "BaseDateTime", raw_lat AS "LAT", raw_lon AS "LON", raw_sog AS "SOG", reject_reason
FROM reasoned WHERE reject_reason IS NOT NULL AND reject_reason <> 'HEADER' AND event_id % 101 <> 0""")
check("dead_letters_sink", [], """
SELECT event_id AS kafka_offset, '{"MMSI":' AS raw_json, 'JSON_CORRUPT' AS reject_reason FROM events WHERE event_id % 101 = 0""")
check("fleet_state_sink", ["reasoned"], f"""
SELECT mmsi, max(base_date_time) AS base_date_time FROM reasoned WHERE {_good} GROUP BY mmsi""")

# --- notebook reports

_words = r"""
SELECT word, count(*) AS word_count FROM (SELECT unnest(string_split_regex(text, '[ \t\n\x0B\f\r]')) AS word FROM documents) w
WHERE word <> '' GROUP BY word"""
check("word_count", [], _words)
check("word_count_stream", [], _words)
check("counts_below", [], "SELECT p_size, count(*) AS v FROM part WHERE p_size < 30 GROUP BY p_size")
check("counts_where", [], "SELECT c_nationkey, count(*) AS v FROM customer WHERE c_mktsegment = 'BUILDING' GROUP BY c_nationkey")
check("best_group", [], """
WITH c AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)
SELECT c.o_custkey, c.n, customer.c_name AS name FROM c JOIN customer ON customer.c_custkey = c.o_custkey
WHERE c.n = (SELECT max(n) FROM c)""")
check("monthly_counts", [], """
WITH c AS (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority)
SELECT CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS n FROM orders
WHERE o_orderpriority IN (SELECT o_orderpriority FROM c WHERE n = (SELECT max(n) FROM c)) GROUP BY 1""")
_names = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sept','Oct','Nov','Dec']"
_pivot = f"""
SELECT CAST(y - (y - first) % 3 AS INTEGER) AS from_year, CAST(m AS INTEGER) AS month, {_names}[m] AS month_name, {', '.join(
    f'count(*) FILTER (WHERE (y - first) % 3 = {k}) AS year_{k + 1}' for k in range(3))}
FROM (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, min(year(o_orderdate)) OVER () AS first FROM orders WHERE o_orderdate IS NOT NULL) o GROUP BY 1, 2, 3"""
check("monthly_pivot", [], _pivot)
check("avg_per_day", [], f"""
SELECT from_year, month, month_name, {', '.join(f"year_{k + 1} // day(last_day(make_date(from_year + {k}, month, 1))) AS year_{k + 1}" for k in range(3))} FROM ({_pivot}) p""")
_by_year = f"""
SELECT CAST(month(o_orderdate) AS INTEGER) AS month, {_names}[month(o_orderdate)] AS month_name,
 CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders GROUP BY ALL"""
check("month_year_counts", [], _by_year)
check("month_year_per_day", [], f"""
SELECT month, month_name, year, n // day(last_day(make_date(year, month, 1))) AS per_day FROM ({_by_year}) c""")
check("least_squares", [], """
WITH s AS (SELECT sum(l_quantity * l_quantity) AS a, sum(l_quantity * l_discount) AS b, sum(l_discount * l_discount) AS c,
 sum(l_quantity * (l_extendedprice / 1000.0)) AS p, sum(l_discount * (l_extendedprice / 1000.0)) AS q FROM lineitem)
SELECT 'l_quantity' AS term, round((p * c - b * q) / (a * c - b * b), 6) AS beta FROM s
UNION ALL SELECT 'l_discount', round((a * q - b * p) / (a * c - b * b), 6) FROM s""")
check("sine_and_surface", [], """
SELECT l_orderkey, l_linenumber, round(sin(x * 8.0), 9) AS sin_8x, round(exp(-(x * x + y * y) / 2.0), 9) AS gauss
FROM (SELECT l_orderkey, l_linenumber, CAST(l_discount AS DOUBLE) AS x, CAST(l_tax AS DOUBLE) AS y FROM lineitem) e""")
