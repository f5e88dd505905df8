import datetime as dt
import random

import pytest
from helpers import haversine, rows
from pyspark.sql import functions as F

from tidewatch import registry, schemas
from tidewatch.functions import geo, labels
from tidewatch.operators import (
    checks, clustering, dedup, dwell, fleet_state, kpis, lookup, motion, orderstats, proximity, regression, sequences,
    spatial, zones,
)
from tidewatch.plans import serving

T0 = dt.datetime(2024, 1, 1, 6)
PING = "event_id long, MMSI long, BaseDateTime timestamp, LAT double, LON double, SOG double, COG double, VesselName string, VesselType int, Status int, Heading double"


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def pings(spark, data):
    """Tuples (mmsi, seconds, lat, lon, sog, cog)."""
    return spark.createDataFrame(
        [(i, m, at(s), la, lo, sog, cog, "N", 70, 0, 90.0) for i, (m, s, la, lo, sog, cog) in enumerate(data)], PING
    )


def houston(spark, *seconds, mmsi=1):
    return pings(spark, [(mmsi, s, 29.8, -95.1, 1.0, 0.0) for s in seconds])


# --- port visits

@pytest.mark.parametrize("gap, visits", [(7200, 1), (7201, 2)])
def test_dwell_gap_is_strict(spark, gap, visits):
    got = dwell.port_dwell_sessions(houston(spark, 0, gap), schemas.ports(spark))
    assert got.count() == visits


def test_dwell_across_slices_and_single_ping(spark):
    found = dwell.port_dwell_sessions(houston(spark, 10, 7000, 14100, 30000), schemas.ports(spark))
    assert rows(found, "ping_count", "dwell_minutes") == [(1, 0.0), (3, 234.83)]


def test_dwell_days_split_or_not(spark):
    late = houston(spark, 64000, 65000, 66000)
    ports = schemas.ports(spark)
    assert dwell.port_dwell_sessions(late, ports).count() == 2
    assert dwell.port_dwell_sessions(late, ports, split_days=False).count() == 1


def test_dwell_matches_row_by_row_sessions(spark):
    rng = random.Random(5)
    seconds = sorted(rng.sample(range(60000), 60))
    got = dwell.port_dwell_sessions(houston(spark, *seconds), schemas.ports(spark), gap_seconds=1500)
    want, start, last, n = [], seconds[0], seconds[0], 0
    for s in seconds:
        if s - last > 1500:
            want.append((at(start), at(last), n))
            start, n = s, 0
        last, n = s, n + 1
    want.append((at(start), at(last), n))
    assert rows(got, "entry_ts", "exit_ts", "ping_count") == sorted(want, key=repr)


def test_missing_radius_becomes_default(spark):
    port = schemas.inline_rows(spark, [("X", "X", 29.8, -95.1)], ("port_id", "port_name", "port_lat", "port_lon")).withColumn(
        "radius_nm", F.lit(None).cast("double")
    )
    near = pings(spark, [(1, 0, 29.84, -95.1, 1.0, 0.0), (1, 1, 29.86, -95.1, 1.0, 0.0)])
    assert rows(spatial.near_ports(near, port, 3.0), "event_id") == [(0,)]


def test_circle_join_matches_brute_force_everywhere(spark):
    rng = random.Random(3)
    ports = [("P0", "n", 0.0, 179.99, 30.0), ("P1", "n", 89.9, 10.0, 60.0), ("P2", "n", 60.0, -180.0, 25.0), ("P3", "n", -47.0, 0.0, 5.0), ("P4", "n", -89.99, 0.0, 300.0)]
    points = []
    for _, _, la, lo, _ in ports:
        for _ in range(120):
            points.append((max(-90.0, min(90.0, la + rng.uniform(-1, 1))), (lo + rng.uniform(-3, 3) + 180) % 360 - 180))
    points += [(rng.choice([89.95, -89.95]), rng.uniform(-180, 180)) for _ in range(60)]
    df = pings(spark, [(1, i, la, lo, 1.0, 0.0) for i, (la, lo) in enumerate(points)])
    want = sorted(
        (i, p[0]) for i, (la, lo) in enumerate(points) for p in ports if haversine(p[2], p[3], la, lo) <= p[4]
    )
    ref = schemas.inline_rows(spark, ports, schemas.PORT_COLUMNS)
    for cell in (0.25, 1.0):
        got = spatial.near_ports(df, ref, cell_deg=cell)
        assert sorted((r["event_id"], r["port_id"]) for r in got.collect()) == want


def test_lookup_salted_path_equals_broadcast(spark):
    big = spark.range(500).select((F.col("id") % 3).alias("k"), "id")
    small = schemas.inline_rows(spark, [(0, "a"), (1, "b"), (1, "c")], ("k", "name"))
    for how in ("inner", "left"):
        one = lookup.join_lookup(big, small, ["k"], how)
        two = lookup.join_lookup(big, small, ["k"], how, max_broadcast_rows=1, salts=4)
        assert rows(one, "k", "id", "name") == rows(two, "k", "id", "name")
    with pytest.raises(ValueError):
        lookup.join_lookup(big, small, ["k"], "full")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_salted_copies_are_not_broadcast(spark, tmp_path, how):
    big = spark.range(2000).selectExpr("id % 300 AS k", "id")
    spark.range(250).selectExpr("id AS k", "id * 2 AS v").write.parquet(str(tmp_path / "lookup"))
    small = spark.read.parquet(str(tmp_path / "lookup"))
    joined = lookup.join_lookup(big, small, ["k"], how, max_broadcast_rows=249)
    got = sorted((r.id, r.k, r.v) for r in joined.collect())
    assert got == [(i, i % 300, i % 300 * 2 if i % 300 < 250 else None) for i in range(2000) if how == "left" or i % 300 < 250]
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()


# --- KPIs

def test_fleet_kpis_labels_and_single_ping(spark):
    data = [(0, 1, T0, 0.0, 0.0, s, 0.0, "N", t, 0, 1.0) for s, t in ((10.0, 70), (12.0, 70), (5.0, 99), (3.0, None), (102.2, 30), (None, 30))]
    got = {r["vessel_type"]: r for r in kpis.fleet_daily_kpis(spark.createDataFrame(data, PING)).collect()}
    assert set(got) == {"Cargo (70)", "Type 99", "Unknown"}
    assert (got["Cargo (70)"]["avg_sog"], got["Cargo (70)"]["stddev_sog"], got["Cargo (70)"]["ping_count"]) == (11.0, 1.41, 2)
    assert got["Type 99"]["stddev_sog"] == 0.0


def test_all_vessel_types_have_labels(spark):
    got = schemas.vessel_types(spark).select("code", "name", labels.vessel_type_label(F.col("code")).alias("label"))
    assert all(r["label"] == f"{r['name']} ({r['code']})" for r in got.collect()) and got.count() == 34


def test_alert_threshold_is_strict_and_json_leaves_out_nulls(spark):
    data = [(0, 1, T0, 1.0, 2.0, s, 0.0, None, 70, 0, 1.0) for s in (20.0, 20.01, None)]
    df = spark.createDataFrame(data, PING)
    assert rows(kpis.speed_alerts(df), "sog_knots", "alert_type") == [(20.01, "SPEED_VIOLATION")]
    message = kpis.alert_messages(df).collect()[0]
    assert message["key"] == "1" and "vessel_name" not in message["value"] and "detected_at" in message["value"]


def test_grid_snap_half_up(spark):
    halves = spark.sql("SELECT 0.25D AS x UNION ALL SELECT -0.25D UNION ALL SELECT 29.7D").select(geo.grid_snap(F.col("x"), 0.5))
    assert sorted(r[0] for r in halves.collect()) == [-0.5, 0.5, 29.5]


def test_density_trend(spark):
    grid = schemas.inline_rows(spark, [("2024-01-01", 1.0, 2.0, 5), ("2024-01-03", 1.0, 2.0, 9), ("2024-01-02", 1.0, 3.0, 4)], ("kpi_date", "grid_lat", "grid_lon", "ping_count"))
    assert rows(kpis.density_trend(grid), "ping_count", "change") == [(4, None), (5, None), (9, 4)]


# --- state and sequences

def test_latest_state_and_guarded_merge(spark):
    df = pings(spark, [(1, 10, 1.0, 2.0, 3.0, 4.0), (1, 20, 5.0, 6.0, 7.0, 8.0), (2, 5, 1.0, 1.0, 1.0, 1.0), (3, 1, None, 1.0, 1.0, 1.0)])
    now = F.col("BaseDateTime")
    state = fleet_state.latest_fleet_state(df, ["event_id"], now)
    assert rows(state, "mmsi", "point") == [(1, "POINT(6.0 5.0)"), (2, "POINT(1.0 1.0)")]
    older = fleet_state.fleet_rows(pings(spark, [(1, 15, 9.0, 9.0, 9.0, 9.0), (2, 50, 9.0, 9.0, 9.0, 9.0)]), now)
    merged = fleet_state.merge_state(state, older)
    assert rows(fleet_state.fleet_state_view(merged), "mmsi", "lat", "lon") == [(1, 5.0, 6.0), (2, 9.0, 9.0)]
    stale = fleet_state.stale_vessels(merged, F.lit(at(45)), "INTERVAL 20 SECONDS")
    assert rows(stale, "mmsi") == [(1,)]


@pytest.mark.parametrize("slice_seconds, max_rows", [(1, 1000), (60, 2), (100_000, 20)])
def test_previous_row_is_the_same_for_any_slice(spark, slice_seconds, max_rows):
    rng = random.Random(1)
    data = [(rng.choice([1, 1, 1, 2]), rng.randrange(2000), float(i), 0.0, 1.0, 0.0) for i in range(300)]
    df = pings(spark, data)
    got = sequences.with_previous(df, ["MMSI"], "BaseDateTime", ["LAT"], ["event_id"], slice_seconds=slice_seconds, max_rows=max_rows)
    want, last = [], {}
    for i, (m, s, la, *_) in sorted(enumerate(data), key=lambda x: (x[1][1], x[0])):
        want.append((i, last.get(m)))
        last[m] = la
    assert [(r[0], r[1]) for r in got.select("event_id", "prev.LAT").orderBy("event_id").collect()] == sorted(want)


@pytest.mark.parametrize("slice_seconds", [5, 3600])
def test_movement_distance(spark, slice_seconds):
    rng = random.Random(2)
    data = [(rng.choice([1, 2]), s * 3, rng.uniform(-1, 1), rng.uniform(179, 181) - 180, 1.0, 0.0) for s in range(100)]
    got = {r["mmsi"]: r for r in motion.movement_distance(pings(spark, data), ["event_id"], slice_seconds=slice_seconds, max_rows=9).collect()}
    for m in (1, 2):
        track = [(la, lo) for mm, _, la, lo, *_ in data if mm == m]
        want = sum(haversine(*a, *b) for a, b in zip(track, track[1:]))
        assert got[m]["distance_nm"] == pytest.approx(want) and got[m]["ping_count"] == len(track)


def test_full_slices_are_cut_until_they_fit(spark):
    data = [(1, s, 0.0, 0.0, 1.0, 0.0) for s in [*range(200), *[50] * 30, 9000]]
    sliced = sequences.with_slices(pings(spark, data), ["MMSI"], "BaseDateTime", slice_seconds=7200, max_rows=8)
    found = sliced.groupBy("_slice").agg(F.count("*").alias("n"), F.countDistinct("BaseDateTime").alias("instants"))
    sizes = [(r["n"], r["instants"]) for r in found.collect()]
    assert all(n <= 8 or instants == 1 for n, instants in sizes)
    assert sliced.count() == len(data)


def test_lookup_size_counts_bytes_too(spark):
    wide = spark.range(10).select("id", F.repeat(F.lit("x"), 1000).alias("text"))
    assert lookup.fits_broadcast(wide) and not lookup.fits_broadcast(wide, max_bytes=5000)
    assert not lookup.fits_broadcast(wide, max_rows=9) and lookup.fits_broadcast(wide.limit(0))


def test_sliding_acceleration(spark):
    got = motion.sliding_acceleration(pings(spark, [(1, 0, 0.0, 0.0, 10.0, 0.0), (1, 60, 0.0, 0.0, 16.0, 0.0), (1, 61, 0.0, 0.0, None, 0.0)]), ["event_id"])
    assert got.count() == 4 and {round(r["acceleration"], 6) for r in got.collect()} == {0.1}


def test_geofence_enter_inside_exit_and_gap(spark):
    track = [(31.0, 32.0), (31.25, 32.30), (31.26, 32.31), (31.0, 32.0), (31.25, 32.3), (30.0, 32.55), (31.3, 32.3)]
    got = zones.geofence_events(pings(spark, [(1, i * 4000, la, lo, 1.0, 0.0) for i, (la, lo) in enumerate(track)]), schemas.zones(spark), ["event_id"])
    assert [(r["event_id"], r["zone_id"], r["event_type"]) for r in got.orderBy("event_id", "zone_id").collect()] == [
        (1, "Port Said", "ENTER"), (2, "Port Said", "INSIDE"), (3, "Port Said", "EXIT"), (4, "Port Said", "ENTER"),
        (5, "Port Said", "EXIT"), (5, "Suez Port", "ENTER"), (6, "Suez Port", "EXIT"),
    ]


def test_ring_of_any_shape(spark):
    ring = "POLYGON((0 0, 4 0, 4 4, 2 1, 0 4, 0 0))"
    points = [(1.0, 1.0, True), (2.0, 3.0, False), (3.9, 3.0, True), (5.0, 1.0, False), (0.0, 1.0, True), (4.0, 1.0, False)]
    df = schemas.inline_rows(spark, [(*p, ring) for p in [(x, y) for x, y, _ in points]], ("x", "y", "w"))
    got = df.select("x", "y", geo.in_ring(geo.ring_edges(geo.wkt_ring(F.col("w"))), F.col("x"), F.col("y")).alias("i")).collect()
    assert [(r["x"], r["y"], r["i"]) for r in got] == points


def test_sliding_acceleration_does_not_depend_on_row_order(spark):
    data = pings(spark, [(1, 0, 0.0, 0.0, 4.0, 0.0), (1, 0, 0.0, 0.0, 12.0, 0.0), (1, 30, 0.0, 0.0, 15.0, 0.0)])
    found = [rows(motion.sliding_acceleration(d, ["event_id"]), "acceleration") for d in (data, data.orderBy(F.desc("event_id")).coalesce(1))]
    assert found[0] == found[1] and set(found[0]) == {((15.0 - 4.0) / 30,)}


# --- proximity

@pytest.mark.parametrize("crowded", [1, 3, 1000])
@pytest.mark.parametrize("lat0, lon0", [(0.0, 179.995), (48.0, 10.0), (-89.97, 0.0)])
def test_collision_pairs_match_brute_force(spark, crowded, lat0, lon0):
    rng = random.Random(9)
    spread = 0.05 if abs(lat0) < 80 else 180.0
    data = [(m, m, lat0 + rng.uniform(-0.03, 0.03), (lon0 + rng.uniform(-spread, spread) + 180) % 360 - 180, None, None) for m in range(40)]
    got = proximity.collision_pairs(pings(spark, data), ["event_id"], crowded_cell=crowded)
    want = {
        (a[0], b[0]) for a in data for b in data if a[0] < b[0] and haversine(a[2], a[3], b[2], b[3]) < 1.0
    }
    found = [(r["vessel_1_mmsi"], r["vessel_2_mmsi"]) for r in got.collect()]
    assert set(found) == want and len(found) == len(want) and want


def test_collision_levels_and_minutes(spark):
    data = [
        (1, 0, 0.0, 0.0, 6.0, 90.0), (2, 0, 0.0, 0.4 / 60, 6.0, 270.0),
        (3, 0, 10.0, 0.0, 1.0, 90.0), (4, 0, 10.0, 0.9 / 60, 2.5, 270.0),
        (5, 0, 20.0, 0.0, 0.1, 90.0), (6, 0, 20.0, 0.9 / 60, 0.1, 270.0),
    ]
    got = {r["vessel_1_mmsi"]: r for r in proximity.collision_pairs(pings(spark, data), ["event_id"]).collect()}
    assert (got[1]["risk_level"], round(got[1]["cpa_minutes"], 3)) == ("HIGH", 2.0)
    assert got[3]["risk_level"] == "MEDIUM" and 5 not in got


def risks(spark, data, **options):
    rows = proximity.collision_pairs(pings(spark, data), ["event_id"], **options).collect()
    return {(r["vessel_1_mmsi"], r["vessel_2_mmsi"]): (r["risk_level"], round(r["distance_meters"], 1)) for r in rows}


def test_collisions_across_a_slice_border(spark):
    data = [(1, 599, 0.0, 0.0, 0.0, 0.0), (2, 601, 0.0, 0.06 / 60, 0.0, 0.0)]
    assert risks(spark, data) == {(1, 2): ("HIGH", 111.2)}


def test_positions_of_different_moments_are_not_compared(spark):
    east = 20.0 * 598 / 3600 / 60
    apart = [(1, 0, 0.0, 0.0, 20.0, 90.0), (2, 598, 0.0, 0.06 / 60, 20.0, 90.0)]
    assert risks(spark, apart) == {} and risks(spark, apart, within_seconds=600) == {}
    abreast = [(1, 0, 0.0, 0.0, 20.0, 90.0), (2, 598, 0.0, east + 0.06 / 60, 20.0, 90.0)]
    assert risks(spark, abreast, within_seconds=600)[1, 2][1] == pytest.approx(111.2, abs=1.5)


def test_a_pair_has_its_closest_comparison_per_slice(spark):
    data = [(1, t, 0.0, 0.0, 0.0, 0.0) for t in (0, 60, 120, 700)] + [(2, t, 0.0, lon / 60, 0.0, 0.0) for t, lon in ((5, 0.4), (65, 0.2), (125, 0.3), (705, 0.9))]
    rows = proximity.collision_pairs(pings(spark, data), ["event_id"]).orderBy("slice").collect()
    assert [round(r["distance_meters"] / 1852, 1) for r in rows] == [0.2, 0.9]


def test_port_congestion_levels(spark):
    data = [(m, 0, 29.8, -95.1, 2.0, 0.0) for m in range(15)] + [(m, 0, 32.7, -117.2, 4.0, 0.0) for m in range(100, 105)]
    got = {r["port_id"]: r for r in proximity.port_congestion(pings(spark, data), schemas.ports(spark)).collect()}
    assert [got[p]["congestion_risk"] for p in ("US_HOU", "US_SAN", "EG_PSD")] == ["HIGH", "MEDIUM", "LOW"]
    assert got["EG_PSD"]["active_vessels_count"] == 0 and len(got) == 10


# --- order statistics, clusters, checks

@pytest.mark.parametrize("wild", [[float("inf")], [float("inf"), float("-inf")], [1.7e308, -1.7e308], [float("inf"), 1.7976931348623157e308]])
def test_exact_ranks_with_infinities_and_the_widest_range(spark, wild):
    data = [float(k) for k in range(100)] + wild
    df = spark.createDataFrame([("g", v) for v in data], "g string, v double")
    ranks = {"low": "1", "mid": "50", "top": "n"}
    got = {r["label"]: r["value"] for r in orderstats.exact_ranks(df, ["g"], "v", ranks, bins=4, small_range=3).collect()}
    assert got == {"low": sorted(data)[0], "mid": sorted(data)[49], "top": sorted(data)[-1]}


@pytest.mark.parametrize("bins, small", [(4, 1), (16, 10), (2048, 20_000)])
def test_exact_ranks_with_ties_and_outliers(spark, bins, small):
    rng = random.Random(4)
    data = [("a", v) for v in [1e12, -1e9] + [round(rng.gauss(0, 1), 2) for _ in range(400)] + [0.5] * 200]
    data += [("b", 7.0)] * 50 + [("c", 1.0), ("c", None), ("c", float("nan"))]
    df = spark.createDataFrame(data, "g string, v double")
    ranks = {"p95": "greatest(1, ceil(0.95D * n))", "mid": "ceil(n / 2)", "top": "n"}
    got = {(r["g"], r["label"]): r["value"] for r in orderstats.exact_ranks(df, ["g"], "v", ranks, bins=bins, small_range=small).collect()}
    for g in "abc":
        values = sorted(v for k, v in data if k == g and v is not None and v == v)
        n = len(values)
        import math
        assert got[g, "p95"] == values[max(1, math.ceil(0.95 * n)) - 1]
        assert got[g, "mid"] == values[math.ceil(n / 2) - 1]
        assert got[g, "top"] == values[-1]


def test_quantiles_interpolate_and_histogram_covers_all(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(10)] + [("b", 3.0)], "g string, v double")
    got = {r["g"]: r for r in orderstats.quantiles(df, ["g"], "v", {"q1": 0.25, "median": 0.5}).collect()}
    assert (got["a"]["q1"], got["a"]["median"], got["b"]["q1"]) == (2.25, 4.5, 3.0)
    bins = orderstats.histogram(df, ["g"], "v", 3)
    assert rows(bins) == [("a", 0, 3), ("a", 1, 3), ("a", 2, 4), ("b", 0, 1)]


def blobs(spark):
    rng = random.Random(8)
    data = []
    for i in range(300):
        c = i % 3
        data.append((i % 20, i, 10.0 * c + rng.gauss(0, 0.5), 20.0 * c + rng.gauss(0, 0.5), 10.0 * c + rng.random(), 100.0 * c + rng.random()))
    data += [(50, 0, 95.0, 0.0, 1.0, 1.0), (51, 0, 1.0, 1.0, 101.0, 1.0), (0, 0, 1.0, 1.0, 1.0, 1.0)]
    return pings(spark, data)


def test_clusters_agree_with_the_model(spark):
    features = clustering.feature_rows(blobs(spark), carry=["event_id"]).cache()
    assert features.filter("mmsi <= 0 OR sog_knots > 100 OR lat > 90").count() == 0
    model = clustering.fit(features, k=3)
    centres = clustering.centres_of(model)
    ours = clustering.assign(features, centres)
    theirs = model.transform(features).select("event_id", F.col("cluster_id").alias("model_id"))
    assert ours.join(theirs, "event_id").filter("cluster_id <> model_id").count() == 0
    sizes = rows(ours.groupBy("cluster_id").count(), "count")
    assert len(sizes) == 3 and sum(s[0] for s in sizes) == features.count()
    approx = clustering.thresholds(ours)
    exact = clustering.thresholds(ours, exact=True)
    assert rows(approx, "cluster_id", "threshold_distance") == rows(exact, "cluster_id", "threshold_distance")
    flagged = clustering.flag_anomalies(ours, exact)
    at_limit = flagged.filter("distance_to_centroid = threshold_distance")
    assert at_limit.count() == 3 and at_limit.filter("is_anomaly").count() == 0
    result = clustering.latest_result_rows(flagged, F.lit(T0), ["event_id"])
    assert checks.uniqueness_violations(result, schemas.SERVING_KEYS["vessel_behavior_clusters"]).isEmpty()
    assert result.count() == features.select("mmsi").distinct().count()


def test_heading_is_an_optional_input(spark):
    df = blobs(spark).withColumn("Heading", F.when(F.col("event_id") % 2 == 0, F.col("COG")))
    features = clustering.feature_rows(df, heading=True)
    assert features.filter("heading_degrees IS NULL").count() == 0 and features.count() < clustering.feature_rows(df).count()


def test_least_squares_and_sample(spark):
    cereals = [
        (2, 2, 10.5, 10, 29.509541), (1, 2, 12, 12, 18.042851), (1, 1, 12, 13, 22.736446), (2, 1, 11, 13, 32.207582),
        (1, 2, 12, 11, 21.871292), (2, 1, 16, 8, 36.187559), (6, 2, 17, 1, 50.764999), (3, 2, 13, 7, 40.400208), (3, 3, 13, 4, 45.811716),
    ]
    df = spark.createDataFrame([tuple(map(float, r)) for r in cereals], "a double, b double, c double, d double, y double")
    got = {r["term"]: r["beta"] for r in regression.least_squares(df, ["a", "b", "c", "d"], "y").collect()}
    import numpy as np
    want = np.linalg.lstsq(np.array(cereals)[:, :4], np.array(cereals)[:, 4], rcond=None)[0]
    assert [got[t] for t in "abcd"] == pytest.approx(list(want))
    lines = regression.sample_tsv(df, 1.0).collect()
    assert len(lines) == 9 and lines[0]["line"].count("\t") == 4


def test_checks(spark):
    day = schemas.inline_rows(spark, [("2024-01-01", 1), ("2024-01-01", 1), ("2024-01-02", 2)], ("kpi_date", "k"))
    tables = {"fleet_daily_kpis": day, "vessel_behavior_clusters": day.filter("k = 2")}
    assert checks.verify_day(tables, "2024-01-02") == {"fleet_daily_kpis": 1, "vessel_behavior_clusters": 1}
    with pytest.raises(checks.CheckFailed, match="vessel_behavior_clusters"):
        checks.verify_day(tables, "2024-01-01")
    with pytest.raises(checks.CheckFailed):
        checks.require_rows(day.filter("k = 9"), "x")
    assert rows(checks.uniqueness_violations(day, ["k"])) == [(1, 2)]
    counted, seen = checks.observed(day, "seen")
    counted.collect()
    assert seen.get["rows"] == 3
    assert rows(checks.processing_summary(day, day.filter("k = 2"))) == [(3, 1, 2)]


def test_dedup_is_stable_under_any_order(spark):
    data = [(i % 5, i, float(i)) for i in range(50)]
    for seed in (1, 2):
        random.Random(seed).shuffle(data)
        df = spark.createDataFrame(data, "k int, pos int, v double").repartition(seed * 3)
        assert rows(dedup.first_per_key(df, ["k"], ["pos"]), "k", "pos") == [(k, k) for k in range(5)]
        assert rows(dedup.last_per_key(df, ["k"], ["pos"]), "k", "pos") == [(k, 45 + k) for k in range(5)]


def test_reports_are_not_cut(spark):
    ports = spark.createDataFrame([(f"P{k:02d}", float(k)) for k in range(21)], "port_id string, dwell_minutes double")
    assert serving.dwell_by_port(ports).count() == 21 and serving.dwell_by_port(ports, 5).count() == 5
    clusters = spark.createDataFrame([(k, 1.0, 1.0, False) for k in range(12)], "cluster_id int, sog_knots double, distance_to_centroid double, is_anomaly boolean")
    assert serving.vessels_per_cluster(clusters).count() == 12 and serving.cluster_behaviour(clusters).count() == 12


def test_sampled_lines_hold_whole_rows_of_two_columns(spark, sf_dir):
    lines = {r.line for r in registry.sampled_lines(spark, sf_dir).collect()}
    whole = regression.sample_tsv(spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_quantity", "l_extendedprice"), 1.0)
    assert lines and lines <= {r.line for r in whole.collect()}
