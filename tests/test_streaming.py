import datetime as dt
import json
import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidewatch import registry, schemas
from tidewatch import surrogates as src
from tidewatch.functions import geo
from tidewatch.operators import cleaning, dwell, fleet_state, motion, proximity, zones
from tidewatch.sinks.snapshots import SnapshotTable
from tidewatch.sinks.tables import write_batch
from tidewatch.sources import pings as sources
from tidewatch.streaming import cleaning as stream_cleaning
from tidewatch.streaming import fanout, tasks, windows

T0 = dt.datetime(2024, 12, 25)


def ping(mmsi, minutes, sog="10", **more):
    at = T0 + dt.timedelta(minutes=minutes)
    return json.dumps({
        "MMSI": mmsi, "BaseDateTime": at.strftime("%Y-%m-%dT%H:%M:%S"), "LAT": "29.8", "LON": "-95.1", "SOG": sog, **more
    })


def write_messages(spark, path, *batches):
    """One message file per batch, oldest first."""
    offset = 0
    for i, bodies in enumerate(batches):
        data = []
        for body in bodies:
            data.append((None, body.encode(), 0, offset, T0))
            offset += 1
        spark.createDataFrame(data, schemas.ENVELOPE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/part{i}")
    return f"{path}/part*"


A, B = "111111111", "222222222"
BATCHES = (
    [ping(A, 0), ping(A, 0, sog="11"), ping(B, 1, sog="25"), '{"MMSI":', ping("12", 0), ping(A, 0, LAT="95")],
    [ping(A, 5, sog="21"), ping(B, 1, sog="25"), ping(A, 3), ping(A, 5, BaseDateTime="bad")],
    [ping(A, 60, LAT=None), ping(B, 30, sog="1")],
)


def run_fan_out(spark, tmp_path, fused):
    stream = sources.replay_stream(spark, write_messages(spark, str(tmp_path / "in"), *BATCHES))
    out = fanout.FanOut(str(tmp_path / "out"))
    start = fanout.start_fused if fused else fanout.start_fan_out
    fanout.await_all(start(stream_cleaning.clean_streams(stream), out))
    return out


@pytest.mark.parametrize("fused", [False, True])
def test_fan_out_equals_batch_cleaning(spark, tmp_path, fused):
    out = run_fan_out(spark, tmp_path, fused)
    everything = sources.replay_batch(spark, str(tmp_path / "in" / "part*"))
    cleaned, rejected = cleaning.clean(cleaning.parse_json(cleaning.kafka_columns(everything)), cleaning.STREAM)
    archive = fanout.read_sink(spark, out, "archive", cleaned.limit(0))
    keys = ("MMSI", "BaseDateTime")
    assert rows(archive, *keys) == rows(cleaned, *keys) and archive.count() == 5
    assert set(cleaned.columns) <= set(archive.columns)
    assert rows(fanout.read_sink(spark, out, "rejects", rejected), "reject_reason", "kafka_offset") == rows(rejected, "reject_reason", "kafka_offset")
    assert fanout.read_sink(spark, out, "json_rejects", rejected).count() == 1
    alerts = [json.loads(r["value"]) for r in fanout.read_sink(spark, out, "speed_alerts", rejected).collect()]
    assert sorted((a["mmsi"], a["sog_knots"]) for a in alerts) == [(int(A), 21.0), (int(B), 25.0)]
    state = fanout.read_sink(spark, out, "fleet_state", cleaned)
    want = fleet_state.latest_fleet_state(cleaned)
    assert rows(state, "mmsi", "base_date_time", "sog_knots") == rows(want, "mmsi", "base_date_time", "sog_knots")


def test_fan_out_resumes_from_its_checkpoints(spark, tmp_path):
    out = run_fan_out(spark, tmp_path, fused=False)
    stream = sources.replay_stream(spark, str(tmp_path / "in" / "part*"))
    before = spark.read.parquet(out.path("archive")).count()
    fanout.await_all(fanout.start_fan_out(stream_cleaning.clean_streams(stream), out))
    assert spark.read.parquet(out.path("archive")).count() == before


def test_late_rows_are_dropped_and_duplicates_across_batches(spark, tmp_path):
    path = write_messages(
        spark, str(tmp_path / "in"), [ping(A, 0)], [ping(A, 0), ping(A, 60)], [ping(A, 61)], [ping(A, 30), ping(A, 62)], [ping(A, 55)]
    )
    cleaned = stream_cleaning.clean_streams(sources.replay_stream(spark, path)).cleaned
    got = windows.drain_append(cleaned.select("BaseDateTime"), str(tmp_path / "rows"), str(tmp_path / "cp"))
    minutes = [(r["BaseDateTime"] - T0).seconds // 60 for r in got.orderBy("BaseDateTime").collect()]
    assert minutes == [0, 55, 60, 61, 62]


def test_repeated_batch_replaces_itself(spark, tmp_path):
    base = str(tmp_path / "t")
    first = schemas.inline_rows(spark, [("2024-01-01", 1), ("2024-01-02", 2)], ("date", "v"))
    write_batch(first, base, 0, "date")
    write_batch(schemas.inline_rows(spark, [("2024-01-01", 3)], ("date", "v")), base, 1, "date")
    write_batch(first, base, 0, "date")
    assert rows(spark.read.parquet(base), "v", "batch_id") == [(1, 0), (2, 0), (3, 1)]


def test_snapshots_survive_retries_and_drop_old_ones(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "s"))
    add = lambda current, new: current.unionByName(new)
    one = schemas.inline_rows(spark, [(1,)], ("v",))
    for batch in (0, 1, 1, 2, 2, 3):
        table.update(one, batch, add)
    assert table.read().count() == 4 and table.batches() == [2, 3]
    assert SnapshotTable(spark, str(tmp_path / "none")).read() is None


def test_older_ping_in_a_later_batch_does_not_win(spark, tmp_path):
    path = write_messages(spark, str(tmp_path / "in"), [ping(A, 9, sog="9")], [ping(A, 5, sog="5")])
    out = fanout.FanOut(str(tmp_path / "out"))
    streams = stream_cleaning.clean_streams(sources.replay_stream(spark, path))
    fanout.await_all(fanout.start_fan_out(streams, out))
    assert rows(SnapshotTable(spark, out.path("fleet_state")).read(), "sog_knots") == [(9.0,)]


def visits(spark, *minutes):
    return spark.createDataFrame(
        [(1, T0 + dt.timedelta(minutes=m), 29.8, -95.1) for m in minutes], "MMSI long, BaseDateTime timestamp, LAT double, LON double"
    )


def test_session_window_stream_equals_batch_sessions(spark, tmp_path):
    minutes = (0, 50, 170, 291, 300, 600)
    for i in range(0, 6, 2):
        visits(spark, *minutes[i:i + 2]).coalesce(1).write.parquet(str(tmp_path / f"in/p{i}"))
    visits(spark, 2000).coalesce(1).write.parquet(str(tmp_path / "in/p8"))
    stream = spark.readStream.schema(visits(spark, 0).schema).option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in/p*"))
    ended = windows.drain_append(windows.live_dwell(stream, schemas.ports(spark)), str(tmp_path / "rows"), str(tmp_path / "cp"))
    batch = dwell.port_dwell_sessions(visits(spark, *minutes), schemas.ports(spark), split_days=False)
    columns = ("mmsi", "port_id", "entry_ts", "exit_ts", "ping_count", "dwell_minutes")
    assert rows(ended, *columns) == rows(batch, *columns) and batch.count() == 3


def test_incremental_dwell_takes_late_pings_in_any_order(spark, tmp_path):
    minutes = (0, 50, 170, 291, 300, 600)
    found = windows.IncrementalDwell(str(tmp_path / "p"), schemas.ports(spark))
    for batch_id, part in enumerate(((300, 0), (600, 50, 291), (170,))):
        found.add(visits(spark, *part), batch_id)
    found.add(visits(spark, 600, 50, 291), 1)
    columns = ("mmsi", "port_id", "entry_ts", "exit_ts", "ping_count")
    want = dwell.port_dwell_sessions(visits(spark, *minutes), schemas.ports(spark))
    assert rows(found.read(spark), *columns) == rows(want, *columns)


def test_live_geofence_equals_batch_across_batches_and_retries(spark, tmp_path):
    track = [(31.0, 32.0), (31.25, 32.30), (31.26, 32.31), (31.0, 32.0), (31.25, 32.3), (30.0, 32.55), (31.3, 32.3)]
    data = [(i, 1 + i % 2, T0 + dt.timedelta(minutes=i // 2), la, lo) for i, (la, lo) in enumerate(p for p in track for _ in (0, 1))]
    pings_ = spark.createDataFrame(data, "event_id long, MMSI long, BaseDateTime timestamp, LAT double, LON double")
    live = windows.LiveGeofence(spark, str(tmp_path / "g"), schemas.zones(spark), ["event_id"])
    for batch_id, (lo, hi) in enumerate(((0, 5), (5, 6), (6, 11), (11, 14))):
        part = pings_.filter(F.col("event_id").between(lo, hi - 1))
        live.add(part, batch_id)
        live.add(part, batch_id)
    live.finish(99)
    columns = ("mmsi", "zone_id", "event_type", "event_time", "event_id")
    want = zones.geofence_events(pings_, schemas.zones(spark), ["event_id"])
    assert rows(spark.read.parquet(live.events), *columns) == rows(want, *columns) and want.count() == 14


def test_live_geofence_puts_late_pings_in_their_place(spark, tmp_path):
    inside, outside = (31.25, 32.30), (31.0, 32.0)
    data = [(k, 1, T0 + dt.timedelta(minutes=m), *spot) for k, (m, spot) in enumerate([(0, outside), (10, inside), (5, inside), (20, outside), (1, inside)])]
    schema = "event_id long, MMSI long, BaseDateTime timestamp, LAT double, LON double"
    live = windows.LiveGeofence(spark, str(tmp_path / "g"), schemas.zones(spark), ["event_id"])
    for batch_id, part in enumerate((data[:2], data[2:4], data[4:])):
        live.add(spark.createDataFrame(part, schema), batch_id)
    live.finish(99)
    columns = ("mmsi", "zone_id", "event_type", "event_time", "event_id")
    want = zones.geofence_events(spark.createDataFrame(data[:4], schema), schemas.zones(spark), ["event_id"])
    assert rows(spark.read.parquet(live.events), *columns) == rows(want, *columns)
    assert [r[2] for r in sorted(rows(want, *columns), key=lambda r: r[3])] == ["ENTER", "INSIDE", "EXIT"]


MOVING = "event_id long, MMSI long, BaseDateTime timestamp, LAT double, LON double, SOG double, COG double"


def traffic(seed, n, spread=0.03):
    """Pings of eight vessels near one spot, in the order of their arrival: up to nine minutes after their time."""
    rng = random.Random(seed)
    data = []
    for k in range(n):
        seconds = rng.randrange(0, 5400)
        place = (29.8 + rng.uniform(-spread, spread), -95.1 + rng.uniform(-spread, spread))
        data.append((seconds + rng.randrange(0, 540), (k, rng.randrange(1, 9), T0 + dt.timedelta(seconds=seconds), *place, rng.uniform(0, 20), rng.uniform(0, 359))))
    return [row for _, row in sorted(data)]


def parts_of(data, borders):
    return [data[a:b] for a, b in zip([0, *borders], [*borders, len(data)], strict=True)]


@pytest.mark.parametrize("borders", [[], [1], [40, 41, 120], [25, 50, 75, 100, 125, 150]])
def test_live_collisions_equal_batch_across_batches_and_retries(spark, tmp_path, borders):
    data = traffic(len(borders), 180)
    live = windows.LiveCollisions(spark, str(tmp_path / "c"), ["event_id"])
    for batch_id, part in enumerate(parts_of(data, borders)):
        frame = spark.createDataFrame(part, MOVING)
        live.add(frame, batch_id)
        if batch_id % 2:
            live.add(frame, batch_id)
    want = proximity.collision_pairs(spark.createDataFrame(data, MOVING), ["event_id"])
    assert rows(live.read(), *want.columns) == rows(want, *want.columns) and want.count() > 20


def test_known_pings_meet_only_new_ones(spark):
    data = traffic(5, 180)
    first, second, whole = (spark.createDataFrame(part, MOVING) for part in (data[:110], data[110:], data))
    found = [proximity.collision_pairs(first, ["event_id"]), proximity.collision_pairs(second, ["event_id"], known=first, crowded_cell=3)]
    old, new = (spark.createDataFrame(part.collect(), part.schema) for part in found)
    want = proximity.collision_pairs(whole, ["event_id"])
    assert rows(proximity.closest_per_slice(old.union(new)), *want.columns) == rows(want, *want.columns)
    assert not old.isEmpty() and not new.isEmpty()


def test_live_collisions_keep_only_what_can_still_meet(spark, tmp_path):
    live = windows.LiveCollisions(spark, str(tmp_path / "c"), ["event_id"], lateness="1 minute")
    spot = (29.8, -95.1, 5.0, 10.0)
    for batch_id, minutes in enumerate((0, 3, 5, 30)):
        live.add(spark.createDataFrame([(batch_id, batch_id + 1, T0 + dt.timedelta(minutes=minutes), *spot)], MOVING), batch_id)
    assert [r["event_id"] for r in live.positions.read().collect()] == [3]
    assert sorted((r["vessel_1_mmsi"], r["vessel_2_mmsi"]) for r in live.read().collect()) == [(1, 2), (2, 3)]
    empty = windows.LiveCollisions(spark, str(tmp_path / "e"), ["event_id"])
    empty.add(spark.createDataFrame([], MOVING), 0)
    empty.add(spark.createDataFrame([(0, 1, T0, *spot), (1, 2, T0, None, None, None, None), (2, 3, None, *spot)], MOVING), 1)
    assert empty.positions.read().count() == 1


def test_pings_stand_only_in_cells_that_their_way_comes_near(spark, monkeypatch):
    data = [(k, k, T0 + dt.timedelta(seconds=k), 0.05, 0.0, 10.0, 45.0) for k in range(40)]
    copies, dealt_out = [], proximity._dealt_out

    def counted(left, right, crowds, cell):
        copies.append(right.count())
        return dealt_out(left, right, crowds, cell)

    monkeypatch.setattr(proximity, "_dealt_out", counted)
    assert proximity.collision_pairs(spark.createDataFrame(data, MOVING), ["event_id"]).count() == 40 * 39 // 2
    assert copies == [2 * len(data)]


@pytest.mark.parametrize("lat, lon", [(29.8, -95.1), (0.0, 179.98), (84.9, -179.9), (89.95, 10.0), (-60.0, 0.0)])
def test_collisions_across_cells_equal_all_comparisons(spark, lat, lon):
    rng = random.Random(3)
    data = []
    for k in range(160):
        place = (min(90.0, lat + rng.uniform(-0.1, 0.1)), (lon + rng.uniform(-0.1, 0.1) + 180.0) % 360.0 - 180.0)
        data.append((k, k, T0 + dt.timedelta(seconds=rng.randrange(0, 900)), *place, rng.choice([None, rng.uniform(0, 102)]), rng.uniform(0, 359)))
    frame = spark.createDataFrame(data, MOVING)
    spots = frame.select(F.struct(*frame.columns).alias("p"))
    hours = (F.unix_micros("a.BaseDateTime") - F.unix_micros("b.BaseDateTime")) / 3.6e9
    b = geo.moved(F.col("b"), hours)
    near = geo.haversine_nm(F.col("a.LAT"), F.col("a.LON"), b["LAT"], b["LON"]) < 1.0
    later = F.struct("a.BaseDateTime", "a.MMSI") > F.struct("b.BaseDateTime", "b.MMSI")
    met = spots.select(F.col("p").alias("a")).crossJoin(spots.select(F.col("p").alias("b"))).filter(later & (hours <= 0.05) & near)
    want = {(min(r), max(r)) for r in met.select("a.MMSI", "b.MMSI").collect()}
    found = proximity.collision_pairs(frame, ["event_id"], medium_minutes=1e9)
    assert {(r["vessel_1_mmsi"], r["vessel_2_mmsi"]) for r in found.collect()} == want and len(want) > 20


def test_only_slices_of_several_batches_are_settled_when_read(spark, tmp_path, monkeypatch):
    live = windows.LiveCollisions(spark, str(tmp_path / "c"), ["event_id"])
    data = sorted(traffic(2, 180), key=lambda row: row[2])
    for batch_id, part in enumerate(parts_of(data, [90])):
        live.add(spark.createDataFrame(part, MOVING), batch_id)
    settled, closest = [], windows.closest_per_slice
    monkeypatch.setattr(windows, "closest_per_slice", lambda rated: settled.append({r["slice"] for r in rated.select("slice").collect()}) or closest(rated))
    got = live.read()
    stored = {r["slice"] for r in spark.read.parquet(live.risks).select("slice").collect()}
    assert len(stored) > 5 and len(settled[0]) <= 1
    want = proximity.collision_pairs(spark.createDataFrame(data, MOVING), ["event_id"])
    assert rows(got, *want.columns) == rows(want, *want.columns)


@pytest.mark.parametrize("borders", [[], [60], [20, 21, 100]])
def test_incremental_acceleration_equals_batch(spark, tmp_path, borders):
    data = traffic(9, 160)
    data += [(1000 + k, 1, T0 + dt.timedelta(minutes=7), 29.8, -95.1, float(k), 0.0) for k in range(4)]
    random.Random(1).shuffle(data)
    live = windows.IncrementalAcceleration(str(tmp_path / "a"), ["event_id"])
    for batch_id, part in enumerate(parts_of(data, borders)):
        live.add(spark.createDataFrame(part, MOVING), batch_id)
        live.add(spark.createDataFrame(part, MOVING), batch_id)
    want = motion.sliding_acceleration(spark.createDataFrame(data, MOVING), ["event_id"])
    assert rows(live.read(spark), *want.columns) == rows(want, *want.columns) and want.count() > 50


def test_live_results_without_rows_have_their_schema(spark, tmp_path, sf_dir):
    data, none = spark.createDataFrame(traffic(1, 40), MOVING), spark.createDataFrame([], MOVING)
    for name, make, read in (
        ("c", lambda p: windows.LiveCollisions(spark, p, ["event_id"]), lambda live: live.read()),
        ("a", lambda p: windows.IncrementalAcceleration(p, ["event_id"]), lambda live: live.read(spark)),
        ("d", lambda p: windows.IncrementalDwell(p, schemas.ports(spark)), lambda live: live.read(spark)),
    ):
        full, empty, unused = (make(str(tmp_path / f"{name}{k}")) for k in range(3))
        full.add(data, 0)
        empty.add(none, 0)
        assert read(full).count() > 0
        for live in (empty, unused):
            assert read(live).count() == 0 and read(live).dtypes == read(full).dtypes


def test_late_rows_are_counted(spark, tmp_path):
    path = write_messages(spark, str(tmp_path / "in"), [ping(A, 60)], [ping(A, 61)], [ping(A, 30), ping(A, 62)], [ping(A, 5)])
    cleaned = stream_cleaning.clean_streams(sources.replay_stream(spark, path)).cleaned
    late = windows.LateRows()
    spark.streams.addListener(late)
    try:
        query = (
            cleaned.writeStream.format("parquet").option("path", str(tmp_path / "rows")).queryName("late_rows")
            .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
    finally:
        spark.streams.removeListener(late)
    assert late.dropped["late_rows"] == 2


def test_tumbling_stream_in_append_mode_closes_windows(spark, tmp_path, sf_dir):
    stream = windows.tumbling_counts(src.event_stream(spark, sf_dir), "ts", "event_type", "1 hour", watermark="10 minutes")
    got = windows.drain_append(stream, str(tmp_path / "rows"), str(tmp_path / "cp"))
    want = windows.tumbling_counts(src.table(spark, sf_dir, "events"), "ts", "event_type", "1 hour")
    missing = want.count() - got.count()
    assert 0 <= missing <= 5
    assert set(rows(got)) <= set(rows(want.withColumn("start_time", F.col("start_time").cast("timestamp"))))


def test_running_word_count_stream(spark, tmp_path):
    spark.createDataFrame([("hello world",), ("hello flink",), ("hello hadoop",)], "text string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("text string").parquet(str(tmp_path / "in"))
    got = windows.drain_complete(windows.word_count(stream, "text"), str(tmp_path / "rows"), str(tmp_path / "cp"))
    assert dict(rows(got)) == {"hello": 3, "world": 1, "flink": 1, "hadoop": 1}


def test_batches_are_stored_in_few_files(spark, tmp_path):
    store = fanout.table_handler(str(tmp_path / "t"), max_records=40)
    store(spark.range(100).repartition(16), 0)
    store(spark.range(0), 1)
    assert len(list((tmp_path / "t").glob("batch_id=0/*.parquet"))) == 3
    assert spark.read.parquet(str(tmp_path / "t")).count() == 100


def test_state_partitions_do_not_multiply_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tasks, "MIN_TASKS", 4)
    path = write_messages(spark, str(tmp_path / "in"), [ping(A, k) for k in range(30)])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        streams = stream_cleaning.clean_streams(sources.replay_stream(spark, path))
        out = fanout.FanOut(str(tmp_path / "out"))
        parts = []
        state = fanout.state_handler(out)
        monkeypatch.setattr(fanout, "state_handler", lambda out: lambda batch, n: (parts.append(batch.rdd.getNumPartitions()), state(batch, n)))
        fanout.await_all(fanout.start_fan_out(streams, out))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert parts and max(parts) <= max(4, spark.sparkContext.defaultParallelism)
    assert fanout.read_sink(spark, out, "fleet_state", spark.range(0)).count() == 1


def test_triggers():
    assert fanout.trigger() == {"availableNow": True}
    assert fanout.trigger(2) == {"processingTime": "2 seconds"}


def test_registered_stream_queries_run(spark, sf_dir):
    got = {r["sink"]: r["row_count"] for r in registry.stream_fanout(spark, sf_dir).collect()}
    assert set(got) == set(fanout.SINKS) and all(got.values())
