"""Windowed and running aggregates over streams; each also works on a bounded table."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidewatch.functions.geo import valid_position
from tidewatch.operators.dedup import last_per_key
from tidewatch.operators.dwell import (
    DAY_KEYS, GAP_SECONDS, dwell_minutes, merge_slices, port_visits, session_slices, sessions_from_slices,
)
from tidewatch.operators.lookup import join_lookup
from tidewatch.operators.motion import acceleration_of_steps, speed_steps
from tidewatch.operators.proximity import WITHIN_SECONDS, closest_per_slice, collision_pairs
from tidewatch.operators.zones import geofence_events
from tidewatch.session import materialize
from tidewatch.sinks.snapshots import SnapshotTable
from tidewatch.sinks.tables import read_batches, write_batch
from tidewatch.streaming.tasks import few_tasks


def tumbling_counts(rows: DataFrame, ts: str, key: str, width: str = "5 seconds", watermark: str | None = None) -> DataFrame:
    """Rows per key and tumbling window."""
    source = rows.withWatermark(ts, watermark) if watermark else rows
    return (
        source.groupBy(F.window(ts, width).alias("_w"), key)
        .agg(F.count(F.lit(1)).alias("pv"))
        .select(F.col("_w.start").alias("start_time"), key, "pv")
    )


def running_counts(rows: DataFrame, key: str, name: str = "pv") -> DataFrame:
    """Rows per key so far; on a stream for complete or update output."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def running_total(rows: DataFrame, ts: str) -> DataFrame:
    """Newest time and number of rows so far."""
    return rows.agg(F.max(ts).alias("max_time"), F.count(F.lit(1)).alias("total"))


def word_count(rows: DataFrame, text: str) -> DataFrame:
    """Occurrences of each word, words being separated by white space."""
    return (
        rows.select(F.explode(F.split(F.col(text), r"\s")).alias("word"))
        .filter(F.col("word") != "")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("word_count"))
    )


def live_dwell(pings: DataFrame, ports: DataFrame, watermark: str = "10 minutes", gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """Port visits that have ended, as a session-window stream (append output)."""
    second = F.timestamp_seconds(F.unix_seconds(F.col("BaseDateTime")))
    visits = port_visits(pings, ports).withColumn("_second", second).withWatermark("_second", watermark)
    return (
        visits.groupBy("mmsi", "port_id", F.session_window("_second", f"{gap_seconds} seconds").alias("_w"))
        .agg(F.min("BaseDateTime").alias("entry_ts"), F.max("BaseDateTime").alias("exit_ts"), F.count(F.lit(1)).alias("ping_count"))
        .select("mmsi", "port_id", "entry_ts", "exit_ts", "ping_count", dwell_minutes(F.col("entry_ts"), F.col("exit_ts")).alias("dwell_minutes"))
    )


class IncrementalDwell:
    """Port visits kept up to date batch by batch, late pings included.

    Each batch stores only its (vessel, port, slice) partials; sessions are cut from the merged partials
    when they are read, so no state grows with the stream and no order of arrival is assumed.
    """

    RESULT = "kpi_date date, mmsi long, port_id string, session_id long, entry_ts timestamp, exit_ts timestamp, ping_count long, dwell_minutes double"

    def __init__(self, base: str, ports: DataFrame, gap_seconds: int = GAP_SECONDS):
        self.base = base
        self.ports = ports
        self.gap_seconds = gap_seconds

    def add(self, batch: DataFrame, batch_id: int) -> None:
        visits = port_visits(batch, self.ports)
        write_batch(session_slices(visits, DAY_KEYS, "BaseDateTime", self.gap_seconds), self.base, batch_id)

    def read(self, spark: SparkSession) -> DataFrame:
        stored = read_batches(spark, self.base)
        if stored is None:
            return spark.createDataFrame([], self.RESULT)
        slices = merge_slices(stored, DAY_KEYS)
        found = sessions_from_slices(slices, DAY_KEYS, self.gap_seconds)
        return found.withColumn("dwell_minutes", dwell_minutes(F.col("entry_ts"), F.col("exit_ts")))


class IncrementalAcceleration:
    """Sliding accelerations kept up to date batch by batch, late pings included.

    Each batch stores its (vessel, step) partials; windows are cut from all partials when they are read, so no state grows with
    the stream and no order of arrival is assumed. A repeated batch replaces itself.
    """

    RESULT = "mmsi long, window_start timestamp, ping_count long, acceleration double"

    def __init__(self, base: str, tiebreak: list[str]):
        self.base = base
        self.tiebreak = tiebreak

    def add(self, batch: DataFrame, batch_id: int) -> None:
        write_batch(speed_steps(batch, self.tiebreak), self.base, batch_id)

    def read(self, spark: SparkSession) -> DataFrame:
        stored = read_batches(spark, self.base)
        return spark.createDataFrame([], self.RESULT) if stored is None else acceleration_of_steps(stored.drop("batch_id"))


class LiveCollisions:
    """Collision risks batch by batch, equal to the batch operator for pings up to `lateness` out of order.

    Between batches a table of positions holds the pings that one still to come can meet: those not older than the tolerance of a
    comparison plus `lateness`, counted from the newest ping. Every batch is compared with itself and with them, they are not compared
    with each other again, and the batch stores the closest approach of each pair and slice it found; `read` keeps the closest of all
    batches. A repeated batch replaces itself.
    """

    RESULT = (
        "slice long, vessel_1_mmsi long, vessel_2_mmsi long, distance_meters double, cpa_minutes double, risk_level string, "
        "mid_lat double, mid_lon double, created_at timestamp"
    )

    def __init__(self, spark: SparkSession, base: str, tiebreak: list[str], lateness: str = "10 minutes", within_seconds: int = WITHIN_SECONDS):
        self.spark = spark
        self.risks = f"{base}/risks"
        self.positions = SnapshotTable(spark, f"{base}/positions")
        self.tiebreak = tiebreak
        self.lateness = lateness
        self.within_seconds = within_seconds

    def add(self, batch: DataFrame, batch_id: int) -> None:
        columns = ["MMSI", "BaseDateTime", *self.tiebreak, "LAT", "LON", "SOG", "COG"]
        located = batch.select(*columns).filter(valid_position(F.col("LAT"), F.col("LON")) & F.col("BaseDateTime").isNotNull())
        located = materialize(located, "located")
        held = self.positions.read(before=batch_id)
        track = located if held is None else held.unionByName(located)
        write_batch(collision_pairs(located, self.tiebreak, within_seconds=self.within_seconds, known=held), self.risks, batch_id)
        reach = F.expr(f"INTERVAL {self.lateness}") + F.make_dt_interval(secs=F.lit(self.within_seconds))
        newest = track.agg(F.max("BaseDateTime") - reach).first()[0]
        self.positions.replace(track.filter(F.col("BaseDateTime") >= F.lit(newest)), batch_id)

    def read(self) -> DataFrame:
        stored = read_batches(self.spark, self.risks)
        if stored is None:
            return self.spark.createDataFrame([], self.RESULT)
        # A batch holds each pair of a slice once: only slices of several batches have anything to choose from.
        batches = stored.groupBy("slice").agg(F.min("batch_id").alias("_first"), F.max("batch_id").alias("_last"))
        shared = batches.filter("_first < _last").select("slice", F.lit(True).alias("_shared"))
        marked = join_lookup(stored.drop("batch_id"), shared, ["slice"], "left")
        alone, several = marked.filter("_shared IS NULL").drop("_shared"), marked.filter("_shared").drop("_shared")
        return alone.unionByName(closest_per_slice(several))


class LiveGeofence:
    """Geofence events batch by batch, equal to the batch operator for pings up to `lateness` out of order.

    Between batches the table of positions holds every ping that is not `lateness` older than the newest one, and the
    newest older ping of each vessel. An event is written when its ping falls out of that window, so later arrivals
    inside it still take their place; `finish` writes the rest. A ping behind the last written one of its
    vessel comes too late and is left out.
    """

    def __init__(self, spark: SparkSession, base: str, zones: DataFrame, tiebreak: list[str], lateness: str = "10 minutes"):
        self.spark = spark
        self.events = f"{base}/events"
        self.positions = SnapshotTable(spark, f"{base}/positions")
        self.zones = zones
        self.tiebreak = tiebreak
        self.lateness = lateness

    def add(self, batch: DataFrame, batch_id: int) -> None:
        columns = ["MMSI", "BaseDateTime", *self.tiebreak, "LAT", "LON"]
        located = batch.select(*columns).filter(valid_position(F.col("LAT"), F.col("LON")))
        self._advance(located.withColumn("settled", F.lit(False)), batch_id, self.lateness)

    def finish(self, batch_id: int) -> None:
        """Write the events of all pings held back, as batch `batch_id`."""
        known = self.positions.read(before=batch_id)
        if known is not None:
            self._advance(known.limit(0), batch_id, "0 seconds")

    def _advance(self, located: DataFrame, batch_id: int, lateness: str) -> None:
        when = F.struct("BaseDateTime", *self.tiebreak)
        known = self.positions.read(before=batch_id)
        if known is not None:
            last = known.filter("settled").select(F.col("MMSI").alias("_vessel"), when.alias("_last"))
            fresh = located.join(last, F.col("MMSI") == F.col("_vessel"), "left").filter(F.col("_last").isNull() | (when > F.col("_last")))
            located = known.unionByName(fresh.drop("_vessel", "_last"))
        track = materialize(located, "track")
        newest = track.agg(F.max("BaseDateTime") - F.expr(f"INTERVAL {lateness}")).first()[0]
        due = F.col("BaseDateTime") <= F.lit(newest)
        found = geofence_events(track.drop("settled"), self.zones, self.tiebreak)
        settled = track.filter("settled").select(F.col("MMSI").alias("mmsi"), F.col("BaseDateTime").alias("event_time"), *self.tiebreak)
        written = found.filter(F.col("event_time") <= F.lit(newest)).join(settled, ["mmsi", "event_time", *self.tiebreak], "left_anti")
        write_batch(written, self.events, batch_id)
        ends = last_per_key(track.filter(due), ["MMSI"], ["BaseDateTime", *self.tiebreak]).withColumn("settled", F.lit(True))
        self.positions.replace(track.filter(~due).unionByName(ends), batch_id)


class LateRows(StreamingQueryListener):
    """Rows that queries have dropped because they lay behind the watermark, added up batch by batch and reported."""

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        self.dropped.setdefault(event.name or str(event.id), 0)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        late = sum(state.numRowsDroppedByWatermark for state in progress.stateOperators)
        name = progress.name or str(progress.id)
        self.dropped[name] = self.dropped.get(name, 0) + late
        if late:
            logging.getLogger(__name__).warning("%s: %d late rows in batch %d, %d so far", name, late, progress.batchId, self.dropped[name])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def drain_append(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream over what its source holds into Parquet files, and read them back."""
    query = (
        few_tasks(stream).writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def drain_complete(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run an aggregating stream over what its source holds; returns its newest full result."""
    table = SnapshotTable(stream.sparkSession, path)
    query = (
        few_tasks(stream).writeStream.outputMode("complete").foreachBatch(table.replace)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    found = table.read()
    return stream.sparkSession.createDataFrame([], stream.schema) if found is None else found


def drain_batches(stream: DataFrame, handler, checkpoint: str) -> None:
    """Run a stream over what its source holds through a batch handler."""
    query = (
        stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


