"""Five sinks on the cleaning stream, each a query with its own checkpoint."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidewatch.operators.fleet_state import latest_fleet_state, merge_state
from tidewatch.operators.kpis import ALERT_KNOTS, alert_messages
from tidewatch.sinks.kafka import publish
from tidewatch.sinks.snapshots import SnapshotTable
from tidewatch.sinks.tables import MAX_RECORDS_PER_FILE, read_batches, write_batch
from tidewatch.streaming.cleaning import CleanStreams
from tidewatch.streaming.tasks import few_tasks

SINKS = ("fleet_state", "speed_alerts", "archive", "rejects", "json_rejects")


@dataclass(frozen=True)
class FanOut:
    """Where the five sinks write; with `alert_servers` alerts go to Kafka instead of files."""

    base: str
    threshold_knots: float = ALERT_KNOTS
    alert_servers: str | None = None
    alert_topic: str = "vessel_speed_alerts"

    def path(self, sink: str) -> str:
        return f"{self.base}/{sink}"

    def checkpoint(self, sink: str) -> str:
        return f"{self.base}/_checkpoints/{sink}"


def trigger(live_seconds: int | None = None) -> dict:
    """Drain what is there and stop, or run every few seconds."""
    return {"availableNow": True} if live_seconds is None else {"processingTime": f"{live_seconds} seconds"}


def start_fan_out(streams: CleanStreams, out: FanOut, live_seconds: int | None = None) -> list[StreamingQuery]:
    """Start all five queries; a failure in one leaves the others running."""
    cleaned = few_tasks(streams.cleaned)
    return [
        _start(source, handler, out, sink, live_seconds)
        for sink, source, handler in (
            ("fleet_state", cleaned, state_handler(out)),
            ("speed_alerts", cleaned, alert_handler(out)),
            ("archive", cleaned, table_handler(out.path("archive"), by="date")),
            ("rejects", streams.rejects, table_handler(out.path("rejects"))),
            ("json_rejects", streams.json_rejects, table_handler(out.path("json_rejects"))),
        )
    ]


def start_fused(streams: CleanStreams, out: FanOut, live_seconds: int | None = None) -> list[StreamingQuery]:
    """Read and clean once for the three main sinks; the reject queries stay separate."""
    handlers = (state_handler(out), alert_handler(out), table_handler(out.path("archive"), by="date"))

    def write_all(batch: DataFrame, batch_id: int) -> None:
        with held(batch):
            for handler in handlers:
                handler(batch, batch_id)

    return [
        _start(few_tasks(streams.cleaned), write_all, out, "fused", live_seconds),
        _start(streams.rejects, table_handler(out.path("rejects")), out, "rejects", live_seconds),
        _start(streams.json_rejects, table_handler(out.path("json_rejects")), out, "json_rejects", live_seconds),
    ]


def _start(source: DataFrame, handler: Callable, out: FanOut, sink: str, live_seconds: int | None) -> StreamingQuery:
    return (
        source.writeStream.foreachBatch(handler)
        .queryName(out.path(sink))
        .option("checkpointLocation", out.checkpoint(sink))
        .trigger(**trigger(live_seconds))
        .start()
    )


def state_handler(out: FanOut) -> Callable[[DataFrame, int], None]:
    def upsert(batch: DataFrame, batch_id: int) -> None:
        table = SnapshotTable(batch.sparkSession, out.path("fleet_state"))
        table.update(few_tasks(latest_fleet_state(batch)), batch_id, lambda current, changes: few_tasks(merge_state(current, changes)))

    return upsert


def alert_handler(out: FanOut) -> Callable[[DataFrame, int], None]:
    def alert(batch: DataFrame, batch_id: int) -> None:
        messages = alert_messages(batch, out.threshold_knots)
        if out.alert_servers:
            publish(messages, out.alert_servers, out.alert_topic)
        else:
            write_batch(messages, out.path("speed_alerts"), batch_id)

    return alert


def table_handler(path: str, by: str | None = None, max_records: int = MAX_RECORDS_PER_FILE) -> Callable[[DataFrame, int], None]:
    """Store batches as files of at most `max_records` rows, and no more of them than that takes."""

    def store(batch: DataFrame, batch_id: int) -> None:
        with held(batch):
            files = -(-batch.count() // max_records)
            if files:
                write_batch(batch.repartition(files), path, batch_id, by, max_records)

    return store


@contextmanager
def held(batch: DataFrame) -> Iterator[None]:
    """Keep a batch while several passes read it, unless someone else keeps it already."""
    mine = not (batch.storageLevel.useMemory or batch.storageLevel.useDisk)
    if mine:
        batch.persist()
    try:
        yield
    finally:
        if mine:
            batch.unpersist()


def await_all(queries: list[StreamingQuery]) -> None:
    for query in queries:
        query.awaitTermination()


def read_sink(spark: SparkSession, out: FanOut, sink: str, empty: DataFrame) -> DataFrame:
    """What a sink holds; `empty` where it never got a row."""
    if sink == "fleet_state":
        found = SnapshotTable(spark, out.path(sink)).read()
        return empty if found is None else found
    found = read_batches(spark, out.path(sink))
    return empty if found is None else found


