"""The jobs users submit: historical cleaning, daily KPIs, clustering, live cleaning, CSV replay."""

from __future__ import annotations

import argparse
import datetime as dt
import json
import logging
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch import schemas
from tidewatch.operators import checks, cleaning, clustering, dwell, kpis
from tidewatch.plans.serving import cluster_summary
from tidewatch.session import drop_scratch, materialize
from tidewatch.sinks import tables
from tidewatch.sinks.kafka import publish
from tidewatch.sources import files, pings, reference
from tidewatch.streaming.cleaning import clean_streams
from tidewatch.streaming.fanout import FanOut, await_all, start_fan_out, start_fused
from tidewatch.streaming.windows import LateRows

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def clean_history(messages: DataFrame, out: str, rejects_out: str | None = None) -> None:
    """Batch-clean a bounded set of messages into the archive, one directory per date."""
    parsed = cleaning.parse_json(messages)
    # with rejects there are two results: the messages are parsed once for both
    cleaned, rejected = cleaning.clean(materialize(parsed, "parsed") if rejects_out else parsed, cleaning.BATCH)
    tables.overwrite_by_date(cleaned, out, "date")
    if rejects_out:
        rejected.write.mode("overwrite").parquet(rejects_out)


def clean_csv_legacy(spark: SparkSession, path: str, out: str, run_date: str) -> None:
    tables.overwrite_by_date(cleaning.clean_legacy(files.read_legacy_csv(spark, path), run_date), out, "run_date")


def daily_kpis(
    spark: SparkSession,
    archive: str,
    out: str,
    day: str,
    ports: DataFrame | None = None,
    *,
    default_radius_nm: float = 3.0,
    grid_cell_deg: float = 0.05,
    threshold_knots: float = kpis.ALERT_KNOTS,
) -> dict[str, int]:
    """Compute the four KPI tables of one day and replace that day in each; returns rows written.

    The day is scanned once and kept for the four outputs; row counts come from the written files.
    """
    day_pings = checks.require_rows(files.read_day(spark, archive, day), f"{archive} for {day}").select(
        "MMSI", "BaseDateTime", "LAT", "LON", "SOG", "VesselName", "VesselType", "Status"
    )
    day_pings.persist(StorageLevel.MEMORY_AND_DISK)
    ports = schemas.ports(spark) if ports is None else ports
    try:
        results = {
            "port_dwell_times": dwell.port_dwell_times(day_pings, ports, default_radius_nm=default_radius_nm),
            "fleet_daily_kpis": kpis.fleet_daily_kpis(day_pings),
            "route_density_grid": kpis.route_density_grid(day_pings, grid_cell_deg),
            "vessel_speed_alerts": kpis.speed_alerts(day_pings, threshold_knots).withColumn(
                "kpi_date", F.to_date("detected_at")
            ),
        }
        written = {}
        for name, rows in results.items():
            tables.replace_day(rows, f"{out}/{name}", day)
            written[name] = files.read_all(spark, f"{out}/{name}/kpi_date={day}").count()
        return written
    finally:
        day_pings.unpersist()


def cluster_day(
    spark: SparkSession,
    archive: str,
    out: str,
    models: str,
    day: str,
    *,
    k: int = 5,
    pct: float = 95.0,
    heading: bool = False,
    run_ts: dt.datetime | None = None,
    model_day: str | None = None,
) -> DataFrame:
    """Fit, assign, flag and store the clusters of one day; returns the cluster summary.

    With `model_day` the model kept for that day is used instead of a new fit, so labels mean the same on both days; the thresholds
    are always those of the day itself.
    """
    inputs = (*clustering.FEATURES, clustering.HEADING) if heading else clustering.FEATURES
    day_pings = checks.require_rows(files.read_day(spark, archive, day), f"{archive} for {day}")
    features = clustering.feature_rows(day_pings, heading=heading).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        checks.require_rows(features, f"valid pings of {day}")
        if model_day is None:
            model = clustering.fit(features, k=k, inputs=inputs)
            tables.save_model(model, models, day)
        else:
            model = tables.load_model(models, model_day)
        stamp = F.lit(run_ts or dt.datetime.now(dt.timezone.utc)).cast("timestamp")
        centres = clustering.centres_of(model, inputs)
        result = clustering.cluster_vessels(features, centres, stamp, pct)
        tables.replace_day(result, f"{out}/vessel_behavior_clusters", day)
    finally:
        features.unpersist()
    return cluster_summary(files.read_day(spark, f"{out}/vessel_behavior_clusters", day, "kpi_date"))


def verify_day(spark: SparkSession, out: str, day: str) -> dict[str, int]:
    names = ("fleet_daily_kpis", "port_dwell_times", "route_density_grid", "vessel_behavior_clusters")
    return checks.verify_day({n: files.read_all(spark, f"{out}/{n}") for n in names}, day)


def run_days(
    spark: SparkSession, archive: str, out: str, models: str, days: Sequence[str], *, k: int = 5, pct: float = 95.0, retries: int = 1
) -> dict[str, dict[str, int]]:
    """KPI tables, clusters and verification for each of the days; returns the verified row counts by day.

    No day depends on another: one that fails leaves the others running, and at the end `CheckFailed` names all that failed. A day
    whose input or result is missing fails at once, any other error only after `retries` more attempts, which replace what
    an earlier one wrote.
    """
    verified: dict[str, dict[str, int]] = {}
    failed: dict[str, Exception] = {}
    for day in days:
        for attempt in range(retries + 1):
            try:
                daily_kpis(spark, archive, out, day)
                cluster_day(spark, archive, out, models, day, k=k, pct=pct)
                verified[day] = verify_day(spark, out, day)
                failed.pop(day, None)
                break
            except Exception as error:
                logging.getLogger(__name__).error("%s, attempt %d: %s", day, attempt + 1, error)
                failed[day] = error
                if isinstance(error, checks.CheckFailed):
                    break
    if failed:
        reasons = "; ".join(f"{day}: {str(error).partition(chr(10))[0]}" for day, error in failed.items())
        raise checks.CheckFailed(f"{len(failed)} of {len(days)} days failed: {reasons}") from next(iter(failed.values()))
    return verified


def days_between(first: str, last: str) -> list[str]:
    """All days from the first to the last one."""
    start = dt.date.fromisoformat(first)
    return [str(start + dt.timedelta(days=n)) for n in range((dt.date.fromisoformat(last) - start).days + 1)]


def replay_csv(spark: SparkSession, path: str, servers: str, topic: str = pings.RAW_TOPIC, max_rows: int = 0) -> None:
    """Publish the rows of ragged CSV files as keyed JSON messages."""
    publish(pings.to_messages(files.read_ragged_csv(spark, path, max_rows)), servers, topic)


def _property(text: str) -> tuple[str, str]:
    key, equals, value = text.partition("=")
    if not key or not equals:
        raise argparse.ArgumentTypeError(f"expected KEY=VALUE, not {text!r}")
    return key, value


KPI_TABLES = ("port_dwell_times", "fleet_daily_kpis", "route_density_grid", "vessel_speed_alerts")


def export_day(spark: SparkSession, out: str, day: str, url: str, properties: dict[str, str]) -> None:
    """Append the rows of a day to the database tables of the same names."""
    for name in KPI_TABLES:
        tables.jdbc_append(files.read_day(spark, f"{out}/{name}", day, "kpi_date"), url, name, properties)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tidewatch")
    jobs = parser.add_subparsers(dest="job", required=True)

    kpi = jobs.add_parser("daily-kpis")
    kpi.add_argument("--default-radius-nm", type=float, default=3.0)
    kpi.add_argument("--grid-cell-deg", type=float, default=0.05)
    kpi.add_argument("--speed-threshold", type=float, default=kpis.ALERT_KNOTS)
    kpi.add_argument("--ports-url", help="JDBC address of the port table")
    kpi.add_argument("--export-url", help="JDBC address to which the rows of the day are appended")
    for flag in ("--ports-property", "--export-property"):
        kpi.add_argument(flag, action="append", default=[], type=_property, metavar="KEY=VALUE", help="user, password, driver, ...")
    kpi.add_argument("--voyages", help="folder for the port visits laid out by voyage date and port")

    clusters = jobs.add_parser("cluster")
    clusters.add_argument("--k", type=int, default=5)
    clusters.add_argument("--anomaly-threshold-pct", type=float, default=95.0)
    clusters.add_argument("--heading", action="store_true")
    clusters.add_argument("--models", required=True)
    clusters.add_argument("--model-date", help="use the model kept for this day instead of fitting one")

    several = jobs.add_parser("days", help="daily-kpis, cluster and verify for every day of a range")
    for flag in ("--from-date", "--to-date", "--models", "--out"):
        several.add_argument(flag, required=True)
    several.add_argument("--k", type=int, default=5)
    several.add_argument("--anomaly-threshold-pct", type=float, default=95.0)
    several.add_argument("--retries", type=int, default=1)

    verify = jobs.add_parser("verify")
    for day_job in (kpi, clusters, several):
        day_job.add_argument("--archive", required=True)
    for day_job in (kpi, clusters, verify):
        day_job.add_argument("--exec-date", required=True)
        day_job.add_argument("--out", required=True)

    history = jobs.add_parser("clean-history")
    live = jobs.add_parser("stream")
    for source in (history, live):
        source.add_argument("--servers")
        source.add_argument("--messages")
        source.add_argument("--topic", default=pings.RAW_TOPIC)
        source.add_argument("--out", required=True)
    history.add_argument("--rejects")
    live.add_argument("--live-seconds", type=int)
    live.add_argument("--max-offsets", type=int, default=pings.MAX_OFFSETS)
    live.add_argument("--fused", action="store_true")
    live.add_argument("--rocksdb", action="store_true", help="keep streaming state in RocksDB")

    legacy = jobs.add_parser("clean-legacy")
    for name in ("--input", "--output", "--run-date"):
        legacy.add_argument(name, required=True)

    replay = jobs.add_parser("replay-csv")
    replay.add_argument("--input", required=True)
    replay.add_argument("--servers", required=True)
    replay.add_argument("--topic", default=pings.RAW_TOPIC)
    replay.add_argument("--max-rows", type=int, default=0)

    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"tidewatch-{args.job}").getOrCreate()
    try:
        run(spark, args)
    finally:
        drop_scratch(spark)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "daily-kpis":
        ports = reference.jdbc_ports(spark, args.ports_url, dict(args.ports_property)) if args.ports_url else None
        print(json.dumps(daily_kpis(
            spark, args.archive, args.out, args.exec_date, ports, default_radius_nm=args.default_radius_nm,
            grid_cell_deg=args.grid_cell_deg, threshold_knots=args.speed_threshold,
        )))
        if args.voyages:
            tables.write_dwell(files.read_all(spark, f"{args.out}/port_dwell_times"), args.voyages)
        if args.export_url:
            export_day(spark, args.out, args.exec_date, args.export_url, dict(args.export_property))
    elif args.job == "cluster":
        cluster_day(
            spark, args.archive, args.out, args.models, args.exec_date, k=args.k,
            pct=args.anomaly_threshold_pct, heading=args.heading, model_day=args.model_date,
        ).show()
    elif args.job == "days":
        print(json.dumps(run_days(
            spark, args.archive, args.out, args.models, days_between(args.from_date, args.to_date), k=args.k,
            pct=args.anomaly_threshold_pct, retries=args.retries,
        )))
    elif args.job == "verify":
        print(json.dumps(verify_day(spark, args.out, args.exec_date)))
    elif args.job == "clean-legacy":
        clean_csv_legacy(spark, args.input, args.output, args.run_date)
    elif args.job == "replay-csv":
        replay_csv(spark, args.input, args.servers, args.topic, args.max_rows)
    elif args.job == "clean-history":
        messages = pings.kafka_batch(spark, args.servers, args.topic) if args.servers else pings.replay_batch(spark, args.messages)
        clean_history(messages.select("value"), args.out, args.rejects)
    elif args.job == "stream":
        if args.rocksdb:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        messages = (
            pings.kafka_stream(spark, args.servers, args.topic, args.max_offsets)
            if args.servers else pings.replay_stream(spark, args.messages)
        )
        spark.streams.addListener(LateRows())
        start = start_fused if args.fused else start_fan_out
        await_all(start(clean_streams(messages), FanOut(args.out, alert_servers=args.servers), args.live_seconds))



if __name__ == "__main__":
    main()
