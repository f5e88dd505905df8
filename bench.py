"""Time the headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewatch import registry  # noqa: E402
from tidewatch.session import drop_scratch, local_session  # noqa: E402

HEADLINE = (
    "port_dwell_sessions", "port_proximity_join", "fleet_speed_kpis", "route_density_grid", "speed_alerts",
    "clean_stream_profile", "clean_batch_profile", "dedup_positions", "latest_fleet_state", "movement_distance",
    "sliding_acceleration", "geofence_events", "collision_pairs", "port_congestion", "cluster_vessels",
    "distance_percentile_exact", "kmeans_clusters", "cluster_share", "cluster_totals", "busiest_ports",
    "boxplot_stats", "stream_fanout", "session_dwell_stream", "word_count", "least_squares",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").count()
    seconds = {}
    try:
        for name in HEADLINE:
            started = time.perf_counter()
            registry.all_queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
    finally:
        drop_scratch(spark)
        spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
