"""Physical plans stay the ones that scale."""

import re

import pytest
from helpers import plan
from pyspark.sql import functions as F

from tidewatch import registry, schemas
from tidewatch import surrogates as src
from tidewatch.operators import fleet_state, kpis, lookup, proximity, spatial
from tidewatch.sources import files


@pytest.mark.parametrize("name", sorted(registry.all_queries()))
def test_no_python_and_no_cross_joins(spark, sf_dir, name):
    text = plan(registry.all_queries()[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in text, f"{name}: {bad}"


def test_ports_are_broadcast_and_pings_not_shuffled(spark, sf_dir):
    text = plan(spatial.near_ports(src.pings(spark, sf_dir), schemas.ports(spark)))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_large_reference_is_joined_on_salted_cells(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(lookup, "fits_broadcast", lambda *a: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spatial.near_ports(src.pings(spark, sf_dir), schemas.ports(spark)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"Exchange hashpartitioning\(cell_lat#\d+L?, cell_lon#\d+L?, _salt", text)


def test_dwell_shrinks_before_its_shuffle(spark, sf_dir):
    text = plan(registry.port_dwell_sessions(spark, sf_dir))
    shuffles = [m.start() for m in re.finditer("Exchange hashpartitioning", text)]
    assert len(shuffles) == 2
    assert "partial_min(BaseDateTime" in text[shuffles[1]:] and "slice#" in text[shuffles[1]:].split("\n")[0]


def test_latest_state_keeps_one_row_per_vessel_before_its_shuffle(spark, sf_dir):
    text = plan(fleet_state.latest_pings(src.pings(spark, sf_dir), ["event_id"]))
    assert "partial_max_by" in text and text.count("Exchange hashpartitioning") == 1


def test_scans_read_only_needed_columns_and_push_filters(spark, sf_dir):
    text = plan(kpis.fleet_daily_kpis(src.pings(spark, sf_dir)))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"ts", "user_id", "value"}


def test_day_reads_prune_partitions(spark, sf_dir, tmp_path):
    base = str(tmp_path / "d")
    src.pings(spark, sf_dir).withColumn("date", F.to_date("BaseDateTime")).write.partitionBy("date").parquet(base)
    text = plan(files.read_day(spark, base, "2024-01-05").select("MMSI"))
    assert re.search(r"PartitionFilters: \[[^\]]*date#\d+ = ", text) and "ReadSchema: struct<MMSI:bigint>" in text


def test_collisions_meet_only_in_shared_cells(spark, sf_dir):
    text = plan(proximity.collision_pairs(src.fleet_pings(spark, sf_dir), ["event_id"]))
    assert re.search(r"(SortMergeJoin|HashJoin) \[bucket#\d+L?, _row#\d+L?, _cell#\d+L?", text)


def test_top_k_needs_no_full_sort(spark, sf_dir):
    for name in ("top_speeders", "alert_log", "vessel_roster", "grid_top_cells"):
        assert "TakeOrderedAndProject" in plan(registry.all_queries()[name](spark, sf_dir)), name
