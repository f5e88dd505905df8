"""The dashboard, notebook and demo queries over the serving tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions import labels
from tidewatch.functions.geo import wkt_point
from tidewatch.functions.numbers import steady_round
from tidewatch.operators import orderstats
from tidewatch.operators.checks import row_counts
from tidewatch.operators.shape import first_rows

def _rows() -> Column:
    return F.count(F.lit(1))


def _count_if(flag: str) -> Column:
    return F.count_if(F.col(flag))


def _on(rows: DataFrame, day: str | None, column: str = "kpi_date") -> DataFrame:
    return rows if day is None else rows.filter(F.col(column) == F.lit(day).cast("date"))


def _pct(part: Column, whole: Column, digits: int = 2) -> Column:
    return steady_round(F.lit(100.0) * part / whole, digits)


# --- port visits ---------------------------------------------------------------------------------

def busiest_ports(dwell: DataFrame, day: str, n: int = 5) -> DataFrame:
    return (
        _on(dwell, day).groupBy("port_id").agg(
            _rows().alias("total_visits"),
            steady_round(F.avg("dwell_minutes"), 1).alias("avg_dwell_minutes"),
            F.round(F.max("dwell_minutes"), 1).alias("max_dwell_minutes"),
        )
        .orderBy(F.desc("total_visits"), "port_id").limit(n)
    )


def dwell_events_by_port(dwell: DataFrame, day: str) -> DataFrame:
    return (
        _on(dwell, day).groupBy("kpi_date", "port_id").agg(
            _rows().alias("completed_dwell_events"), steady_round(F.avg("dwell_minutes"), 1).alias("avg_dwell_mins")
        )
        .orderBy(F.desc("completed_dwell_events"), "port_id")
    )


def dwell_by_port(dwell: DataFrame, n: int | None = None) -> DataFrame:
    return first_rows(
        dwell.groupBy("port_id").agg(
            steady_round(F.avg("dwell_minutes"), 1).alias("avg_dwell_mins"), _rows().alias("dwell_events")
        )
        .orderBy(F.desc("avg_dwell_mins"), "port_id"),
        n,
    )


# --- fleet speed and density ---------------------------------------------------------------------

def pings_by_type_top(fleet: DataFrame, day: str, n: int = 5) -> DataFrame:
    return (
        _on(fleet, day)
        .select(
            "vessel_type", F.col("avg_sog").alias("avg_speed_kts"), F.col("max_sog").alias("max_speed_kts"),
            F.col("ping_count").alias("total_pings"),
        )
        .orderBy(F.desc("total_pings"), "vessel_type").limit(n)
    )


def fleet_kpi_top(fleet: DataFrame, day: str, n: int = 5) -> DataFrame:
    return (
        _on(fleet, day)
        .select(
            "kpi_date", "vessel_type", "ping_count",
            F.round("avg_sog", 2).alias("avg_sog_kts"), F.round("max_sog", 2).alias("max_sog_kts"),
        )
        .orderBy(F.desc("ping_count"), "vessel_type").limit(n)
    )


def speed_by_type(fleet: DataFrame, n: int | None = None) -> DataFrame:
    return first_rows(
        fleet.groupBy("vessel_type").agg(
            F.sum("ping_count").alias("total_pings"),
            steady_round(F.avg("avg_sog"), 2).alias("avg_speed_kts"),
            F.max("max_sog").alias("max_speed_kts"),
        )
        .orderBy(F.desc("total_pings"), "vessel_type"),
        n,
    )


def grid_top_cells(grid: DataFrame, day: str, n: int = 5) -> DataFrame:
    return (
        _on(grid, day).select("grid_lat", "grid_lon", F.col("ping_count").alias("density_pings"))
        .orderBy(F.desc("density_pings"), "grid_lat", "grid_lon").limit(n)
    )


# --- fleet state and alerts ----------------------------------------------------------------------

def active_vessels(state: DataFrame) -> DataFrame:
    return state.agg(F.countDistinct("mmsi").alias("active_vessels"))


def fleet_size(state: DataFrame) -> DataFrame:
    return state.agg(_rows().alias("fleet_rows"))


def vessel_roster(state: DataFrame, n: int = 100) -> DataFrame:
    return (
        state.select("mmsi", "vessel_name", "sog_knots", "cog_degrees", "nav_status", "last_updated")
        .orderBy(F.desc("last_updated"), "mmsi").limit(n)
    )


def latest_updates(state: DataFrame, n: int = 10) -> DataFrame:
    return state.select("mmsi", "vessel_name", "sog_knots", "last_updated").orderBy(F.desc("last_updated"), "mmsi").limit(n)


def violation_count(alerts: DataFrame) -> DataFrame:
    return alerts.agg(_rows().alias("speed_violations"))


def alert_log(alerts: DataFrame, n: int = 100) -> DataFrame:
    return (
        alerts.select("detected_at", "mmsi", "vessel_name", "sog_knots", "threshold_knots", "lat", "lon")
        .orderBy(F.desc("detected_at"), "mmsi", "lat", "lon").limit(n)
    )


# --- clusters ------------------------------------------------------------------------------------

def cluster_summary(clusters: DataFrame, day: str | None = None) -> DataFrame:
    return (
        _on(clusters, day).groupBy("cluster_id").agg(
            _rows().alias("total_vessels"),
            _count_if("is_anomaly").alias("anomaly_count"),
            steady_round(F.avg("sog_knots"), 2).alias("avg_sog_knots"),
            steady_round(F.avg("distance_to_centroid"), 4).alias("avg_distance"),
        )
        .orderBy("cluster_id")
    )


def top_anomalous_vessels(clusters: DataFrame, day: str, n: int = 5) -> DataFrame:
    return (
        _on(clusters, day).filter("is_anomaly")
        .select(
            "mmsi", "cluster_id", "sog_knots", "cog_degrees",
            F.round("distance_to_centroid", 4).alias("distance_to_centroid"),
            wkt_point(F.col("lon"), F.col("lat")).alias("point_geometry"),
        )
        .orderBy(F.desc("distance_to_centroid"), "mmsi").limit(n)
    )


def anomalies_with_names(clusters: DataFrame, state: DataFrame, day: str, n: int = 5) -> DataFrame:
    """The limit is that of the demo; rows are ordered so that it always keeps the same ones."""
    named = _on(clusters, day).filter("is_anomaly").join(state.select("mmsi", "vessel_name"), "mmsi", "left")
    return (
        named.select(
            "mmsi", "vessel_name", "cluster_id", F.col("sog_knots").alias("cluster_sog"),
            "distance_to_centroid", "is_anomaly",
        )
        .orderBy(F.desc("distance_to_centroid"), "mmsi").limit(n)
    )


def cluster_geometry(clusters: DataFrame, day: str) -> DataFrame:
    return (
        _on(clusters, day).groupBy("kpi_date", "cluster_id").agg(
            _rows().alias("vessel_count"),
            _count_if("is_anomaly").alias("anomalies_flagged"),
            steady_round(F.avg("sog_knots"), 2).alias("avg_sog_kts"),
            F.count("point").alias("valid_points"),
        )
        .orderBy("cluster_id")
    )


def flagged_anomalies(clusters: DataFrame) -> DataFrame:
    return clusters.agg(_count_if("is_anomaly").alias("flagged_anomalies"))


def vessels_per_cluster(clusters: DataFrame, n: int | None = None) -> DataFrame:
    return first_rows(
        clusters.groupBy("cluster_id").agg(_rows().alias("vessel_count"))
        .orderBy(F.desc("vessel_count"), "cluster_id"),
        n,
    )


def cluster_behaviour(clusters: DataFrame, n: int | None = None) -> DataFrame:
    return first_rows(
        clusters.groupBy("cluster_id").agg(
            _rows().alias("vessels"),
            _count_if("is_anomaly").alias("anomalies_flagged"),
            steady_round(F.avg("sog_knots"), 2).alias("avg_speed_kts"),
            steady_round(F.avg("distance_to_centroid"), 4).alias("avg_centroid_dist"),
        )
        .orderBy("cluster_id"),
        n,
    )


def cluster_label_counts(clusters: DataFrame) -> DataFrame:
    return (
        clusters.groupBy("cluster_id").agg(_rows().alias("vessel_count")).orderBy("cluster_id")
        .select(labels.cluster_label(F.col("cluster_id")).alias("cluster_label"), "vessel_count")
    )


def anomaly_split(clusters: DataFrame) -> DataFrame:
    return (
        clusters.groupBy("is_anomaly").agg(_rows().alias("vessel_count")).orderBy(F.desc("is_anomaly"))
        .select(labels.fleet_status(F.col("is_anomaly")).alias("fleet_status"), "vessel_count")
    )


def cluster_anomaly_pct(clusters: DataFrame) -> DataFrame:
    return (
        clusters.groupBy("cluster_id").agg(
            _rows().alias("total_fleet"),
            F.count_if(~F.col("is_anomaly")).alias("normal_vessels"),
            _count_if("is_anomaly").alias("anomalous_vessels"),
        )
        .orderBy("cluster_id")
        .select(
            labels.cluster_label(F.col("cluster_id")).alias("cluster_name"),
            "total_fleet", "normal_vessels", "anomalous_vessels",
            _pct(F.col("anomalous_vessels"), F.col("total_fleet")).alias("anomaly_pct"),
        )
    )


def cluster_averages(clusters: DataFrame) -> DataFrame:
    return (
        clusters.groupBy("cluster_id").agg(
            steady_round(F.avg("sog_knots"), 2).alias("avg_sog_knots"),
            steady_round(F.avg("cog_degrees"), 1).alias("avg_cog_degrees"),
            steady_round(F.avg("distance_to_centroid"), 4).alias("avg_distance_to_centroid"),
        )
        .orderBy("cluster_id")
        .select(
            labels.cluster_label(F.col("cluster_id")).alias("cluster_name"),
            "avg_sog_knots", "avg_cog_degrees", "avg_distance_to_centroid",
        )
    )


def anomaly_trend(clusters: DataFrame) -> DataFrame:
    return (
        clusters.groupBy("kpi_date").agg(
            _rows().alias("total_active_vessels"), _count_if("is_anomaly").alias("anomalous_vessels")
        )
        .orderBy("kpi_date")
        .select(
            F.col("kpi_date").cast("string").alias("partition_date"),
            "total_active_vessels", "anomalous_vessels",
            _pct(F.col("anomalous_vessels"), F.col("total_active_vessels")).alias("anomaly_rate_pct"),
        )
    )


def top_outliers(clusters: DataFrame, n: int = 20) -> DataFrame:
    return (
        clusters.filter("is_anomaly")
        .orderBy(F.desc("distance_to_centroid"), "mmsi", "kpi_date").limit(n)
        .select(
            "mmsi",
            F.col("kpi_date").cast("string").alias("observation_date"),
            "cluster_id",
            F.round("distance_to_centroid", 4).alias("distance_to_centroid"),
            F.round("sog_knots", 2).alias("sog_knots"),
            F.round("cog_degrees", 1).alias("cog_degrees"),
            F.round("lat", 4).alias("latitude"),
            F.round("lon", 4).alias("longitude"),
            "is_anomaly",
        )
    )


def cluster_report(clusters: DataFrame) -> DataFrame:
    """Speed and distance ranges, share of the fleet and anomaly rate per cluster.

    The window without a key runs over one row per cluster, whose number is the k of the model.
    """
    per_cluster = clusters.groupBy("cluster_id").agg(
        _rows().alias("vessel_count"),
        _count_if("is_anomaly").alias("anomaly_count"),
        steady_round(F.avg("sog_knots"), 2).alias("avg_sog"),
        F.round(F.min("sog_knots"), 2).alias("min_sog"),
        F.round(F.max("sog_knots"), 2).alias("max_sog"),
        steady_round(F.avg("distance_to_centroid"), 4).alias("avg_dist"),
        F.round(F.max("distance_to_centroid"), 4).alias("max_dist"),
    )
    fleet = F.sum("vessel_count").over(Window.partitionBy(F.lit(0)))
    return (
        per_cluster.withColumn("share_pct", _pct(F.col("vessel_count"), fleet, 1))
        .withColumn("anomaly_rate_pct", _pct(F.col("anomaly_count"), F.col("vessel_count")))
        .orderBy("cluster_id")
    )


def cluster_totals(clusters: DataFrame) -> DataFrame:
    return clusters.agg(
        _rows().alias("total_rows"),
        F.countDistinct("mmsi").alias("unique_vessels"),
        F.countDistinct("kpi_date").alias("num_dates"),
        F.min("kpi_date").alias("first_date"),
        F.max("kpi_date").alias("last_date"),
        _count_if("is_anomaly").alias("total_anomalies"),
    )


def speed_boxplot(clusters: DataFrame) -> DataFrame:
    """Quartiles, the 1.5 x IQR fences and the whisker ends of speed per cluster."""
    shares = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    boxes = orderstats.quantiles(clusters, ["cluster_id"], "sog_knots", shares)
    reach = F.lit(1.5) * (F.col("q3") - F.col("q1"))
    fenced = boxes.withColumn("low_fence", F.col("q1") - reach).withColumn("high_fence", F.col("q3") + reach)
    fenced = orderstats.materialize(fenced, "boxes")
    speed = F.col("sog_knots")
    inside = speed.between(F.col("low_fence"), F.col("high_fence"))
    whiskers = (
        orderstats.join_lookup(clusters.select("cluster_id", "sog_knots").filter(speed.isNotNull()), fenced, ["cluster_id"])
        .groupBy("cluster_id", "n", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, speed)).alias("low_whisker"),
            F.max(F.when(inside, speed)).alias("high_whisker"),
            F.count_if(~inside).alias("fliers"),
        )
    )
    return whiskers.withColumnRenamed("n", "vessel_count")


def distance_histogram(clusters: DataFrame, bins: int = 30) -> DataFrame:
    return orderstats.histogram(clusters, ["cluster_id"], "distance_to_centroid", bins)


def cluster_matrix(clusters: DataFrame) -> DataFrame:
    return (
        clusters.groupBy("cluster_id").agg(
            _rows().alias("fleet_count"),
            _count_if("is_anomaly").alias("anomaly_count"),
            steady_round(F.avg("sog_knots"), 2).alias("avg_sog_knots"),
            steady_round(F.avg("cog_degrees"), 1).alias("avg_cog_degrees"),
            steady_round(F.avg("distance_to_centroid"), 4).alias("avg_distance"),
            F.round(F.max("distance_to_centroid"), 4).alias("max_distance"),
            F.count("point").alias("vessels_with_geom"),
        )
        .withColumn("anomaly_rate_pct", _pct(F.col("anomaly_count"), F.col("fleet_count")))
        .orderBy("cluster_id")
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table and day; alerts count by the day of the alert."""
    return row_counts(tables, {"vessel_speed_alerts": "detected_at"})
