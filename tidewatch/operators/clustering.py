"""Vessel behaviour clusters and the outliers of each."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.geo import wkt_point
from tidewatch.functions.vectors import nearest, squared_distances
from tidewatch.operators.dedup import last_per_key
from tidewatch.operators.lookup import join_lookup
from tidewatch.operators.orderstats import exact_percentile
from tidewatch.operators.shape import computed_once
from tidewatch.session import materialize

FEATURES = ("sog_knots", "cog_degrees", "lat", "lon")
HEADING = "heading_degrees"


def feature_rows(pings: DataFrame, carry: Sequence[str] = (), *, heading: bool = False) -> DataFrame:
    """Pings fit for clustering: known vessel, speed up to 100 kn, course up to 360, valid position."""
    rows = pings.select(
        F.to_date("BaseDateTime").alias("kpi_date"),
        F.col("MMSI").cast("long").alias("mmsi"),
        F.col("BaseDateTime").alias("base_date_time"),
        F.col("SOG").cast("double").alias("sog_knots"),
        F.col("COG").cast("double").alias("cog_degrees"),
        F.col("LAT").cast("double").alias("lat"),
        F.col("LON").cast("double").alias("lon"),
        *([F.col("Heading").cast("double").alias(HEADING)] if heading else []),
        *carry,
    )
    good = (
        (F.col("mmsi") > 0)
        & F.col("sog_knots").between(0.0, 100.0)
        & F.col("cog_degrees").between(0.0, 360.0)
        & F.col("lat").between(-90.0, 90.0)
        & F.col("lon").between(-180.0, 180.0)
    )
    return rows.filter(good & F.col(HEADING).between(0.0, 360.0) if heading else good)


def fit(features: DataFrame, k: int = 5, seed: int = 42, inputs: Sequence[str] = FEATURES) -> PipelineModel:
    """Standardise the inputs and fit KMeans; the scaler is kept with the model."""
    stages = [
        VectorAssembler(inputCols=list(inputs), outputCol="features", handleInvalid="skip"),
        StandardScaler(inputCol="features", outputCol="scaled_features", withMean=True, withStd=True),
        KMeans(k=k, seed=seed, featuresCol="scaled_features", predictionCol="cluster_id"),
    ]
    return Pipeline(stages=stages).fit(features)


@dataclass(frozen=True)
class Centres:
    """Cluster centres in standardised space, with the shift and scale that lead there."""

    inputs: tuple[str, ...]
    shift: tuple[float, ...]
    scale: tuple[float, ...]
    points: tuple[tuple[float, ...], ...]

    def parts(self) -> list[Column]:
        return [
            (F.col(name) - F.lit(shift)) * F.lit(1.0 / scale if scale else 0.0)
            for name, shift, scale in zip(self.inputs, self.shift, self.scale, strict=True)
        ]


def centres_of(model: PipelineModel, inputs: Sequence[str] = FEATURES) -> Centres:
    scaler, kmeans = model.stages[1], model.stages[2]
    return Centres(
        inputs=tuple(inputs),
        shift=tuple(float(v) for v in scaler.mean.toArray()),
        scale=tuple(float(v) for v in scaler.std.toArray()),
        points=tuple(tuple(float(v) for v in c) for c in kmeans.clusterCenters()),
    )


def assign(features: DataFrame, centres: Centres) -> DataFrame:
    """Add `cluster_id` and `distance_to_centroid`, computed on plain columns in generated code."""
    measured = features.withColumn("_squares", squared_distances(centres.parts(), centres.points))
    return computed_once(
        measured.withColumn("cluster_id", nearest(F.col("_squares")))
        .withColumn("distance_to_centroid", F.sqrt(F.array_min("_squares")))
        .drop("_squares")
    )


def thresholds(assigned: DataFrame, pct: float = 95.0, *, by: Sequence[str] = ("cluster_id",), exact: bool = False) -> DataFrame:
    """Distance that `pct` percent of a cluster's pings do not exceed."""
    by, share = list(by), float(pct) / 100.0
    if exact:
        return exact_percentile(assigned, by, "distance_to_centroid", share).select(
            *by, F.col("value").alias("threshold_distance")
        )
    return assigned.groupBy(*by).agg(
        F.percentile_approx("distance_to_centroid", share).alias("threshold_distance")
    )


def flag_anomalies(assigned: DataFrame, limits: DataFrame, by: Sequence[str] = ("cluster_id",)) -> DataFrame:
    """`is_anomaly` where the distance lies beyond the cluster's threshold."""
    limits = materialize(limits, "thresholds")
    beyond = F.col("distance_to_centroid") > F.col("threshold_distance")
    return join_lookup(assigned, limits, by, "left").withColumn("is_anomaly", F.coalesce(beyond, F.lit(False)))


def latest_result_rows(flagged: DataFrame, model_run_ts: Column, tiebreak: Sequence[str] = ()) -> DataFrame:
    """The serving table: the newest ping per vessel and day with its cluster."""
    latest = last_per_key(flagged, ["kpi_date", "mmsi"], ["base_date_time", *(tiebreak or ("lat", "lon", "sog_knots", "cog_degrees"))])
    return latest.select(
        "kpi_date",
        "mmsi",
        F.col("cluster_id").cast("int").alias("cluster_id"),
        F.round("lat", 6).alias("lat"),
        F.round("lon", 6).alias("lon"),
        F.round("sog_knots", 2).alias("sog_knots"),
        F.round("cog_degrees", 2).alias("cog_degrees"),
        F.round("distance_to_centroid", 4).alias("distance_to_centroid"),
        "is_anomaly",
        wkt_point(F.round("lon", 6), F.round("lat", 6)).alias("point"),
        model_run_ts.alias("model_run_ts"),
    )


def cluster_vessels(
    features: DataFrame,
    centres: Centres,
    model_run_ts: Column,
    pct: float = 95.0,
    *,
    exact: bool = False,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Assign, threshold per day and cluster, flag, and keep the newest ping per vessel and day."""
    by = ("kpi_date", "cluster_id")
    assigned = assign(features, centres)
    flagged = flag_anomalies(assigned, thresholds(assigned, pct, by=by, exact=exact), by)
    return latest_result_rows(flagged, model_run_ts, tiebreak)


def top_outliers(assigned: DataFrame, n: int = 20) -> DataFrame:
    """Pings furthest from their centre."""
    return (
        assigned.select("mmsi", "lat", "lon", F.col("sog_knots").alias("sog"), "cluster_id", "distance_to_centroid")
        .orderBy(F.desc("distance_to_centroid"), "mmsi", "lat", "lon")
        .limit(n)
    )


def fit_facts(features: DataFrame, model: PipelineModel, inputs: Sequence[str] = FEATURES, pct: float = 95.0) -> DataFrame:
    """What holds for any fit, whatever its labels: per input the mean and deviation the model standardises with, the rows
    fitted, the rows whose assigned centre is not the model's own choice, and whether the flagged share fits the percentile."""
    centres = centres_of(model, inputs)
    chosen = model.transform(features).withColumnRenamed("cluster_id", "chosen").drop("features", "scaled_features")
    assigned = materialize(assign(chosen, centres), "assigned")
    flagged = flag_anomalies(assigned, thresholds(assigned, pct))
    per_cluster = flagged.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("chosen") != F.col("cluster_id")).alias("off"), F.count_if("is_anomaly").alias("beyond")
    )
    # percentile_approx may be off by n / 10000 ranks
    fits = F.abs(F.col("beyond") - F.col("n") * (1 - pct / 100)) <= 1 + F.col("n") / 10_000
    total = per_cluster.agg(F.sum("n").alias("fitted_rows"), F.sum("off").alias("misassigned"), F.every(fits).alias("share_fits"))
    scales = F.array(*[
        F.struct(F.lit(name).alias("input"), F.lit(mean).alias("mean"), F.lit(deviation).alias("deviation"))
        for name, mean, deviation in zip(centres.inputs, centres.shift, centres.scale, strict=True)
    ])
    return total.select(F.inline(scales), "fitted_rows", "misassigned", "share_fits")
