"""Distance travelled and acceleration."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.calendar import epoch_micros
from tidewatch.functions.geo import haversine_nm
from tidewatch.operators.sequences import with_slices


def movement_distance(pings: DataFrame, tiebreak: list[str], **slicing) -> DataFrame:
    """Nautical miles per vessel along its pings in time order.

    Legs inside a time slice are summed per (vessel, slice); the legs between slices need only the ends.
    """
    order = ["BaseDateTime", *tiebreak]
    located = pings.filter(F.col("LAT").isNotNull() & F.col("LON").isNotNull()).select(
        F.col("MMSI").cast("long").alias("mmsi"), "LAT", "LON", *order
    )
    sliced = with_slices(located, ["mmsi"], "BaseDateTime", **slicing)
    in_slice = Window.partitionBy("mmsi", "_slice").orderBy(*order)
    spot = F.struct("LAT", "LON")
    before = {"_lat": F.lag("LAT").over(in_slice), "_lon": F.lag("LON").over(in_slice)}
    legs = sliced.withColumns(before).withColumn(
        "_leg", haversine_nm(F.col("_lat"), F.col("_lon"), F.col("LAT"), F.col("LON"))
    )
    slices = legs.groupBy("mmsi", "_slice").agg(
        F.sum("_leg").alias("_inside"),
        F.count(F.lit(1)).alias("_n"),
        F.min_by(spot, F.struct(*order)).alias("_first"),
        F.max_by(spot, F.struct(*order)).alias("_last"),
    )
    over_slices = Window.partitionBy("mmsi").orderBy("_slice")
    bridge = haversine_nm(F.col("_from.LAT"), F.col("_from.LON"), F.col("_first.LAT"), F.col("_first.LON"))
    return (
        slices.withColumn("_from", F.lag("_last").over(over_slices))
        .withColumn("_bridge", bridge)
        .groupBy("mmsi")
        .agg(
            F.sum("_n").alias("ping_count"),
            F.sum(F.coalesce("_inside", F.lit(0.0)) + F.coalesce("_bridge", F.lit(0.0))).alias("distance_nm"),
        )
    )


STEP_SECONDS, STEPS = 60, 5


def sliding_acceleration(pings: DataFrame, tiebreak: list[str], step_seconds: int = STEP_SECONDS, steps: int = STEPS) -> DataFrame:
    """Knots gained per second between the first and last speed of each sliding window and vessel.

    A window is `steps` steps wide and moves by one. Pings shrink to one row per vessel and step before
    they are repeated for the windows they belong to. Pings of one instant rank by `tiebreak`.
    """
    return acceleration_of_steps(speed_steps(pings, tiebreak, step_seconds), step_seconds, steps)


def speed_steps(pings: DataFrame, tiebreak: list[str], step_seconds: int = STEP_SECONDS) -> DataFrame:
    """The first and last speed of every vessel and step, with the places of their pings, and the number of pings."""
    at, when = F.col("BaseDateTime"), F.struct("BaseDateTime", *tiebreak)
    return (
        pings.filter(F.col("SOG").isNotNull())
        .groupBy(F.col("MMSI").cast("long").alias("mmsi"), F.window(at, f"{step_seconds} seconds")["start"].alias("_step"))
        .agg(
            F.min(when).alias("_from"), F.min_by("SOG", when).alias("_first"),
            F.max(when).alias("_to"), F.max_by("SOG", when).alias("_last"), F.count(F.lit(1)).alias("_n"),
        )
    )


def acceleration_of_steps(per_step: DataFrame, step_seconds: int = STEP_SECONDS, steps: int = STEPS) -> DataFrame:
    """Sliding windows over the rows of `speed_steps`; a step may come in several rows, each for a part of its pings."""
    back = F.explode(F.sequence(F.lit(0), F.lit(steps - 1)))
    repeated = per_step.withColumn("_back", back).withColumn(
        "window_start", F.col("_step") - F.make_dt_interval(secs=F.col("_back") * F.lit(step_seconds))
    )
    gained = F.col("last_sog") - F.col("first_sog")
    seconds = (epoch_micros(F.col("last_at")) - epoch_micros(F.col("first_at"))) / F.lit(1_000_000.0)
    return (
        repeated.groupBy("mmsi", "window_start")
        .agg(
            F.sum("_n").alias("ping_count"), F.min("_from")["BaseDateTime"].alias("first_at"), F.max("_to")["BaseDateTime"].alias("last_at"),
            F.min_by("_first", "_from").alias("first_sog"), F.max_by("_last", "_to").alias("last_sog"),
        )
        .filter(F.col("last_at") > F.col("first_at"))
        .select("mmsi", "window_start", "ping_count", (gained / seconds).alias("acceleration"))
    )
