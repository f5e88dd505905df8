"""Pairs of vessels close to each other, and how soon they meet; busy ports."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import geo
from tidewatch.functions.calendar import epoch_micros, time_slice
from tidewatch.functions.labels import congestion_risk
from tidewatch.operators.lookup import join_lookup
from tidewatch.operators.shape import computed_once
from tidewatch.operators.spatial import DEFAULT_RADIUS_NM, near_ports
from tidewatch.session import materialize

CROWDED_CELL = 2_000
#: The longest reporting interval of a vessel at anchor.
WITHIN_SECONDS = 180
PAIR = ["slice", "vessel_1_mmsi", "vessel_2_mmsi"]


def collision_pairs(
    pings: DataFrame,
    tiebreak: list[str],
    *,
    within_seconds: int = WITHIN_SECONDS,
    slice_seconds: int = 600,
    high_nm: float = 0.5,
    high_minutes: float = 10.0,
    medium_nm: float = 1.0,
    medium_minutes: float = 20.0,
    crowded_cell: int = CROWDED_CELL,
    known: DataFrame | None = None,
) -> DataFrame:
    """Pairs of vessels at HIGH or MEDIUM risk, the closest approach of each pair and time slice.

    All pings take part. Two pings of different vessels are compared if they lie at most `within_seconds` apart: the
    earlier one is moved along its course to the time of the later, so both positions hold for one instant, and
    distance and time to the closest point follow from there. A pair belongs to the slice of its later ping; of several
    rated comparisons in a slice the one with the smallest distance stays, then the sooner, then the earlier one.

    Pings meet through a shared time bucket as long as the tolerance (the earlier ping also stands in the next bucket, so
    bucket borders split nothing) and a shared grid cell as wide as the reach plus the longest way in that time. In each
    bucket the earlier ping stands only in those cells around its own that come within `medium_nm` of its way during the bucket.
    A crowded cell is cut into parts: one side is dealt out over them, the other is repeated in each.

    `known` holds further pings whose pairs among themselves were rated before: they meet only those of `pings`, so a batch costs
    the comparisons of its own pings.
    """
    if known is not None:
        pings = pings.withColumn("_new", F.lit(True)).unionByName(known.withColumn("_new", F.lit(False)))
    else:
        pings = pings.withColumn("_new", F.lit(True))
    reach = float(medium_nm) + geo.MAX_SOG_KNOTS * within_seconds / 3600.0
    located = pings.filter(geo.valid_position(F.col("LAT"), F.col("LON")) & F.col("BaseDateTime").isNotNull())
    ships = located.select(
        F.col("MMSI").cast("long").alias("mmsi"), "BaseDateTime", "LAT", "LON", "SOG", "COG", "_new",
        *[F.col(c).alias(f"_tie_{i}") for i, c in enumerate(tiebreak)],
        time_slice(F.col("BaseDateTime"), within_seconds).alias("bucket"),
    )

    # Latitude rows as high as the reach; each row has its own number of cells around the globe, as wide
    # as the reach at the row's far edge (one row further out for the neighbour) or wider.
    reach_rad = reach / geo.EARTH_RADIUS_NM
    row_deg = math.degrees(reach_rad) * 1.0001
    step = F.array(*[F.lit(i).cast("long") for i in (-1, 0, 1)])

    def cells_in_row(row):
        far_edge = F.greatest(F.abs((row - 1) * row_deg), F.abs((row + 2) * row_deg))
        width = F.cos(F.radians(F.least(far_edge, F.lit(90.0))))
        cells = F.floor(F.lit(360.0 / row_deg * 0.99) * width)
        return F.when(width < 10 * reach_rad, F.lit(1)).otherwise(F.greatest(cells, F.lit(1))).cast("long")

    def cell_of(lon, cells):
        share = F.pmod(lon + 180.0, F.lit(360.0)) / 360.0
        return F.least(F.floor(share * cells).cast("long"), cells - 1)

    home_row = F.floor(F.col("LAT") / F.lit(row_deg)).cast("long")
    left = (
        ships.withColumn("_row", home_row)
        .withColumn("_cells", cells_in_row(F.col("_row")))
        .withColumn("_cell", cell_of(F.col("LON"), F.col("_cells")))
    )
    # The earlier ping is repeated over the cells of its 3 x 3 neighbourhood that its way touches, each row counted in its own
    # cells: every pair of pings meets once, in the bucket and cell of the later one.
    left_over = (F.col("bucket") + 1) * F.lit(within_seconds) - epoch_micros(F.col("BaseDateTime")) / F.lit(1e6)
    spans = F.array(
        F.struct(F.col("bucket"), F.lit(0.0).alias("since"), left_over.alias("until")),
        F.struct((F.col("bucket") + 1).alias("bucket"), left_over.alias("since"), F.lit(float(within_seconds)).alias("until")),
    )
    spot = F.struct("LAT", "LON", "SOG", "COG")
    ends = [geo.moved(spot, F.col(f"_span.{end}") / 3600.0) for end in ("since", "until")]
    south, north = (pick(*[end["LAT"] for end in ends]) for pick in (F.least, F.greatest))
    east = [geo.degrees_east(spot, F.col(f"_span.{end}") / 3600.0) for end in ("since", "until")]
    high = geo.circle_lat_margin(F.lit(float(medium_nm)))
    wide = geo.circle_lon_margin(F.greatest(F.abs(south), F.abs(north)), F.lit(float(medium_nm)))
    around = F.col("_around")
    place = F.pmod(F.col("LON") + 180.0, F.lit(360.0)) / 360.0 * F.col("_cells") - F.col("_mid")
    west_end, east_end = (place + around[side] / 360.0 * F.col("_cells") for side in ("west", "east"))
    right = (
        ships.withColumn("_span", F.explode(spans))
        .withColumn("bucket", F.col("_span.bucket"))
        .withColumn("_around", F.struct(
            F.floor((south - high) / row_deg).alias("first"), F.floor((north + high) / row_deg).alias("last"),
            (F.least(*east) - wide).alias("west"), (F.greatest(*east) + wide).alias("east"),
        ))
        .withColumn("_row", F.explode(F.filter(F.transform(step, lambda i: home_row + i), lambda row: row.between(around["first"], around["last"]))))
        .withColumn("_cells", cells_in_row(F.col("_row")))
        .withColumn("_mid", cell_of(F.col("LON"), F.col("_cells")))
        .withColumn("_cell", F.explode(F.array_distinct(F.transform(
            F.filter(step, lambda i: F.when(i < 0, west_end <= 0.0).when(i > 0, east_end >= 1.0).otherwise(True)),
            lambda i: F.pmod(F.col("_mid") + i, F.col("_cells")),
        ))))
        .drop("_span", "_around")
    )

    cell = ["bucket", "_row", "_cell"]
    crowds = materialize(
        left.groupBy(*cell)
        .agg(F.count(F.lit(1)).alias("_ships"))
        .filter(F.col("_ships") > crowded_cell)
        .select(*cell, F.ceil(F.col("_ships") / F.lit(float(crowded_cell))).cast("int").alias("_parts")),
        "crowds",
    )
    left, right = _dealt_out(left, right, crowds, cell)

    ties = [f"_tie_{i}" for i in range(len(tiebreak))]
    columns = ["mmsi", "LAT", "LON", "SOG", "COG", "BaseDateTime", *ties]

    def met(later: DataFrame, earlier: DataFrame) -> DataFrame:
        a, b = (side.select(*cell, "_part", *[F.col(c).alias(f"{name}_{c}") for c in columns]) for side, name in ((later, "a"), (earlier, "b")))
        return a.join(b, [*cell, "_part"]).select(*[F.struct(*[F.col(f"{name}_{c}").alias(c) for c in columns]).alias(name) for name in "ab"])

    both = met(left, right) if known is None else met(left.filter("_new"), right).union(met(left.filter("NOT _new"), right.filter("_new")))
    micros = lambda ping: F.unix_micros(F.col(f"{ping}.BaseDateTime").cast("timestamp"))
    apart = micros("a") - micros("b")
    when_a, when_b = (F.struct(*[F.col(f"{ping}.{c}") for c in ("BaseDateTime", "mmsi", *ties)]) for ping in "ab")
    pairs = both.filter(
        (when_b < when_a) & (F.col("a.mmsi") != F.col("b.mmsi"))
        & (apart <= within_seconds * 1_000_000) & (F.abs(F.col("a.LAT") - F.col("b.LAT")) <= row_deg)
    )
    moved = pairs.withColumn("b", geo.moved(F.col("b"), apart / 3.6e9))
    distance = geo.haversine_nm(F.col("a.LAT"), F.col("a.LON"), F.col("b.LAT"), F.col("b.LON"))
    near = computed_once(moved.withColumn("distance_nm", distance)).filter(F.col("distance_nm") < medium_nm)
    first, second = (F.when(F.col("a.mmsi") < F.col("b.mmsi"), F.col(x)).otherwise(F.col(y)) for x, y in ("ab", "ba"))
    ordered = near.select(time_slice(F.col("a.BaseDateTime"), slice_seconds).alias("slice"), first.alias("a"), second.alias("b"), "distance_nm")
    rated = _rated(computed_once(ordered), high_nm, high_minutes, medium_nm, medium_minutes)
    return closest_per_slice(rated)


def closest_per_slice(rated: DataFrame) -> DataFrame:
    """One row per pair and time slice: the smallest distance, then the sooner, then the earlier one."""
    order = [F.round("distance_meters", 3), F.round("cpa_minutes", 6), F.col("created_at"), F.round("mid_lat", 6), F.round("mid_lon", 6)]
    kept = [c for c in rated.columns if c not in PAIR]
    closest = rated.groupBy(*PAIR).agg(F.min_by(F.struct(*kept), F.struct(*order)).alias("row"))
    return closest.select([F.col(c) if c in PAIR else F.col(f"row.{c}").alias(c) for c in rated.columns])


def _dealt_out(left: DataFrame, right: DataFrame, crowds: DataFrame, cell: list[str]) -> tuple[DataFrame, DataFrame]:
    """Spread the left side of crowded cells over parts and repeat the right side in each part."""
    if crowds.isEmpty():
        return left.withColumn("_part", F.lit(0)), right.withColumn("_part", F.lit(0))
    parts = F.coalesce("_parts", F.lit(1))
    spread = join_lookup(left, crowds, cell, "left").withColumn("_part", F.pmod(F.xxhash64("mmsi"), parts).cast("int"))
    copies = join_lookup(right, crowds, cell, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return spread, copies


def _rated(near: DataFrame, high_nm, high_minutes, medium_nm, medium_minutes) -> DataFrame:
    a, b = F.col("a"), F.col("b")
    dlon = geo.wrap_degrees(b["LON"] - a["LON"])
    mid_lat = (a["LAT"] + b["LAT"]) / 2.0
    dx = dlon * 60.0 * F.cos(F.radians(mid_lat))
    dy = (b["LAT"] - a["LAT"]) * 60.0
    dvx = geo.velocity_east(b["SOG"], b["COG"]) - geo.velocity_east(a["SOG"], a["COG"])
    dvy = geo.velocity_north(b["SOG"], b["COG"]) - geo.velocity_north(a["SOG"], a["COG"])
    minutes = geo.minutes_to_closest(dx, dy, dvx, dvy)
    risk = F.when((F.col("distance_nm") < high_nm) & (F.col("cpa_minutes") < high_minutes), "HIGH").when(
        (F.col("distance_nm") < medium_nm) & (F.col("cpa_minutes") < medium_minutes), "MEDIUM"
    )
    mid_lon = geo.wrap_degrees(a["LON"] + dlon / 2.0)
    return (
        computed_once(near.withColumn("cpa_minutes", minutes))
        .withColumn("risk_level", risk)
        .filter("risk_level IS NOT NULL")
        .select(
            "slice",
            a["mmsi"].alias("vessel_1_mmsi"),
            b["mmsi"].alias("vessel_2_mmsi"),
            (F.col("distance_nm") * geo.METERS_PER_NM).alias("distance_meters"),
            "cpa_minutes",
            "risk_level",
            mid_lat.alias("mid_lat"),
            mid_lon.alias("mid_lon"),
            F.greatest(a["BaseDateTime"], b["BaseDateTime"]).alias("created_at"),
        )
    )


def port_congestion(latest: DataFrame, ports: DataFrame, default_radius_nm: float = DEFAULT_RADIUS_NM) -> DataFrame:
    """Vessels at each port, their mean speed and a risk level; ports without vessels are LOW."""
    counted = (
        near_ports(latest, ports, default_radius_nm)
        .groupBy("port_id")
        .agg(F.count(F.lit(1)).alias("active_vessels_count"), F.avg("SOG").alias("avg_speed_knots"))
    )
    every = ports.select("port_id").join(counted, "port_id", "left")
    vessels = F.coalesce("active_vessels_count", F.lit(0)).cast("long")
    return every.select(
        "port_id", vessels.alias("active_vessels_count"), "avg_speed_knots",
        congestion_risk(vessels).alias("congestion_risk"),
    )
