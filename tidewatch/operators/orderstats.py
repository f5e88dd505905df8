"""Exact order statistics per group by narrowing value ranges; no group is ever gathered whole."""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.operators.lookup import join_lookup
from tidewatch.session import materialize

BINS = 2048
LARGEST = sys.float_info.max
SMALL_RANGE = 20_000


def exact_ranks(
    rows: DataFrame,
    group: Sequence[str],
    value: str,
    ranks: dict[str, str],
    *,
    bins: int = BINS,
    small_range: int = SMALL_RANGE,
) -> DataFrame:
    """The value at given ranks: columns `group`, `label`, `n` and `value`.

    `ranks` maps a label to a SQL expression over `n` for the 1-based rank. Each pass counts rows in bins
    between the bounds known so far and keeps the bin that holds the rank; bounds are data values, so
    outliers and ties shrink away quickly. When few rows are left between the bounds, they are ranked.
    """
    group = list(group)
    values = _numbers(rows, group, value)
    ends = values.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    )
    wanted = F.explode(F.array(*[
        F.struct(F.lit(label).alias("label"), F.expr(rank).cast("long").alias("_rank"))
        for label, rank in ranks.items()
    ]))
    targets = materialize(
        ends.withColumn("_t", wanted)
        .select(*group, "n", "_lo", "_hi", F.col("n").alias("_left"), "_t.label", "_t._rank"),
        "ranks",
    )
    while _widest(targets) > small_range:
        targets = materialize(_narrow(values, targets, group, bins), "ranks")

    span = join_lookup(values, targets, group).filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))
    # Ties collapse into a count first, so one repeated value cannot swell the window.
    counted = span.groupBy(*group, "label", "n", "_rank", "_v").agg(F.count(F.lit(1)).alias("_c"))
    upto = Window.partitionBy(*group, "label").orderBy("_v")
    placed = counted.withColumn("_end", F.sum("_c").over(upto))
    hit = placed.filter((F.col("_end") >= F.col("_rank")) & (F.col("_end") - F.col("_c") < F.col("_rank")))
    return hit.select(*group, "label", "n", F.col("_v").alias("value"))


def _numbers(rows: DataFrame, group: list[str], value: str) -> DataFrame:
    number = F.col(value).cast("double")
    return rows.filter(number.isNotNull() & ~F.isnan(number)).select(*group, number.alias("_v"))


def _widest(targets: DataFrame) -> int:
    """Rows between the bounds of the widest target that still has distinct values in it."""
    open_ranges = targets.filter(F.col("_lo") < F.col("_hi"))
    return open_ranges.agg(F.coalesce(F.max("_left"), F.lit(0))).first()[0]


def _narrow(values: DataFrame, targets: DataFrame, group: list[str], bins: int) -> DataFrame:
    # Halves of finite stand-ins: neither infinities nor a range wider than a double break the division. The ends
    # always fall into different bins, so every round narrows.
    half = lambda c: F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), F.col(c))) / 2
    share = F.coalesce(F.try_divide(half("_v") - half("_lo"), half("_hi") - half("_lo")), F.lit(0.0))
    inner = F.least(F.floor(share * bins), F.lit(bins - 1))
    bin_no = F.when(F.col("_v") <= F.col("_lo"), 0).when(F.col("_v") >= F.col("_hi"), bins - 1).otherwise(inner)
    span = join_lookup(values, targets, group).filter(F.col("_v").between(F.col("_lo"), F.col("_hi")))
    counted = (
        span.withColumn("_bin", bin_no)
        .groupBy(*group, "label", "n", "_rank", "_bin")
        .agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_blo"), F.max("_v").alias("_bhi"))
    )
    upto = Window.partitionBy(*group, "label").orderBy("_bin")
    placed = counted.withColumn("_end", F.sum("_c").over(upto))
    hit = placed.filter((F.col("_end") >= F.col("_rank")) & (F.col("_end") - F.col("_c") < F.col("_rank")))
    return hit.select(
        *group, "n", F.col("_blo").alias("_lo"), F.col("_bhi").alias("_hi"), F.col("_c").alias("_left"),
        "label", (F.col("_rank") - (F.col("_end") - F.col("_c"))).alias("_rank"),
    )


def exact_percentile(rows: DataFrame, group: Sequence[str], value: str, share: float) -> DataFrame:
    """Smallest value that at least `share` of the group does not exceed, as column `value`."""
    rank = f"greatest(1, ceil({share!r}D * n))"
    return exact_ranks(rows, group, value, {"p": rank}).drop("label")


def quantiles(rows: DataFrame, group: Sequence[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Linearly interpolated quantiles, one column per entry of `shares`."""
    group = list(group)
    ranks = {}
    for name, share in shares.items():
        ranks[f"{name}/lo"] = f"floor({share!r}D * (n - 1)) + 1"
        ranks[f"{name}/hi"] = f"ceil({share!r}D * (n - 1)) + 1"
    found = exact_ranks(rows, group, value, ranks)
    at = {
        label: F.max(F.when(F.col("label") == label, F.col("value"))) for label in ranks
    }
    wide = found.groupBy(*group, "n").agg(*[col.alias(label) for label, col in at.items()])

    def between(name: str, share: float):
        place = F.lit(share) * (F.col("n") - 1)
        lo, hi = F.col(f"`{name}/lo`"), F.col(f"`{name}/hi`")
        return (lo + (hi - lo) * (place - F.floor(place))).alias(name)

    return wide.select(*group, "n", *[between(name, share) for name, share in shares.items()])


def histogram(rows: DataFrame, group: Sequence[str], value: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over each group's own range; the last bin is closed. Empty bins are left out."""
    group = list(group)
    values = _numbers(rows, group, value)
    ends = materialize(values.groupBy(*group).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi")), "ends")
    share = F.coalesce(F.try_divide(F.col("_v") - F.col("_lo"), F.col("_hi") - F.col("_lo")), F.lit(0.0))
    return (
        join_lookup(values, ends, group)
        .withColumn("bin", F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int"))
        .groupBy(*group, "bin")
        .agg(F.count(F.lit(1)).alias("vessel_count"))
    )
