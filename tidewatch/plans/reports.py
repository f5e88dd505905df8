"""Group, pivot and best-of reports of the tutorial notebooks, on any table with the right columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.functions.labels import month_label
from tidewatch.operators.lookup import join_lookup


def counts_below(rows: DataFrame, column: str, limit: float) -> DataFrame:
    """Rows per value of `column` below a limit."""
    return rows.filter(F.col(column) < limit).groupBy(column).agg(F.count(F.lit(1)).alias("v")).orderBy(column)


def counts_where(rows: DataFrame, column: str, condition: Column) -> DataFrame:
    """Rows per value of `column` among those that meet a condition."""
    return rows.filter(condition).groupBy(column).agg(F.count(F.lit(1)).alias("v")).orderBy(column)


def group_counts(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def best_groups(rows: DataFrame, key: str, names: DataFrame | None = None, name: str = "name") -> DataFrame:
    """Every key with the largest row count, named from `names` (columns `key`, `name`) where given."""
    counts = group_counts(rows, key)
    top = counts.agg(F.max("n").alias("n"))
    best = counts.join(F.broadcast(top), "n").select(key, "n")
    return best if names is None else best.join(names.select(key, name), key)


def monthly_counts(rows: DataFrame, best: DataFrame, key: str, date: str) -> DataFrame:
    """Rows of the best groups per month."""
    of_best = join_lookup(rows, best.select(key), [key])
    return of_best.groupBy(F.month(date).alias("month")).agg(F.count(F.lit(1)).alias("n")).orderBy("month")


PIVOT_YEARS = 3


def month_pivot(rows: DataFrame, date: str, years: int = PIVOT_YEARS) -> DataFrame:
    """One row per month and block of `years` consecutive years, with one count column per year of the block.

    Blocks start at the first year of the table and cover all of its years; rows without date have no month and no block.
    """
    by_year = month_year_counts(rows, date).filter(F.col("year").isNotNull())  # twelve rows a year
    after = F.col("year") - F.min("year").over(Window.partitionBy())
    placed = by_year.withColumn("place", F.pmod(after, F.lit(years))).withColumn("from_year", F.col("year") - F.col("place"))
    counted = placed.groupBy("from_year", "month").agg(*[
        F.coalesce(F.sum(F.when(F.col("place") == k, F.col("n"))), F.lit(0)).alias(f"year_{k + 1}") for k in range(years)
    ])
    named = [F.col(f"year_{k + 1}") for k in range(years)]
    return counted.select("from_year", "month", month_label(F.col("month")).alias("month_name"), *named).orderBy("from_year", "month")


def month_year_counts(rows: DataFrame, date: str) -> DataFrame:
    """Rows per month and year, for all years of the table; rows without date keep a line of their own."""
    counted = rows.groupBy(F.month(date).alias("month"), F.year(date).alias("year")).agg(F.count(F.lit(1)).alias("n"))
    name = F.when(F.col("month").isNotNull(), month_label(F.col("month")))
    return counted.select("month", name.alias("month_name"), "year", "n").orderBy("month", "year")


def month_year_per_day(counts: DataFrame) -> DataFrame:
    """Counts of `month_year_counts` per day of the month, cut to whole numbers."""
    days = F.when(F.col("month").isNotNull(), days_in_month(F.col("month"), F.col("year")))
    return counts.select("month", "month_name", "year", F.floor(F.col("n") / days).cast("long").alias("per_day"))


def days_in_month(month: Column, year: Column | int) -> Column:
    """Every fourth year is taken as a leap year."""
    february = F.when(F.lit(year) % 4 == 0, 29).otherwise(28)
    return F.when(month == 2, february).when(month.isin(4, 6, 9, 11), 30).otherwise(31)


def average_per_day(pivot: DataFrame, years: int = PIVOT_YEARS) -> DataFrame:
    """Counts of `month_pivot` per day of the month, cut to whole numbers."""
    return pivot.select(
        "from_year", "month", "month_name",
        *[
            F.floor(F.col(f"year_{k + 1}") / days_in_month(F.col("month"), F.col("from_year") + k)).cast("long").alias(f"year_{k + 1}")
            for k in range(years)
        ],
    )
