"""Bounded files: ragged and plain CSV, delimited text, and the cleaned archive."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.schemas import LEGACY_CSV_SCHEMA


def read_ragged_csv(spark: SparkSession, path: str, max_rows: int = 0) -> DataFrame:
    """CSV of pings with short or long rows, repeated headers and blank vessels; every file has its own header.

    Short rows are filled up, long ones cut, values trimmed; columns that a file lacks are NULL in its rows. A file without
    an MMSI column gives no rows, nor does one without a header. `max_rows` holds for each file.
    """
    parts = [_ragged_part(spark, names, files, max_rows) for names, files in sorted(_headers(spark, path).items()) if "MMSI" in names]
    if not parts:
        return spark.createDataFrame([], "MMSI string")
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), parts)


def _headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Files below `path` by their column names, from the first line of each."""
    place = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    lines = spark.read.text(path).select("value", *place).filter("start = 0 AND trim(value) <> ''")
    lines = lines.withColumn("line", F.monotonically_increasing_id())
    first = lines.groupBy("file").agg(F.min_by("value", "line").alias("header"))
    found: dict[tuple[str, ...], list[str]] = {}
    for row in first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).collect():
        names = [n.strip() for n in next(csv.reader([row["header"].lstrip("\ufeff")]))]
        # of equal names the last one counts
        named = tuple(n if n and n not in names[i + 1 :] else f"_unnamed{i}" for i, n in enumerate(names))
        found.setdefault(named, []).extend(row["files"])
    return found


def _ragged_part(spark: SparkSession, names: Sequence[str], files: list[str], max_rows: int) -> DataFrame:
    schema = ", ".join(f"`{n}` STRING" for n in names)
    raw = spark.read.option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE").schema(schema).csv(files)
    kept = [n for n in names if not n.startswith("_unnamed")]
    trimmed = [F.coalesce(F.trim(F.col(f"`{n}`")), F.lit("")).alias(n) for n in kept]
    if max_rows <= 0:
        return raw.select(*trimmed).filter(~F.col("MMSI").isin("", "MMSI"))
    placed = raw.select(*trimmed, F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_at"))
    within = Window.partitionBy("_file").orderBy("_at")
    rows = placed.filter(~F.col("MMSI").isin("", "MMSI")).withColumn("_rank", F.row_number().over(within))
    return rows.filter(F.col("_rank") <= max_rows).select(*kept)


def read_legacy_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.option("header", True).schema(LEGACY_CSV_SCHEMA).csv(path)


def read_day(spark: SparkSession, base: str, day: str, column: str = "date") -> DataFrame:
    """One day of a date-partitioned table; other partitions are not listed into the scan."""
    return spark.read.parquet(base).where(F.col(column) == F.lit(day).cast("date"))


def read_all(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.parquet(base)


def read_delimited(spark: SparkSession, path: str, schema: str, columns: Sequence[str], sep: str = ";") -> DataFrame:
    """Quoted, delimited text with a header line; only `columns` are read from the files."""
    return spark.read.option("header", True).option("sep", sep).option("quote", '"').schema(schema).csv(path).select(*columns)


def read_csv_columns(spark: SparkSession, paths: Sequence[str], schema: str, columns: Sequence[str]) -> DataFrame:
    """The same columns of several CSV files, as one table."""
    return spark.read.option("header", True).schema(schema).csv(list(paths)).select(*columns)


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)
