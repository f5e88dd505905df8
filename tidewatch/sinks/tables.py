"""Writers of date-partitioned tables that give the same result when a run is repeated."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_RECORDS_PER_FILE = 1_000_000


def replace_day(rows: DataFrame, base: str, day: str, column: str = "kpi_date") -> None:
    """Make `rows` the whole content of one day; an empty result leaves an empty day."""
    (
        rows.filter(F.col(column) == F.lit(day).cast("date"))
        .drop(column)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .parquet(f"{base}/{column}={day}")
    )


def replace_days(rows: DataFrame, base: str, days: Iterable[str], column: str = "kpi_date") -> None:
    """Replace several days; days that are listed but have no rows become empty."""
    for day in days:
        replace_day(rows, base, day, column)


def overwrite_by_date(rows: DataFrame, base: str, column: str = "date") -> None:
    """Replace a whole table, one directory per date; a large date is written by several tasks."""
    (
        rows.hint("rebalance", column)
        .write.mode("overwrite")
        .partitionBy(column)
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .parquet(base)
    )


def write_batch(rows: DataFrame, base: str, batch_id: int, by: str | None = None, max_records: int = MAX_RECORDS_PER_FILE) -> None:
    """Store a micro-batch under its own id; a repeated batch replaces itself instead of doubling."""
    layout = [by, "batch_id"] if by else ["batch_id"]
    (
        rows.withColumn("batch_id", F.lit(batch_id).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_records)
        .partitionBy(*layout)
        .parquet(base)
    )


def read_batches(spark: SparkSession, base: str) -> DataFrame | None:
    """All batches that `write_batch` stored; None where none had a row."""
    path = spark._jvm.org.apache.hadoop.fs.Path(base)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    has_rows = files.exists(path) and any(s.isDirectory() and "=" in s.getPath().getName() for s in files.listStatus(path))
    return spark.read.parquet(base) if has_rows else None


def write_dwell(rows: DataFrame, base: str) -> None:
    """Port visits laid out by voyage date and port."""
    laid_out = rows.withColumn("voyage_date", F.col("kpi_date")).withColumn("port", F.col("port_id"))
    laid_out.hint("rebalance", "voyage_date", "port").write.mode("overwrite").partitionBy("voyage_date", "port").parquet(base)


def save_model(model: PipelineModel, base: str, day: str) -> str:
    """Keep the day's model, scaler included."""
    path = f"{base}/date={day}"
    model.write().overwrite().save(path)
    return path


def load_model(base: str, day: str) -> PipelineModel:
    """The model kept for a day."""
    return PipelineModel.load(f"{base}/date={day}")


def jdbc_append(rows: DataFrame, url: str, table: str, properties: Mapping[str, str]) -> None:
    """Append to a database table. Needs the database's JDBC driver."""
    rows.write.format("jdbc").option("url", url).option("dbtable", table).options(**properties).mode("append").save()


def delta_append(rows: DataFrame, base: str, by: str = "date") -> None:
    """Append to a Delta table. Needs the Delta connector."""
    rows.write.format("delta").mode("append").partitionBy(by).save(base)


def console_sample(rows: DataFrame, n: int = 20) -> DataFrame:
    """The first rows without source columns, for a look at the result."""
    return rows.drop("kafka_partition", "kafka_offset", "kafka_timestamp", "date").limit(n)
