"""Raw pings as messages: Kafka topics, and files that replay one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.schemas import ENVELOPE_SCHEMA, RAW_FIELDS

RAW_TOPIC = "raw_ais_positions"
ALERT_TOPIC = "vessel_speed_alerts"
MAX_OFFSETS = 500_000


def kafka_stream(spark: SparkSession, servers: str, topic: str = RAW_TOPIC, max_offsets: int = MAX_OFFSETS) -> DataFrame:
    """The topic from its start, at most `max_offsets` messages per batch. Needs the Kafka connector."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", str(max_offsets))
        .option("failOnDataLoss", "false")
        .load()
    )


def kafka_batch(spark: SparkSession, servers: str, topic: str = RAW_TOPIC) -> DataFrame:
    """All messages the topic holds now. Needs the Kafka connector."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("endingOffsets", "latest")
        .load()
    )


def replay_stream(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    """Message files as a stream with the columns of the Kafka source."""
    return (
        spark.readStream.schema(ENVELOPE_SCHEMA).option("maxFilesPerTrigger", str(max_files)).parquet(path)
    )


def replay_batch(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ENVELOPE_SCHEMA).parquet(path)


def to_messages(rows: DataFrame) -> DataFrame:
    """`key` = MMSI and `value` = all columns as JSON.

    Missing values of the known fields are written as empty text; other columns that a row does not have are left out.
    """
    text = {c: F.col(f"`{c}`").cast("string") for c in rows.columns}
    fields = [(F.coalesce(v, F.lit("")) if c in RAW_FIELDS else v).alias(c) for c, v in text.items()]
    return rows.select(F.col("MMSI").cast("string").alias("key"), F.to_json(F.struct(*fields)).alias("value"))
