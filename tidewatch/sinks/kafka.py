"""Messages to Kafka topics. Needs the Kafka connector."""

from __future__ import annotations

from pyspark.sql import DataFrame


def publish(messages: DataFrame, servers: str, topic: str) -> None:
    """Write `key` and `value` columns to a topic, lz4-compressed."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.compression.type", "lz4")
        .option("topic", topic)
        .save()
    )
