"""Change-data-capture topics. Needs the Kafka connector package on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_topic(spark: SparkSession, servers: str, topic: str, offsets: str = "earliest") -> DataFrame:
    """Streaming frame with ``key, value, offset, timestamp`` and the connector's other columns."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", offsets)
        .load()
    )
