"""Session settings the tables are designed for. Nothing here is applied unless asked for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Hours and dates of a TIMESTAMP depend on the session zone.
    "spark.sql.session.timeZone": "UTC",
    # Splits hot keys of joins, sizes shuffles, turns joins around once sizes are measured.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hash instead of sort-merge join when every measured partition of the small side is below this; saves sorting
    # the wide fact.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "128MB",
    # The last day of a fact comes from its list of partitions. The sinks here leave no partition without rows.
    "spark.sql.optimizer.metadataOnly": "true",
    # Sizes that `tables.measure` stored count when Spark chooses joins.
    "spark.sql.cbo.enabled": "true",
}


SHUFFLE_BYTES_PER_TASK = 1024**3
MOST_PARTITIONS = 50_000


def initial_partitions(shuffled_bytes: int, least: int = 200) -> int:
    """Shuffle partitions to start from; adaptive execution merges those that turn out small.

    The size is that of the columns which reach the shuffle. The driver keeps a status for each pair of a map and a
    reduce task, so there are no more than ``MOST_PARTITIONS``; build longer ranges window by window.
    """
    return min(MOST_PARTITIONS, max(least, -(-shuffled_bytes // SHUFFLE_BYTES_PER_TASK)))


def configured(builder: SparkSession.Builder, shuffled_bytes: int | None = None) -> SparkSession.Builder:
    """Apply the settings; with the size of the largest shuffle, shuffles are cut finely enough for it.

    The default of 200 partitions would mean hundreds of gigabytes per task when the whole fact is joined.
    """
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    if shuffled_bytes is not None:
        name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
        builder = builder.config(name, str(initial_partitions(shuffled_bytes)))
    return builder
