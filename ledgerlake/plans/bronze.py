"""Raw layer: source rows as they are, stamped with their load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import (
    BRONZE_CARDS,
    BRONZE_FRAUD_LABELS,
    BRONZE_MCC_CODES,
    BRONZE_TRANSACTIONS,
    BRONZE_USERS,
    conform,
    widened,
)
from ..sources.files import read_flat_label_object, read_json_lines, read_json_object

COLUMNS = {"users": BRONZE_USERS, "cards": BRONZE_CARDS, "transactions": BRONZE_TRANSACTIONS}


def ingest_table(source: DataFrame, table: str, load_at: Column | None = None, wide: bool = False) -> DataFrame:
    """Stamp a source table (``users``, ``cards`` or ``transactions``) with its load time.

    Transactions also get the month they are partitioned by.
    """
    stamped = source.withColumn("load_at", F.current_timestamp() if load_at is None else load_at)
    if table == "transactions":
        stamped = stamped.withColumn("date_partition", F.date_format("date", "yyyy-MM"))
    return conform(stamped, COLUMNS[table], wide=wide)


def _lineage(rows: DataFrame, columns: dict[str, str], load_at: Column | None, wide: bool = False) -> DataFrame:
    return conform(rows.withColumn("load_at", F.current_timestamp() if load_at is None else load_at), columns, wide=wide)


def ingest_mcc(spark: SparkSession, path: str, load_at: Column | None = None) -> DataFrame:
    """Merchant category codes from a JSON object ``{"<code>": "<description>"}``."""
    rows = read_json_object(spark, path)
    return _lineage(
        rows.select(F.col("key").alias("mcc_code"), F.col("value").alias("description"), "file_name"),
        BRONZE_MCC_CODES,
        load_at,
    )


def ingest_labels(
    spark: SparkSession, path: str, load_at: Column | None = None, layout: str = "flat", wide: bool = False
) -> DataFrame:
    """Fraud labels from ``{"target": {"<transaction id>": "<label>"}}``.

    ``flat`` cuts the object between entries, for files too large for one task; ``object`` takes any JSON layout but
    one task per file; ``lines`` reads JSON Lines with the two bronze columns.
    """
    if layout == "lines":
        declared = widened(BRONZE_FRAUD_LABELS) if wide else BRONZE_FRAUD_LABELS
        columns = {name: declared[name] for name in ("transaction_id", "is_fraud")}
        rows = read_json_lines(spark, path, columns).select("*", F.col("_metadata.file_name").alias("file_name"))
        return _lineage(rows, BRONZE_FRAUD_LABELS, load_at, wide)
    read = {"flat": read_flat_label_object, "object": read_json_object}[layout]
    rows = read(spark, path, "target")
    return _lineage(
        rows.select(F.col("key").alias("transaction_id"), F.col("value").alias("is_fraud"), "file_name"),
        BRONZE_FRAUD_LABELS,
        load_at,
        wide,
    )
