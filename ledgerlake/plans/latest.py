"""Summary of the latest day in the fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import date_window_filter
from ..functions.scalars import DateLike
from ..schemas import GOLD_TRANSACTION_SUMMARY, conform
from .market import FACT_PARTITIONS


def latest_day_summary(detail: DataFrame, last: DateLike | None = None) -> DataFrame:
    """Amount and count per card brand, card type and chip use on the last date of the whole fact.

    For a stored fact give ``last``, which ``tables.last_date`` takes from the list of partitions without opening a
    file: the scan is then pruned to that day. Without it, all days are summed up in one pass, and the last one is kept.
    """
    rows = detail if last is None else date_window_filter(detail, "txn_date_time", last, last, FACT_PARTITIONS)
    grouped = rows.groupBy(
        "card_brand", "card_type", "txn_use_chip", F.to_date("txn_date_time").alias("txn_date")
    ).agg(F.sum("txn_amount").alias("total_amount"), F.count("transaction_id").alias("total_txn"))
    if last is None:
        # The subquery reads the same sums, whose shuffle Spark reuses.
        grouped = grouped.where(F.col("txn_date") == grouped.select(F.max("txn_date")).scalar())
    return conform(grouped, GOLD_TRANSACTION_SUMMARY)


def create_latest_day_view(spark: SparkSession, view: str, detail_table: str) -> None:
    """The same summary as a view in the catalog, evaluated anew by every reader.

    The last day is asked of the partition columns alone. With ``spark.sql.optimizer.metadataOnly``, as ``settings`` has
    it, Spark answers that from the list of partitions; without it from file footers.
    """
    spark.sql(f"""
        CREATE OR REPLACE VIEW {view} AS
        WITH newest AS (SELECT max(make_date(txn_year, txn_month, txn_day)) AS day FROM {detail_table})
        SELECT card_brand, card_type, txn_use_chip, to_date(txn_date_time) AS txn_date,
               sum(txn_amount) AS total_amount, count(transaction_id) AS total_txn
        FROM {detail_table}
        WHERE txn_date_time >= (SELECT CAST(day AS timestamp) FROM newest)
          AND txn_year = (SELECT year(day) FROM newest)
          AND txn_month = (SELECT month(day) FROM newest)
          AND txn_day = (SELECT day(day) FROM newest)
        GROUP BY ALL
    """)
