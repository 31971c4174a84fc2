"""Seconds per table, each built from stored inputs and written, as a nightly run would.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledgerlake.checks.inputs import Lake, given
from ledgerlake.checks.queries import AS_OF
from ledgerlake.plans import detail, latest, market, merchant, silver, user
from ledgerlake.schemas import TABLES, ddl
from ledgerlake.settings import configured
from ledgerlake.sinks.tables import balanced
from ledgerlake.streaming.cdc import envelope
from ledgerlake.workspace import shared_folder


def session(cpus: str) -> SparkSession:
    spark = (
        configured(SparkSession.builder.master(f"local[{cpus}]"))
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)))
    folder = shared_folder(spark)
    inputs = Lake(spark, sf_dir)

    def stored(table: str) -> DataFrame:
        columns, _ = TABLES[table]
        return spark.read.schema(ddl(columns)).parquet(f"{folder}/{table}")

    def store(df: DataFrame, table: str, partitions: list[str] | None = None) -> None:
        partitions = TABLES[table][1] if partitions is None else partitions
        writer = balanced(df, partitions).write.mode("overwrite")
        (writer.partitionBy(*partitions) if partitions else writer).parquet(f"{folder}/{table}")

    store(inputs.users, "bronze.users")
    store(inputs.cards, "bronze.cards")
    store(inputs.transactions, "bronze.transactions")
    inputs.mcc_codes.write.parquet(f"{folder}/bronze.mcc_codes")
    inputs.labels.write.parquet(f"{folder}/bronze.train_fraud_labels")

    def run(df: DataFrame) -> None:
        df.write.format("noop").mode("overwrite").save()

    # A day of the given tables holds some dozens of rows, so the fact is stored by month here.
    steps = {
        "q_silver_users": lambda: store(silver.silver_users(stored("bronze.users"), AS_OF), "silver.users"),
        "q_silver_cards": lambda: store(silver.silver_cards(stored("bronze.cards"), AS_OF), "silver.cards"),
        "q_silver_transactions": lambda: store(
            silver.silver_transactions(
                stored("bronze.transactions"), stored("silver.users"), stored("silver.cards")
            ),
            "silver.transactions",
        ),
        "q_transaction_detail": lambda: store(
            detail.transaction_detail(
                stored("silver.transactions"),
                stored("silver.users"),
                stored("silver.cards"),
                stored("bronze.mcc_codes"),
                stored("bronze.train_fraud_labels"),
            ),
            "gold.transaction_detail",
            ["txn_year", "txn_month"],
        ),
        "q_market_daily_summary": lambda: store(
            market.market_daily_summary(stored("gold.transaction_detail")), "gold.market_daily_summary"
        ),
        "q_merchant_monthly_performance": lambda: store(
            merchant.merchant_monthly_performance(stored("gold.transaction_detail")),
            "gold.merchant_monthly_performance",
        ),
        "q_user_detail": lambda: store(
            user.user_detail(stored("silver.users"), stored("gold.transaction_detail"), AS_OF), "gold.user_detail"
        ),
        "q_latest_day_summary": lambda: run(latest.latest_day_summary(stored("gold.transaction_detail"))),
        "q_cdc_envelope": lambda: run(envelope(inputs.cdc)),
    }
    given(spark, sf_dir, "events").count()

    seconds: dict[str, float] = {}
    for name, step in steps.items():
        started = time.perf_counter()
        step()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "seconds to build all tables from stored inputs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
