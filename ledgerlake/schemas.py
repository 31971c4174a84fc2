"""Declared schema of every table, and the projection onto it.

A table is a mapping ``column -> Spark SQL type`` in column order. Partition columns are part of the mapping and
always stand last, because ``insertInto`` matches by position and Spark puts partition columns at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Column names, types and order of all tables are their contract.

# ------------------------------------------------------------------ source (typed, before ingestion)

SOURCE_USERS = {
    "id": "int",
    "current_age": "int",
    "retirement_age": "int",
    "birth_year": "int",
    "birth_month": "int",
    "gender": "string",
    "address": "string",
    "latitude": "decimal(9,6)",
    "longitude": "decimal(9,6)",
    "per_capita_income": "string",
    "yearly_income": "string",
    "total_debt": "string",
    "credit_score": "int",
    "num_credit_cards": "int",
}

SOURCE_CARDS = {
    "id": "int",
    "client_id": "int",
    "card_brand": "string",
    "card_type": "string",
    "card_number": "string",
    "expires": "string",
    "CVV": "string",
    "has_chip": "string",
    "num_cards_issued": "int",
    "credit_limit": "string",
    "acct_open_date": "string",
    "year_pin_last_changed": "int",
    "card_on_dark_web": "string",
}

# Column order of the transactions CSV file; every column is staged as text first.
STAGED_TRANSACTIONS = {
    "id": "string",
    "date_time": "string",
    "client_id": "string",
    "card_id": "string",
    "amount": "string",
    "use_chip": "string",
    "merchant_id": "string",
    "merchant_city": "string",
    "merchant_state": "string",
    "zip": "string",
    "mcc": "string",
    "errors": "string",
}

SOURCE_TRANSACTIONS = {
    "id": "int",
    "date_time": "timestamp",
    "date": "date",
    "client_id": "int",
    "card_id": "int",
    "amount": "string",
    "use_chip": "string",
    "merchant_id": "int",
    "merchant_city": "string",
    "merchant_state": "string",
    "zip": "string",
    "mcc": "int",
    "errors": "string",
}

# ------------------------------------------------------------------ bronze

BRONZE_USERS = SOURCE_USERS | {"load_at": "timestamp"}
BRONZE_CARDS = SOURCE_CARDS | {"load_at": "timestamp"}
BRONZE_TRANSACTIONS = {name: kind for name, kind in SOURCE_TRANSACTIONS.items() if name != "date"} | {
    "load_at": "timestamp",
    "date_partition": "string",
}
BRONZE_MCC_CODES = {"mcc_code": "int", "description": "string", "file_name": "string", "load_at": "timestamp"}
BRONZE_FRAUD_LABELS = {"transaction_id": "int", "is_fraud": "string", "file_name": "string", "load_at": "timestamp"}
BRONZE_CDC = {
    "kafka_key": "string",
    "kafka_offset": "bigint",
    "kafka_timestamp": "timestamp",
    "cdc_payload": "string",
    "operation": "string",
    "cdc_timestamp": "bigint",
    "ingestion_time": "timestamp",
    "ingestion_date": "string",
}

# ------------------------------------------------------------------ silver

# Raw versions as loads left them. Laid out by the day a version was closed ('open' if it wasn't) and a bucket of its key,
# so that a load rewrites only what it can change.
_VERSION = {
    "valid_from": "timestamp",
    "valid_to": "timestamp",
    "is_current": "boolean",
    "version_key": "bigint",
    "closed": "string",
    "key_bucket": "int",
}
SILVER_USER_VERSIONS = BRONZE_USERS | _VERSION
SILVER_CARD_VERSIONS = BRONZE_CARDS | _VERSION

SILVER_USERS = {
    "client_key": "bigint",
    "client_id": "int",
    "current_age": "int",
    "retirement_age": "int",
    "birth_year": "int",
    "birth_month": "int",
    "age_group": "string",
    "gender": "string",
    "address": "string",
    "latitude": "decimal(9,6)",
    "longitude": "decimal(9,6)",
    "per_capita_income": "decimal(15,2)",
    "yearly_income": "decimal(15,2)",
    "income_group": "string",
    "total_debt": "decimal(15,2)",
    "credit_score": "int",
    "num_credit_cards": "int",
    "valid_from": "timestamp",
    "valid_to": "timestamp",
    "is_current": "boolean",
}

SILVER_CARDS = {
    "card_key": "bigint",
    "card_id": "int",
    "client_id": "int",
    "card_brand": "string",
    "card_type": "string",
    "expires_date": "string",
    "expires_year": "int",
    "expires_month": "int",
    "is_expires": "boolean",
    "has_chip": "boolean",
    "num_cards_issued": "int",
    "credit_limit": "decimal(12,2)",
    "acct_open_date": "string",
    "acct_open_year": "int",
    "acct_open_month": "int",
    "year_pin_last_changed": "int",
    "card_on_dark_web": "string",
    "valid_from": "timestamp",
    "valid_to": "timestamp",
    "is_current": "boolean",
}

SILVER_TRANSACTIONS = {
    "transaction_id": "int",
    "client_id": "int",
    "client_key": "bigint",
    "card_id": "int",
    "card_key": "bigint",
    "date_time": "timestamp",
    "day": "int",
    "hour": "int",
    "amount": "decimal(18,4)",
    "use_chip": "boolean",
    "merchant_id": "int",
    "merchant_city": "string",
    "merchant_state": "string",
    "zip": "string",
    "mcc": "int",
    "errors": "string",
    "is_error": "boolean",
    "updated_at": "timestamp",
    "year": "int",
    "month": "int",
}

# ------------------------------------------------------------------ gold

GOLD_TRANSACTION_DETAIL = {
    "transaction_id": "bigint",
    "client_key": "bigint",
    "client_id": "int",
    "client_age": "int",
    "client_latitude": "decimal(9,6)",
    "client_longitude": "decimal(9,6)",
    "client_credit_score": "int",
    "client_num_credit_cards": "int",
    "card_key": "bigint",
    "card_id": "int",
    "card_brand": "string",
    "card_type": "string",
    "card_open_year": "int",
    "card_expires_year": "int",
    "card_credit_limit": "decimal(12,2)",
    "card_on_dark_web": "boolean",
    "txn_amount": "decimal(18,4)",
    "txn_spending_ratio": "decimal(10,4)",
    "txn_use_chip": "boolean",
    "txn_date_time": "timestamp",
    "txn_hour": "int",
    "merchant_id": "int",
    "merchant_city": "string",
    "merchant_state": "string",
    "merchant_zip": "string",
    "mcc": "int",
    "mcc_description": "string",
    "is_error": "boolean",
    "is_fraud": "boolean",
    "created_at": "timestamp",
    "txn_year": "int",
    "txn_month": "int",
    "txn_day": "int",
}

GOLD_MARKET_DAILY = {
    "period_date": "date",
    "txn_total_amt": "decimal(20,2)",
    "txn_pos_amt": "decimal(20,2)",
    "txn_neg_amt": "decimal(20,2)",
    "txn_avg_amt": "decimal(12,2)",
    "txn_total_cnt": "int",
    "txn_pos_cnt": "int",
    "txn_neg_cnt": "int",
    "txn_fraud_cnt": "int",
    "txn_error_cnt": "int",
    "prev_1d_amt": "decimal(20,2)",
    "prev_7d_amt": "decimal(20,2)",
    "prev_30d_amt": "decimal(20,2)",
    "prev_1d_cnt": "int",
    "prev_7d_cnt": "int",
    "prev_30d_cnt": "int",
    "client_unique_cnt": "int",
    "client_new_cnt": "int",
    "merchant_active_cnt": "int",
    "merchant_top_mcc": "int",
    "merchant_top_mcc_cnt": "int",
    "peak_hour": "int",
    "peak_hour_cnt": "int",
    "updated_at": "timestamp",
    "year": "int",
    "month": "int",
}

GOLD_MERCHANT_MONTHLY = {
    "merchant_id": "int",
    "period_month": "date",
    "active_city_cnt": "int",
    "active_state_cnt": "int",
    "active_mcc_cnt": "int",
    "rev_total": "decimal(18,2)",
    "rev_positive": "decimal(18,2)",
    "rev_negative": "decimal(18,2)",
    "prev_rev_total": "decimal(18,2)",
    "prev_rev_positive": "decimal(18,2)",
    "txn_total_amt": "decimal(18,2)",
    "txn_total_cnt": "int",
    "txn_positive_cnt": "int",
    "txn_negative_cnt": "int",
    "prev_txn_total_cnt": "int",
    "prev_txn_positive_cnt": "int",
    "fraud_txn_cnt": "int",
    "error_txn_cnt": "int",
    "unique_client_cnt": "int",
    "new_client_cnt": "int",
    "returning_client_cnt": "int",
    "updated_at": "timestamp",
    "year": "int",
    "month": "int",
}

GOLD_USER_DETAIL = {
    "client_id": "int",
    "client_key": "bigint",
    "age_current": "int",
    "age_retired": "int",
    "birth_year": "int",
    "birth_month": "int",
    "gender": "string",
    "income_per_capita": "int",
    "income_yearly": "int",
    "debt_total": "int",
    "credit_score": "int",
    "total_txn_amt": "decimal(18,2)",
    "total_pos_amt": "decimal(18,2)",
    "total_neg_amt": "decimal(18,2)",
    "total_txn": "int",
    "total_txn_pos": "int",
    "total_txn_neg": "int",
    "total_txn_fraud": "int",
    "total_txn_error": "int",
    "lifetime_first_date": "date",
    "lifetime_last_date": "date",
    "lifetime_days": "int",
    "merchant_unique_cnt": "int",
    "merchant_top_id": "int",
    "merchant_top_txn_cnt": "int",
    "mcc_unique_cnt": "int",
    "city_unique_cnt": "int",
    "state_unique_cnt": "int",
    "updated_at": "timestamp",
}

# Who was seen in which month of the fact; what comparisons with all history read instead of it.
GOLD_CLIENT_MONTHS = {
    "client_id": "int",
    "first_date": "date",
    "year": "int",
    "month": "int",
}

GOLD_MERCHANT_CLIENT_MONTHS = {
    "merchant_id": "int",
    "client_id": "int",
    "period_month": "date",
    "year": "int",
    "month": "int",
}

# Which clients and merchants were active on which day, as bitmaps that can be merged to any period.
GOLD_DAILY_ACTIVES = {
    "period_date": "date",
    "measure": "string",
    "bucket": "bigint",
    "bits": "binary",
    "year": "int",
    "month": "int",
}

GOLD_RUN_LEDGER = {
    "job": "string",
    "window_start": "date",
    "window_end": "date",
    "state": "string",
    "row_count": "bigint",
    "message": "string",
    "recorded_at": "timestamp",
}

GOLD_TRANSACTION_SUMMARY = {
    "card_brand": "string",
    "card_type": "string",
    "txn_use_chip": "boolean",
    "txn_date": "date",
    "total_amount": "decimal(28,4)",
    "total_txn": "bigint",
}

# name -> (columns, partition columns)
TABLES: dict[str, tuple[dict[str, str], list[str]]] = {
    "bronze.users": (BRONZE_USERS, []),
    "bronze.cards": (BRONZE_CARDS, []),
    "bronze.transactions": (BRONZE_TRANSACTIONS, ["date_partition"]),
    "bronze.mcc_codes": (BRONZE_MCC_CODES, []),
    "bronze.train_fraud_labels": (BRONZE_FRAUD_LABELS, []),
    "bronze.cdc_users": (BRONZE_CDC, ["ingestion_date"]),
    "bronze.cdc_cards": (BRONZE_CDC, ["ingestion_date"]),
    "bronze.cdc_transactions": (BRONZE_CDC, ["ingestion_date"]),
    "silver.user_versions": (SILVER_USER_VERSIONS, ["closed", "key_bucket"]),
    "silver.card_versions": (SILVER_CARD_VERSIONS, ["closed", "key_bucket"]),
    "silver.users": (SILVER_USERS, []),
    "silver.cards": (SILVER_CARDS, []),
    "silver.transactions": (SILVER_TRANSACTIONS, ["year", "month"]),
    "gold.transaction_detail": (GOLD_TRANSACTION_DETAIL, ["txn_year", "txn_month", "txn_day"]),
    "gold.market_daily_summary": (GOLD_MARKET_DAILY, ["year", "month"]),
    "gold.merchant_monthly_performance": (GOLD_MERCHANT_MONTHLY, ["year", "month"]),
    "gold.user_detail": (GOLD_USER_DETAIL, []),
    "gold.daily_actives": (GOLD_DAILY_ACTIVES, ["year", "month"]),
    "gold.run_ledger": (GOLD_RUN_LEDGER, []),
    "gold.client_months": (GOLD_CLIENT_MONTHS, ["year", "month"]),
    "gold.merchant_client_months": (GOLD_MERCHANT_CLIENT_MONTHS, ["year", "month"]),
}

# Column by which a table is bucketed, so that joins on it need no exchange. None of them has a hot value.
BUCKETED_BY: dict[str, str] = {
    "bronze.transactions": "id",
    "bronze.train_fraud_labels": "transaction_id",
    "silver.transactions": "transaction_id",
}


def ddl(columns: dict[str, str]) -> str:
    """Schema text for ``spark.read.schema`` and ``CREATE TABLE``."""
    return ", ".join(f"`{name}` {kind}" for name, kind in columns.items())


def is_count(name: str) -> bool:
    return name.endswith("_cnt") or name.startswith("total_txn") and not name.endswith("_amt")


def is_id(name: str) -> bool:
    return name == "id" or name.endswith("_id")


def widened(columns: dict[str, str]) -> dict[str, str]:
    """The same table with 64-bit ids and counts, for more than two billion rows.

    The declared 32-bit ones are kept by default; a larger value then stops the job instead of wrapping around.
    """
    return {name: "bigint" if kind == "int" and (is_count(name) or is_id(name)) else kind for name, kind in columns.items()}


def table_columns(table: str, wide: bool = False) -> dict[str, str]:
    return widened(TABLES[table][0]) if wide else TABLES[table][0]


def conform(
    df: DataFrame, columns: dict[str, str], sources: dict[str, Column] | None = None, wide: bool = False
) -> DataFrame:
    """Rename, reorder and cast in one projection: ``columns`` of ``df``, or of ``sources`` where given."""
    sources = sources or {}
    columns = widened(columns) if wide else columns
    return df.select(
        *(
            sources[name].cast(kind).alias(name) if name in sources else F.expr(f"CAST(`{name}` AS {kind}) AS `{name}`")
            for name, kind in columns.items()
        )
    )
