"""Wide fact: one row per transaction with its user, card, category and fraud label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as s
from ..functions.calendar import date_window_filter
from ..functions.scalars import DateLike
from ..schemas import GOLD_TRANSACTION_DETAIL, conform


def transaction_detail(
    transactions: DataFrame,
    users: DataFrame,
    cards: DataFrame,
    mcc_codes: DataFrame,
    labels: DataFrame,
    start: DateLike | None = None,
    end: DateLike | None = None,
    created_at: Column | None = None,
    fraud_token: str = s.FRAUD_TOKEN,
    wide: bool = False,
) -> DataFrame:
    """Silver transactions of a date window joined to the dimension versions they refer to.

    Four left joins, no hints: Spark broadcasts a dimension only when its measured size is below the session's
    threshold, and otherwise splits the hot keys of the sort-merge join. All four keep a row without a match.
    """
    rows = date_window_filter(transactions, "date_time", start, end, ("year", "month"))
    codes = mcc_codes.select(F.col("mcc_code").alias("mcc"), F.col("description").alias("mcc_description"))
    marks = labels.select("transaction_id", F.col("is_fraud").alias("fraud_label"))
    clients = users.select(
        "client_id",
        "client_key",
        "birth_year",
        F.col("latitude").alias("client_latitude"),
        F.col("longitude").alias("client_longitude"),
        F.col("credit_score").alias("client_credit_score"),
        F.col("num_credit_cards").alias("client_num_credit_cards"),
    )
    plastic = cards.select(
        "card_id",
        "card_key",
        "card_brand",
        "card_type",
        F.col("acct_open_year").alias("card_open_year"),
        F.col("expires_year").alias("card_expires_year"),
        F.col("credit_limit").alias("card_credit_limit"),
        F.col("card_on_dark_web").alias("dark_web_text"),
    )
    joined = (
        rows.join(codes, "mcc", "left")
        .join(marks, "transaction_id", "left")
        .join(clients, ["client_id", "client_key"], "left")
        .join(plastic, ["card_id", "card_key"], "left")
    )
    return conform(
        joined,
        GOLD_TRANSACTION_DETAIL,
        {
            "client_age": s.age_at(F.col("date_time"), "birth_year"),
            "card_on_dark_web": s.dark_web_flag("dark_web_text"),
            "txn_amount": F.col("amount"),
            "txn_spending_ratio": s.spending_ratio("amount", "card_credit_limit"),
            "txn_use_chip": F.col("use_chip"),
            "txn_date_time": F.col("date_time"),
            "txn_hour": F.hour("date_time"),
            "merchant_zip": F.col("zip"),
            "is_fraud": s.fraud_flag("fraud_label", fraud_token),
            "created_at": F.current_timestamp() if created_at is None else created_at,
            "txn_year": F.year("date_time"),
            "txn_month": F.month("date_time"),
            "txn_day": F.dayofmonth("date_time"),
        },
        wide,
    )
