"""Lifetime summary per current user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as s
from ..functions.scalars import DateLike
from ..operators.distinct import distinct_counts
from ..operators.top import leader, leader_count, leader_key
from ..schemas import GOLD_USER_DETAIL, conform, is_count


def user_totals(detail: DataFrame) -> DataFrame:
    """Lifetime measures and top merchant per client, by way of (client, merchant).

    Both groupings combine before their shuffle, so a hot client is never gathered row by row.
    """
    amount = F.col("txn_amount")
    date = F.to_date("txn_date_time")
    per_merchant = detail.groupBy("client_id", "merchant_id").agg(
        F.sum(amount).alias("total_txn_amt"),
        s.sum_if(amount, amount > 0).alias("total_pos_amt"),
        F.count(F.lit(1)).alias("total_txn"),
        F.count_if(amount > 0).alias("total_txn_pos"),
        F.count_if(amount < 0).alias("total_txn_neg"),
        F.count_if("is_fraud").alias("total_txn_fraud"),
        F.count_if("is_error").alias("total_txn_error"),
        F.min(date).alias("lifetime_first_date"),
        F.max(date).alias("lifetime_last_date"),
    )
    sums = [c for c in per_merchant.columns if c.startswith("total_")]
    return (
        per_merchant.groupBy("client_id")
        .agg(
            *(F.sum(c).alias(c) for c in sums),
            F.min("lifetime_first_date").alias("lifetime_first_date"),
            F.max("lifetime_last_date").alias("lifetime_last_date"),
            F.count("merchant_id").alias("merchant_unique_cnt"),
            leader("total_txn", "merchant_id").alias("top"),
        )
        .withColumns(
            {
                "total_neg_amt": s.negative_part("total_pos_amt", "total_txn_amt"),
                "merchant_top_id": leader_key("top"),
                "merchant_top_txn_cnt": leader_count("top"),
            }
        )
        .drop("top")
    )


def user_reach(detail: DataFrame) -> DataFrame:
    """Exact distinct categories, cities and states per client."""
    return distinct_counts(
        detail,
        {"client_id": F.col("client_id")},
        {"mcc_unique_cnt": "mcc", "city_unique_cnt": "merchant_city", "state_unique_cnt": "merchant_state"},
    )


def user_detail(
    users: DataFrame,
    detail: DataFrame,
    as_of: DateLike,
    updated_at: Column | None = None,
    wide: bool = False,
) -> DataFrame:
    """One row per current user, with zeros and NULL dates for a user without transactions."""
    joined = (
        users.where("is_current")
        .join(user_totals(detail), "client_id", "left")
        .join(user_reach(detail), "client_id", "left")
    )
    shaped = conform(
        joined,
        GOLD_USER_DETAIL,
        {
            "age_current": s.age_at(as_of, "birth_year"),
            "age_retired": F.col("retirement_age"),
            "income_per_capita": s.whole_units("per_capita_income"),
            "income_yearly": s.whole_units("yearly_income"),
            "debt_total": s.whole_units("total_debt"),
            "lifetime_days": F.datediff("lifetime_last_date", "lifetime_first_date"),
            "updated_at": F.current_timestamp() if updated_at is None else updated_at,
        },
        wide,
    )
    zeroed = [c for c in GOLD_USER_DETAIL if is_count(c) or c.startswith("total_")] + ["lifetime_days", "merchant_top_id"]
    return shaped.fillna(0, subset=zeroed)
