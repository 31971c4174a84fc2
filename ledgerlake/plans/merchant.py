"""Monthly merchant performance."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as s
from ..functions.calendar import as_date
from ..functions.scalars import DateLike
from ..operators.distinct import distinct_counts
from ..operators.history import first_month_flag, previous_month_values
from ..schemas import GOLD_MERCHANT_MONTHLY, conform
from .market import in_window

PAIR = ("merchant_id", "client_id")
PREVIOUS = {
    "rev_total": "prev_rev_total",
    "rev_positive": "prev_rev_positive",
    "txn_total_cnt": "prev_txn_total_cnt",
    "txn_positive_cnt": "prev_txn_positive_cnt",
}


def _month() -> Column:
    return s.month_start("txn_date_time")


def month_before(start: DateLike) -> dt.date:
    first = as_date(start).replace(day=1)
    return first.replace(year=first.year - 1, month=12) if first.month == 1 else first.replace(month=first.month - 1)


def pairs_before(detail: DataFrame, start: DateLike) -> DataFrame:
    """(merchant, client) pairs seen before the month that precedes ``start``, with their last month.

    A table kept from run to run can take this function's place; see ``earlier`` below.
    """
    return (
        in_window(detail, None, month_before(start) - dt.timedelta(days=1))
        .groupBy(*PAIR)
        .agg(F.max(_month()).alias("period_month"))
    )


def client_months(
    detail: DataFrame, start: DateLike | None = None, end: DateLike | None = None, earlier: DataFrame | None = None
) -> DataFrame:
    """Measures per (merchant, client, month) from the month before ``start``, marked new or returning.

    Older history only tells which pairs were seen before, so it is read as pairs alone, or not at all when they are
    given as ``earlier``. Everything is combined before each shuffle; a hot merchant is spread over its clients.
    """
    amount = F.col("txn_amount")
    recent_from = None if start is None else month_before(start)
    recent = (
        in_window(detail, recent_from, end)
        .groupBy(*PAIR, _month().alias("period_month"))
        .agg(
            F.sum(amount).alias("rev_total"),
            s.sum_if(amount, amount > 0).alias("rev_positive"),
            F.count(F.lit(1)).alias("txn_total_cnt"),
            F.count_if(amount > 0).alias("txn_positive_cnt"),
            F.count_if(amount < 0).alias("txn_negative_cnt"),
            F.count_if("is_fraud").alias("fraud_txn_cnt"),
            F.count_if("is_error").alias("error_txn_cnt"),
        )
    )
    if start is None:
        return recent.withColumn("is_new", first_month_flag(recent, PAIR, "period_month", "client_id"))
    older = pairs_before(detail, start) if earlier is None else earlier
    every = recent.unionByName(older, allowMissingColumns=True)
    return every.withColumn("is_new", first_month_flag(every, PAIR, "period_month", "client_id")).where(
        F.col("period_month") >= s.date_lit(recent_from)
    )


def merchant_months(pairs: DataFrame) -> DataFrame:
    """Pair measures summed per (merchant, month). A pair without a merchant counts as neither new nor returning."""
    measures = [c for c in pairs.columns if c not in (*PAIR, "period_month", "is_new")]
    known = F.col("merchant_id").isNotNull()
    months = pairs.groupBy("merchant_id", "period_month").agg(
        *(F.sum(c).alias(c) for c in measures),
        F.count("client_id").alias("unique_client_cnt"),
        F.count_if(known & F.col("is_new")).alias("new_client_cnt"),
        F.count_if(known & ~F.col("is_new")).alias("returning_client_cnt"),
    )
    return months.withColumns(
        {
            "rev_negative": s.negative_part("rev_positive", "rev_total"),
            # Without any amount the volume is unknown, as the total is.
            "txn_total_amt": F.col("rev_positive") * 2 - F.col("rev_total"),
        }
    )


def merchant_reach(detail: DataFrame, start: DateLike | None = None, end: DateLike | None = None) -> DataFrame:
    """Exact distinct cities, states and categories per (merchant, month)."""
    return distinct_counts(
        in_window(detail, None if start is None else as_date(start).replace(day=1), end),
        {"reach_id": F.col("merchant_id"), "reach_month": _month()},
        {"active_city_cnt": "merchant_city", "active_state_cnt": "merchant_state", "active_mcc_cnt": "mcc"},
        few_combinations=True,  # a merchant has few places and categories
    )


def merchant_monthly_performance(
    detail: DataFrame,
    start: DateLike | None = None,
    end: DateLike | None = None,
    updated_at: Column | None = None,
    earlier: DataFrame | None = None,
    wide: bool = False,
) -> DataFrame:
    """One row per merchant and month with transactions, from the first of ``start``'s month, all months in one job."""
    months = previous_month_values(
        merchant_months(client_months(detail, start, end, earlier)), "merchant_id", "period_month", PREVIOUS
    )
    if start is not None:
        months = months.where(F.col("period_month") >= s.date_lit(as_date(start).replace(day=1)))
    reach = merchant_reach(detail, start, end)
    joined = months.join(
        reach,
        F.col("merchant_id").eqNullSafe(F.col("reach_id")) & (F.col("period_month") == F.col("reach_month")),
        "left",
    )
    return conform(
        joined,
        GOLD_MERCHANT_MONTHLY,
        {
            "updated_at": F.current_timestamp() if updated_at is None else updated_at,
            "year": F.year("period_month"),
            "month": F.month("period_month"),
        },
        wide,
    ).fillna(0)
