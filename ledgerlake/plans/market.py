"""Daily market summary."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as s
from ..functions.calendar import as_date, date_window_filter
from ..functions.scalars import DateLike
from ..operators.bitmaps import distinct_bitmaps, merged_counts
from ..operators.distinct import distinct_counts
from ..operators.history import calendar_lags, first_seen
from ..operators.top import leader, leader_count, leader_key, top_per_group
from ..schemas import GOLD_DAILY_ACTIVES, GOLD_MARKET_DAILY, conform

LAGS = (1, 7, 30)
ACTIVES = {"client_unique_cnt": "client_id", "merchant_active_cnt": "merchant_id"}
FACT_PARTITIONS = ("txn_year", "txn_month", "txn_day")


def in_window(detail: DataFrame, start: DateLike | None = None, end: DateLike | None = None) -> DataFrame:
    partitions = [c for c in FACT_PARTITIONS if c in detail.columns]
    return date_window_filter(detail, "txn_date_time", start, end, partitions)


def _by_date(detail: DataFrame, start: DateLike | None = None, end: DateLike | None = None) -> DataFrame:
    return in_window(detail, start, end).withColumn("period_date", F.to_date("txn_date_time"))


def daily_totals(detail: DataFrame, start: DateLike | None = None, end: DateLike | None = None) -> DataFrame:
    """Amounts, counts and peak hour per day.

    The fact is first combined to (day, hour), 24 rows a day at most. Totals and the busiest hour both come out of
    that small frame, so the peak costs no scan of its own.
    """
    amount = F.col("txn_amount")
    hourly = (
        _by_date(detail, start, end)
        .groupBy("period_date", "txn_hour")
        .agg(
            F.sum(amount).alias("txn_total_amt"),
            F.count(amount).alias("amounts"),
            s.sum_if(amount, amount >= 0).alias("txn_pos_amt"),
            F.count("transaction_id").alias("txn_total_cnt"),
            F.count_if(amount >= 0).alias("txn_pos_cnt"),
            F.count_if("is_fraud").alias("txn_fraud_cnt"),
            F.count_if("is_error").alias("txn_error_cnt"),
        )
    )
    measures = [c for c in hourly.columns if c not in ("period_date", "txn_hour")]
    daily = hourly.groupBy("period_date").agg(
        *(F.sum(c).alias(c) for c in measures), leader("txn_total_cnt", "txn_hour").alias("peak")
    )
    # A wider dividend would leave the quotient only six decimals.
    mean = F.col("txn_total_amt").cast("decimal(28,4)") / F.when(F.col("amounts") > 0, F.col("amounts"))
    return daily.select(
        "period_date",
        *(F.col(c).cast("decimal(28,4)").alias(c) for c in ("txn_total_amt", "txn_pos_amt")),
        s.negative_part("txn_pos_amt", "txn_total_amt").cast("decimal(28,4)").alias("txn_neg_amt"),
        # Eight decimals first, as avg() of DECIMAL(18,4) gives.
        mean.cast("decimal(22,8)").alias("txn_avg_amt"),
        *(c for c in measures if c.endswith("_cnt")),
        (F.col("amounts") - F.col("txn_pos_cnt")).alias("txn_neg_cnt"),
        leader_key("peak").alias("peak_hour"),
        leader_count("peak").alias("peak_hour_cnt"),
    )


def daily_top_category(detail: DataFrame, start: DateLike | None = None, end: DateLike | None = None) -> DataFrame:
    """Busiest merchant category per day."""
    return top_per_group(
        _by_date(detail, start, end),
        ["period_date"],
        "mcc",
        F.count("transaction_id"),
        ("merchant_top_mcc", "merchant_top_mcc_cnt"),
    )


def daily_actives(detail: DataFrame, start: DateLike | None = None, end: DateLike | None = None) -> DataFrame:
    """Exact distinct clients and merchants per day."""
    return distinct_counts(
        in_window(detail, start, end),
        {"period_date": F.to_date("txn_date_time")},
        ACTIVES,
    )


def active_bitmaps(detail: DataFrame, start: DateLike | None = None, end: DateLike | None = None) -> DataFrame:
    """Clients and merchants of each day as bitmaps, to be kept; the window must hold whole months."""
    bitmaps = distinct_bitmaps(in_window(detail, start, end), {"period_date": F.to_date("txn_date_time")}, ACTIVES)
    return conform(bitmaps, GOLD_DAILY_ACTIVES, {"year": F.year("period_date"), "month": F.month("period_date")})


def active_counts(
    kept: DataFrame, period: str | None = None, start: DateLike | None = None, end: DateLike | None = None
) -> DataFrame:
    """Exact distinct clients and merchants of each ``day``, ``month`` or ``year`` in the closed window, or over all of
    it without a period, from kept bitmaps."""
    if start is not None:
        kept = kept.where((F.col("year") * 100 + F.col("month") >= as_date(start).year * 100 + as_date(start).month) & (F.col("period_date") >= s.date_lit(start)))
    if end is not None:
        kept = kept.where((F.col("year") * 100 + F.col("month") <= as_date(end).year * 100 + as_date(end).month) & (F.col("period_date") <= s.date_lit(end)))
    group = {} if period is None else {"period_date": F.trunc("period_date", period) if period != "day" else F.col("period_date")}
    return merged_counts(kept, group, list(ACTIVES))


def new_clients(
    detail: DataFrame, start: DateLike | None = None, end: DateLike | None = None, first_dates: DataFrame | None = None
) -> DataFrame:
    """Clients per day whose first transaction ever was that day.

    ``first_dates`` is an optional kept table (``client_id``, ``first_date``) that saves reading all history.
    """
    seen = first_dates if first_dates is not None else first_seen(in_window(detail, None, end), "client_id", "txn_date_time")
    if end is not None:
        seen = seen.where(F.col("first_date") <= s.date_lit(end))
    if start is not None:
        seen = seen.where(F.col("first_date") >= s.date_lit(start))
    return (
        seen.groupBy(F.col("first_date").alias("period_date"))
        .agg(F.count("client_id").alias("client_new_cnt"))
    )


def with_lags(totals: DataFrame) -> DataFrame:
    return calendar_lags(
        totals, "period_date", LAGS, {"txn_total_amt": "prev_{}d_amt", "txn_total_cnt": "prev_{}d_cnt"}
    )


def market_daily_summary(
    detail: DataFrame,
    start: DateLike | None = None,
    end: DateLike | None = None,
    updated_at: Column | None = None,
    first_dates: DataFrame | None = None,
    wide: bool = False,
    actives: DataFrame | None = None,
) -> DataFrame:
    """One row per day with transactions in the closed window, or on any day without one; all windows in one job.

    Four scans of few columns each, instead of one wide one: every shuffle then carries only what its grouping needs.
    ``first_dates`` and ``actives`` (``active_bitmaps``) are optional kept tables that save two of them.
    """
    active = daily_actives(detail, start, end) if actives is None else active_counts(actives, "day", start, end)
    look_back = None if start is None else as_date(start) - dt.timedelta(days=max(LAGS))
    days = with_lags(daily_totals(detail, look_back, end))
    if start is not None:
        days = days.where(F.col("period_date") >= s.date_lit(start))
    joined = (
        days.join(daily_top_category(detail, start, end), "period_date", "left")
        .join(active, "period_date", "left")
        .join(new_clients(detail, start, end, first_dates), "period_date", "left")
    )
    return conform(
        joined,
        GOLD_MARKET_DAILY,
        {
            "updated_at": F.current_timestamp() if updated_at is None else updated_at,
            "year": F.year("period_date"),
            "month": F.month("period_date"),
        },
        wide,
    ).fillna(0)
