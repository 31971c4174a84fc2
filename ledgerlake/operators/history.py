"""Comparisons with earlier periods, without reading the fact again."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import previous_month


def calendar_lags(daily: DataFrame, date: str, lags: Sequence[int], values: Mapping[str, str]) -> DataFrame:
    """Values of the day exactly k days earlier (NULL if that day has no row), as ``values[k]`` style columns.

    ``values`` maps an input column to a name pattern such as ``prev_{}d_amt``. Each day is sent forward to the
    days that look back at it, so one grouping replaces a self-join per lag and the input is evaluated once.
    """
    carried = [c for c in daily.columns if c != date]
    shifted = daily.select(
        F.explode(F.array(*(F.lit(k) for k in (0, *lags)))).alias("_lag"),
        F.col(date).alias("_from"),
        F.struct(*carried).alias("_day"),
    ).select(F.date_add("_from", F.col("_lag")).alias(date), "_lag", "_day")
    own = F.first(F.when(F.col("_lag") == 0, F.col("_day")), ignorenulls=True).alias("_own")
    earlier = [
        F.max(F.when(F.col("_lag") == k, F.col("_day").getField(value))).alias(pattern.format(k))
        for k in lags
        for value, pattern in values.items()
    ]
    return (
        shifted.groupBy(date)
        .agg(own, *earlier)
        .where("_own IS NOT NULL")
        .select(date, "_own.*", *(pattern.format(k) for k in lags for pattern in values.values()))
    )


def previous_month_values(monthly: DataFrame, key: str, month: str, values: Mapping[str, str]) -> DataFrame:
    """Values of the same key in the calendar month before (NULL if it has no row, or if the key is NULL).

    A key has one row per month, so its window stays as short as the calendar.
    """
    order = Window.partitionBy(key).orderBy(month)
    adjacent = F.col(key).isNotNull() & (F.lag(month).over(order) == previous_month(month))
    return monthly.select("*", *(F.when(adjacent, F.lag(v).over(order)).alias(name) for v, name in values.items()))


def first_month_flag(pairs: DataFrame, pair: Sequence[str], month: str, matched: str) -> Column:
    """Whether a (pair, month) row is the first month of the pair; a pair with NULL ``matched`` is always new.

    The pair has one row per month, so its window stays as short as the calendar.
    """
    before = F.lag(month).over(Window.partitionBy(*pair).orderBy(month))
    return F.col(matched).isNull() | before.isNull()


def first_seen(df: DataFrame, key: str, moment: str) -> DataFrame:
    """First date per key; the NULL key is a key of its own."""
    return df.groupBy(key).agg(F.min(F.to_date(moment)).alias("first_date"))
