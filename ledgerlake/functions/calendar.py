"""Date windows as data, and date filters that reach the scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scalars import DateLike, col, date_lit


def as_date(value: DateLike) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def fixed_windows(bounds: DataFrame, days: int) -> DataFrame:
    """Closed windows of ``days`` days over each ``start_date``..``end_date`` row; the last is cut at the end."""
    starts = F.sequence("start_date", "end_date", F.make_dt_interval(F.lit(days)))
    return (
        bounds.where("start_date <= end_date")
        .select(F.explode(starts).alias("window_start"), "end_date")
        .select(
            "window_start",
            F.least(F.date_add("window_start", days - 1), "end_date").alias("window_end"),
        )
    )


def month_windows(bounds: DataFrame) -> DataFrame:
    """Calendar months touching ``start_date``..``end_date``: from the first of the month, last one cut at the end."""
    starts = F.sequence(F.trunc("start_date", "month"), F.col("end_date"), F.make_ym_interval(months=F.lit(1)))
    return (
        bounds.where("start_date <= end_date")
        .select(F.explode(starts).alias("window_start"), "end_date")
        .select("window_start", F.least(F.last_day("window_start"), "end_date").alias("window_end"))
    )


def window_start_of(date: Column, start: DateLike | Column, days: int) -> Column:
    """First day of the fixed window a date falls into, by arithmetic instead of a range join."""
    first = date_lit(start)
    index = F.floor(F.datediff(date, first) / F.lit(days)).cast("int")
    return F.date_add(first, index * days)


def previous_month(month: Column | str) -> Column:
    return F.add_months(col(month), -1)


def date_window_filter(
    df: DataFrame,
    moment: str,
    start: DateLike | None,
    end: DateLike | None,
    partitions: Sequence[str] = (),
) -> DataFrame:
    """Rows whose date lies in the closed range; ``start`` None means since ever, ``end`` None without a last day.

    Without either bound every row stays, also one without a date.

    The date comparison on the timestamp becomes a pushed Parquet range. When the table is laid out by
    (year, month[, day]) of that timestamp, naming those columns also prunes whole partitions.
    """
    day = F.to_date(moment)
    if end is not None:
        last = as_date(end)
        df = df.where(day <= date_lit(last))
        for place, of in _places(partitions):
            df = df.where(place <= of(last))
    if start is not None:
        first = as_date(start)
        df = df.where(day >= date_lit(first))
        for place, of in _places(partitions):
            df = df.where(place >= of(first))
    return df


def _places(partitions: Sequence[str]) -> list[tuple[Column, Callable[[dt.date], int]]]:
    """(year), (year, month) and (year, month, day) as single numbers, as far as the columns go.

    The year alone is a bound that every catalog understands; the others prune on the file index. One that is not a
    partition column of the stored table only filters rows.
    """
    year, month, day = (*(F.col(c) for c in partitions), None, None, None)[:3]
    places: list[tuple[Column, Callable[[dt.date], int]]] = []
    if year is not None:
        places.append((year, lambda d: d.year))
    if month is not None:
        places.append((year * 100 + month, lambda d: d.year * 100 + d.month))
    if day is not None:
        places.append((year * 10000 + month * 100 + day, lambda d: d.year * 10000 + d.month * 100 + d.day))
    return places


def widen_to_months(start: DateLike, end: DateLike) -> tuple[dt.date, dt.date]:
    """Smallest whole-month range around a window, for rewriting month partitions without losing days."""
    first, last = as_date(start).replace(day=1), as_date(end)
    following = (last.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
    return first, following - dt.timedelta(days=1)
