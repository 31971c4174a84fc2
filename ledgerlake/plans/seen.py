"""Who was seen in which month: small tables that stand for all history of the fact.

They are laid out by the fact's months and rebuilt with them, so a back-fill or a rerun of any window leaves them as one
pass over the whole fact would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as s
from ..functions.calendar import as_date
from ..functions.scalars import DateLike
from ..operators.history import first_seen
from ..schemas import GOLD_CLIENT_MONTHS, GOLD_MERCHANT_CLIENT_MONTHS, conform
from .market import in_window
from .merchant import PAIR, month_before


def client_months(
    detail: DataFrame, start: DateLike | None = None, end: DateLike | None = None, wide: bool = False
) -> DataFrame:
    """First date of each client in each month of the window, which must hold whole months."""
    month = s.month_start("txn_date_time")
    seen = in_window(detail, start, end).groupBy("client_id", month.alias("period_month")).agg(F.min(F.to_date("txn_date_time")).alias("first_date"))
    return conform(seen, GOLD_CLIENT_MONTHS, {"year": F.year("period_month"), "month": F.month("period_month")}, wide)


def merchant_client_months(
    detail: DataFrame, start: DateLike | None = None, end: DateLike | None = None, wide: bool = False
) -> DataFrame:
    """Pairs of merchant and client seen in each month of the window, which must hold whole months."""
    pairs = in_window(detail, start, end).select(*PAIR, s.month_start("txn_date_time").alias("period_month")).distinct()
    return conform(pairs, GOLD_MERCHANT_CLIENT_MONTHS, {"year": F.year("period_month"), "month": F.month("period_month")}, wide)


def first_dates(months: DataFrame, end: DateLike | None = None) -> DataFrame:
    """First date of each client up to ``end``. The first of a month that lies behind ``end`` has none before it."""
    if end is not None:
        last = as_date(end)
        months = months.where(F.col("year") * 100 + F.col("month") <= last.year * 100 + last.month)
        months = months.where(F.col("first_date") <= s.date_lit(last))
    return first_seen(months, "client_id", "first_date")


def earlier_pairs(months: DataFrame, start: DateLike) -> DataFrame:
    """Pairs seen before the month that precedes ``start``, with their last month, as ``merchant.pairs_before`` gives."""
    before = month_before(start)
    older = months.where(F.col("year") * 100 + F.col("month") < before.year * 100 + before.month)
    return older.groupBy(*PAIR).agg(F.max("period_month").alias("period_month"))
