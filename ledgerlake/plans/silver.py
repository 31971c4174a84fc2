"""Clean layer: typed columns, versioned dimensions, transactions with dimension keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as s
from ..functions.calendar import as_date, date_window_filter
from ..functions.scalars import DateLike
from ..operators.versions import close_versions
from ..schemas import SILVER_CARDS, SILVER_TRANSACTIONS, SILVER_USERS, conform


def silver_users(bronze: DataFrame, as_of: DateLike, wide: bool = False) -> DataFrame:
    """User versions with ages as of a date, income in numbers and bands."""
    return shape_users(close_versions(bronze, "id", "load_at"), as_of, wide)


def shape_users(versions: DataFrame, as_of: DateLike, wide: bool = False) -> DataFrame:
    """The same from versions that are closed already: a projection."""
    age = s.age_at(as_of, "birth_year")
    income = s.money("yearly_income", 15, 2)
    return conform(
        versions,
        SILVER_USERS,
        {
            "client_key": F.col("version_key"),
            "client_id": F.col("id"),
            "current_age": age,
            "age_group": s.age_group(age),
            "per_capita_income": s.money("per_capita_income", 15, 2),
            "yearly_income": income,
            "income_group": s.income_group(income),
            "total_debt": s.money("total_debt", 15, 2),
        },
        wide,
    )


def silver_cards(bronze: DataFrame, as_of: DateLike, wide: bool = False) -> DataFrame:
    """Card versions with checked month and year parts, expiry as of a date, and the limit in numbers."""
    return shape_cards(close_versions(bronze, "id", "load_at"), as_of, wide)


def shape_cards(versions: DataFrame, as_of: DateLike, wide: bool = False) -> DataFrame:
    """The same from versions that are closed already: a projection."""
    year, month = s.year_of("expires"), s.month_of("expires")
    return conform(
        versions,
        SILVER_CARDS,
        {
            "card_key": F.col("version_key"),
            "card_id": F.col("id"),
            "card_brand": F.upper("card_brand"),
            "card_type": F.upper("card_type"),
            "expires_date": F.col("expires"),
            "expires_year": year,
            "expires_month": month,
            "is_expires": s.expired(year, month, as_of),
            "has_chip": F.upper("has_chip") == "YES",
            "credit_limit": s.credit_limit("credit_limit"),
            "acct_open_year": s.year_of("acct_open_date"),
            "acct_open_month": s.month_of("acct_open_date"),
        },
        wide,
    )


def current_keys(dimension: DataFrame, entity: str, key: str) -> DataFrame:
    """Two narrow columns per current row, small enough for Spark to broadcast whenever its size check allows."""
    return dimension.where("is_current").select(entity, key)


def silver_transactions(
    bronze: DataFrame,
    users: DataFrame,
    cards: DataFrame,
    start: DateLike | None = None,
    end: DateLike | None = None,
    updated_at: Column | None = None,
    wide: bool = False,
) -> DataFrame:
    """Typed transactions of a date window with the keys of the current user and card rows."""
    rows = date_window_filter(bronze, "date_time", start, end)
    if "date_partition" in bronze.columns:
        if end is not None:
            rows = rows.where(F.col("date_partition") <= f"{as_date(end):%Y-%m}")
        if start is not None:
            rows = rows.where(F.col("date_partition") >= f"{as_date(start):%Y-%m}")
    keyed = rows.join(current_keys(users, "client_id", "client_key"), "client_id", "left").join(
        current_keys(cards, "card_id", "card_key"), "card_id", "left"
    )
    return conform(
        keyed,
        SILVER_TRANSACTIONS,
        {
            "transaction_id": F.col("id"),
            "amount": s.money("amount", 18, 4),
            "day": F.dayofmonth("date_time"),
            "hour": F.hour("date_time"),
            "use_chip": s.chip_flag("use_chip"),
            "is_error": s.error_flag("errors"),
            "updated_at": F.current_timestamp() if updated_at is None else updated_at,
            "year": F.year("date_time"),
            "month": F.month("date_time"),
        },
        wide,
    )
