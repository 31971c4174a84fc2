"""Source constraints as reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import window_start_of
from ..functions.scalars import DateLike, date_lit


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Primary key violations: every key that occurs more than once, or holds a NULL, with its number of rows."""
    unknown = reduce(Column.__or__, (F.col(c).isNull() for c in key))
    return (
        df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).where((F.col("row_count") > 1) | unknown)
    )


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign key violations: child keys without a parent, with the number of child rows.

    Child rows are counted per key first, so a hot key costs one row in the join. NULL keys violate nothing.
    """
    counted = (
        child.where(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("key"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    return counted.join(parent.select(F.col(parent_key).alias("key")), "key", "left_anti")


def rule_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows per rule that break it, all rules in one pass. A rule that evaluates to NULL is not broken."""
    one_row = df.agg(*(F.count_if(~rule).alias(name) for name, rule in rules.items()))
    return one_row.unpivot([], list(rules), "rule", "violations")


def window_audit(df: DataFrame, moment: str, start: DateLike | Column, end: DateLike | Column, days: int) -> DataFrame:
    """Rows per fixed window (empty ones left out) and, with NULL window bounds, in total."""
    date = F.to_date(moment)
    last = date_lit(end)
    inside = df.where(date.between(date_lit(start), last)).select(window_start_of(date, start, days).alias("window_start"))
    counted = inside.rollup("window_start").agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select(
        "window_start", F.least(F.date_add("window_start", days - 1), last).alias("_end"), "row_count"
    ).select("window_start", F.when(F.col("window_start").isNotNull(), F.col("_end")).alias("window_end"), "row_count")


def user_rules() -> dict[str, Column]:
    return {
        "users_age_present": F.col("current_age").isNotNull(),
        "users_gender_known": F.col("gender").isin("Male", "Female"),
    }


def card_rules() -> dict[str, Column]:
    return {"cards_client_present": F.col("client_id").isNotNull()}


def transaction_rules() -> dict[str, Column]:
    return {
        "transactions_time_present": F.col("date_time").isNotNull(),
        "transactions_client_present": F.col("client_id").isNotNull(),
        "transactions_card_present": F.col("card_id").isNotNull(),
    }
