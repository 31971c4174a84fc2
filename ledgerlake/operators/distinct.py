"""Exact distinct counts of several columns per group."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_counts(
    df: DataFrame, group: Mapping[str, Column], counted: Mapping[str, str], few_combinations: bool = False
) -> DataFrame:
    """``counted`` maps an output name to the column whose values are counted; NULLs do not count.

    Spark copies every row once per counted column and combines each copy, (group, value), before the shuffle. Where
    the combinations of all values are known to be few, ``few_combinations`` drops repeated ones first, which moves
    the copying behind a shuffle of the bare combinations. A hot group spreads over its values either way.
    """
    combinations = df.select(*(c.alias(name) for name, c in group.items()), *counted.values())
    if few_combinations:
        combinations = combinations.distinct()
    return combinations.groupBy(*group).agg(*(F.count_distinct(c).alias(name) for name, c in counted.items()))
