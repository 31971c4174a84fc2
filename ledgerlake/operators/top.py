"""Most frequent key per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def leader(count: Column | str, key: Column | str) -> Column:
    """Aggregate: the (count, key) with the largest count; ties go to the smallest key, an unknown key coming last.

    An aggregate combines before the shuffle, so a group with very many keys never meets in one task the way it
    would in a ``row_number`` window. Read the result with ``leader_key`` and ``leader_count``.
    """
    count = F.col(count) if isinstance(count, str) else count
    key = F.col(key) if isinstance(key, str) else key
    # A NULL count marks rows that do not take part; min() skips the NULL struct.
    entry = F.struct((-count).alias("neg"), key.isNull().alias("unknown"), key.alias("key"))
    return F.min(F.when(count.isNotNull(), entry))


def leader_key(entry: str) -> Column:
    return F.col(entry).getField("key")


def leader_count(entry: str) -> Column:
    return -F.col(entry).getField("neg")


def top_per_group(df: DataFrame, group: Sequence[str], key: str, counted: Column, names: tuple[str, str]) -> DataFrame:
    """One row per group: its most frequent ``key`` and that count, named by ``names``."""
    per_key = df.groupBy(*group, key).agg(counted.alias("_n"))
    return (
        per_key.groupBy(*group)
        .agg(leader("_n", key).alias("_top"))
        .select(*group, leader_key("_top").alias(names[0]), leader_count("_top").alias(names[1]))
    )
