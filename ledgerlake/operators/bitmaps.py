"""Exact distinct counts that can be merged: bitmaps by bucket, kept per day, combined to any longer period.

A number's bucket and its bit follow from the number alone, so bitmaps of one bucket can be or-ed whatever they were
made from. A bucket covers 32,768 numbers in 4 KB, which Parquet packs when few bits are set; a day costs at most
one bitmap for each bucket in use, however many rows it has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_bitmaps(df: DataFrame, group: Mapping[str, Column], counted: Mapping[str, str]) -> DataFrame:
    """Columns of ``group``, ``measure``, ``bucket`` and ``bits``: which values of the whole-number column
    ``counted[measure]`` occur in the group. NULLs are no values.

    Each measure reads its own column; bitmaps are filled before the shuffle, which carries 4 KB a task and bucket.
    """

    def one(measure: str, column: str) -> DataFrame:
        value = F.col(column).cast("long")
        rows = df.select(*(c.alias(n) for n, c in group.items()), value.alias("_value")).where("_value IS NOT NULL")
        rows = rows.withColumns({"bucket": F.bitmap_bucket_number("_value"), "_bit": F.bitmap_bit_position("_value")})
        bits = rows.groupBy(*group, "bucket").agg(F.bitmap_construct_agg("_bit").alias("bits"))
        return bits.select(*group, F.lit(measure).alias("measure"), "bucket", "bits")

    return reduce(DataFrame.unionByName, (one(m, c) for m, c in counted.items()))


def merged_counts(bitmaps: DataFrame, group: Mapping[str, Column], measures: Sequence[str]) -> DataFrame:
    """Exact distinct counts per (coarser) group, one column for each measure; the source isn't read again."""
    merged = (
        bitmaps.where(F.col("measure").isin(*measures))
        .groupBy(*(c.alias(n) for n, c in group.items()), "measure", "bucket")
        .agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("_n"))
    )
    counts = [F.coalesce(F.sum(F.when(F.col("measure") == m, F.col("_n"))), F.lit(0)).cast("long").alias(m) for m in measures]
    return merged.groupBy(*group).agg(*counts)
