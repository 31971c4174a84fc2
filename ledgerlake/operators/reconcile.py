"""Reconciliation of layers: which windows, and which rows, were lost, doubled or changed on the way.

A window's rows are summed up as a number of rows and an order-free digest, a sum of row hashes, which no shuffle order
changes and which, unlike an exclusive or, sees a row that occurs twice. Digests combine before their shuffle, so a
window costs one row a task, whatever it holds.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ABSENT = "absent"


def row_hash(columns: Sequence[str | Column]) -> Column:
    """64-bit hash of a row's values. NULLs count by their place, as the hash itself passes over them."""
    values = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.xxhash64(*values, F.concat(*(F.when(v.isNull(), "1").otherwise("0") for v in values)))


def window_digests(df: DataFrame, window: Column, columns: Sequence[str | Column]) -> DataFrame:
    """``window``, ``row_count`` and ``digest`` (exact sum of row hashes) of a layer."""
    return df.groupBy(window.alias("window")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(row_hash(columns).cast("decimal(20,0)")).alias("digest")
    )


def reconcile(layers: Mapping[str, DataFrame]) -> DataFrame:
    """A row per window: rows in each layer (``<layer>_rows``), and for each layer but the first what became of the rows of
    the one before (``<layer>_state``): ``same``, ``lost``, ``doubled`` or ``changed``; NULL windows are a window too.

    ``layers`` maps names, in the order of processing, to ``window_digests`` of the columns they share. ``lost`` and
    ``doubled`` say only that there are fewer or more rows; ``differing_rows`` names them.
    """
    names = list(layers)
    rows = reduce(DataFrame.unionByName, (df.withColumn("layer", F.lit(name)) for name, df in layers.items()))
    of = {name: F.col("layer") == name for name in names}
    wide = rows.groupBy("window").agg(
        *(F.coalesce(F.sum(F.when(of[n], F.col("row_count"))), F.lit(0)).cast("long").alias(f"{n}_rows") for n in names),
        *(F.sum(F.when(of[n], F.col("digest"))).alias(f"{n}_digest") for n in names),
    )
    states = []
    for before, after in zip(names[:-1], names[1:], strict=True):
        had, has = F.col(f"{before}_rows"), F.col(f"{after}_rows")
        equal = F.col(f"{before}_digest").eqNullSafe(F.col(f"{after}_digest"))
        state = F.when(has < had, "lost").when(has > had, "doubled").when(equal, "same").otherwise("changed")
        states.append(state.alias(f"{after}_state"))
    return wide.select("window", *(f"{n}_rows" for n in names), *states)


def differing_rows(before: DataFrame, after: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows that occur a different number of times in two layers: ``columns``, ``rows_before`` and ``rows_after``.

    Give it the windows that ``reconcile`` names. Rows are counted by value on each side before they meet, so many
    copies cost one row a task.
    """
    sides = [
        df.select(*columns, F.lit(a).cast("long").alias("_before"), F.lit(b).cast("long").alias("_after"))
        for df, a, b in ((before, 1, 0), (after, 0, 1))
    ]
    counted = sides[0].unionByName(sides[1]).groupBy(*columns)
    both = counted.agg(F.sum("_before").alias("rows_before"), F.sum("_after").alias("rows_after"))
    return both.where("rows_before <> rows_after")
