"""Slowly changing dimension, type 2: close each version at the start of the next one, at once or load by load."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import surrogate_key

COPIES_PER_TASK = 100_000
MARKS = ("valid_from", "valid_to", "is_current", "version_key")


def close_versions(df: DataFrame, key: str, loaded_at: str) -> DataFrame:
    """Add ``valid_from``, ``valid_to``, ``is_current`` and ``version_key``.

    Meaning: ``valid_to`` is the ``loaded_at`` of the next row of the same key, rows of equal ``loaded_at`` being
    ordered by a fingerprint of their other columns; the last row stays open.

    A plain ``lead`` over the key would sort all rows of one key in one task. Only the last row of each
    (key, loaded_at) can reach a later load, all others close at their own ``loaded_at``. So identical rows are first
    collapsed to a count, with map-side combine, in the only pass over the input; from there the loads are reduced to one narrow
    row per (key, loaded_at), the window sees those alone, and the result joins back on an equality whose hot keys
    adaptive execution can split.
    """
    if "_fingerprint" in df.columns:
        raise ValueError("reserved column name: _fingerprint")
    others = sorted(c for c in df.columns if c not in (key, loaded_at))
    distinct = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    # The hash passes over NULLs, so where they stand goes in as well.
    distinct = distinct.withColumn("_fingerprint", F.xxhash64(*others, *(F.isnull(c) for c in others)))
    loads = (
        distinct.groupBy(F.col(key).alias("_key"), F.col(loaded_at).alias("_at"))
        # always so: what reads the counts, too, shares the shuffle of the collapsed rows
        .agg(F.max(F.when(F.col("_copies") > 0, F.col("_fingerprint"))).alias("_last"))
        .withColumn("_next", F.lead("_at").over(Window.partitionBy("_key").orderBy("_at")))
        # A later load with an unknown time cannot exist: NULL sorts first.
    )
    matches = F.col(key).eqNullSafe(F.col("_key")) & F.col(loaded_at).eqNullSafe(F.col("_at"))
    placed = distinct.join(loads, matches, "left").withColumn("_is_last", F.col("_fingerprint") == F.col("_last"))
    result = _laid_out(placed)
    is_open = F.col("_is_last") & (F.col("_copy") == 0)
    valid_to = F.when(is_open, F.col("_next")).otherwise(F.col(loaded_at))
    return result.select(
        *df.columns,
        F.col(loaded_at).alias("valid_from"),
        valid_to.alias("valid_to"),
        valid_to.isNull().alias("is_current"),
        # Only rows that lose a tie need more than the load to tell them apart; no fact ever refers to those.
        F.when(is_open, surrogate_key(key, loaded_at))
        .otherwise(surrogate_key(key, loaded_at, "_fingerprint"))
        .alias("version_key"),
    )


def _laid_out(counted: DataFrame) -> DataFrame:
    """As many rows as copies were counted, numbered in ``_copy``. Very many copies are laid out by many tasks."""
    most = F.col("_copies") <= COPIES_PER_TASK
    few = counted.where(most).withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)))
    last = F.floor((F.col("_copies") - 1) / COPIES_PER_TASK)
    portions = counted.where(~most).withColumn("_portion", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    first = F.col("_portion") * COPIES_PER_TASK
    past = F.least(first + COPIES_PER_TASK, F.col("_copies"))
    many = portions.repartition("_fingerprint", "_portion").withColumn("_copy", F.explode(F.sequence(first, past - 1)))
    return few.unionByName(many.drop("_portion"))


def merge_versions(stored: DataFrame, loads: DataFrame, key: str, loaded_at: str) -> DataFrame:
    """What ``close_versions`` gives for the rows behind ``stored`` and the new ``loads`` together.

    Only keys of the new loads are closed anew, and of their versions only those that were open, or closed at or after
    the key's first new load: a load in order of time meets the open version alone, a late one finds its place in
    between. All other rows pass through. A load time that comes again replaces the rows it brought for these keys, so
    a repeated merge changes nothing.

    ``stored`` may be part of all versions, as long as it has those rows of the keys in ``loads``.
    """
    columns = [c for c in stored.columns if c not in MARKS]
    first = loads.groupBy(F.col(key).alias("_key")).agg(
        F.min(loaded_at).alias("_first"), (F.count(F.lit(1)) > F.count(loaded_at)).alias("_unknown")
    )
    again = loads.select(F.col(key).alias("_key"), F.col(loaded_at).alias("_at")).distinct().withColumn("_again", F.lit(True))
    same_key = F.col(key).eqNullSafe(F.col("first._key"))
    same_load = F.col(key).eqNullSafe(F.col("again._key")) & F.col(loaded_at).eqNullSafe(F.col("again._at"))
    marked = stored.join(first.alias("first"), same_key, "left").join(again.alias("again"), same_load, "left")
    changes = F.col("_unknown").isNotNull() & (
        F.col("_unknown") | F.col("valid_to").isNull() | (F.col("valid_to") >= F.col("_first"))
    )
    stays = marked.where(~changes).select(*stored.columns)
    older = marked.where(changes & F.col("_again").isNull()).select(*columns)
    return stays.unionByName(close_versions(older.unionByName(loads.select(*columns)), key, loaded_at))
