"""Catalog tables: declare, append, overwrite, replace partitions or a window of them, bucket, measure, view."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import as_date
from ..functions.scalars import DateLike
from ..schemas import BUCKETED_BY, TABLES, ddl, table_columns

DYNAMIC = "spark.sql.sources.partitionOverwriteMode"


def create_database(spark: SparkSession, name: str, location: str | None = None, comment: str = "") -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} COMMENT '{comment}'{place}")


def create_table(
    spark: SparkSession,
    name: str,
    columns: dict[str, str],
    partitions: Sequence[str] = (),
    location: str | None = None,
    comment: str = "",
    buckets: tuple[str, int] | None = None,
) -> None:
    """Declare a Parquet table with Snappy compression if it does not exist; ``buckets`` is a column and a number."""
    layout = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    layout += f" CLUSTERED BY ({buckets[0]}) INTO {buckets[1]} BUCKETS" if buckets else ""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({ddl(columns)}) USING parquet OPTIONS ('compression'='snappy')"
        f"{layout} COMMENT '{comment}'{place}"
    )


def create_declared(
    spark: SparkSession,
    table: str,
    name: str,
    location: str | None = None,
    wide: bool = False,
    buckets: int | None = None,
) -> None:
    """Declare one of ``schemas.TABLES`` under a catalog name, bucketed if ``schemas.BUCKETED_BY`` names a column and
    ``buckets`` a number."""
    column = BUCKETED_BY.get(table)
    clause = (column, buckets) if column and buckets else None
    create_table(spark, name, table_columns(table, wide), TABLES[table][1], location, buckets=clause)


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}


def buckets_of(spark: SparkSession, name: str) -> tuple[str, int] | None:
    """Bucket column and number of buckets of a catalog table."""
    facts = _described(spark, name)
    number = int(facts.get("Num Buckets") or 0)
    return (facts["Bucket Columns"].strip("[]`"), number) if number > 0 else None


def laid_out(df: DataFrame, name: str, partitions: Sequence[str] = ()) -> DataFrame:
    """As the table wants its files: one task for each bucket, so a partition has a file a bucket; without buckets balanced."""
    buckets = buckets_of(df.sparkSession, name)
    return df.repartition(buckets[1], buckets[0]) if buckets else balanced(df, partitions)


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(DYNAMIC)
    spark.conf.set(DYNAMIC, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(DYNAMIC, before)


def balanced(df: DataFrame, partitions: Sequence[str] = ()) -> DataFrame:
    """Even out output files before a write; a hot partition value is cut into several files by adaptive execution."""
    return df.hint("rebalance", *partitions)


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Attach a row counter that a later write fills in, so no second job is needed for the number."""
    watch = Observation()
    return df.observe(watch, F.count(F.lit(1)).alias("row_count")), watch


def row_count(watch: Observation) -> int:
    """The number a finished write counted. Where the plan was found empty beforehand nothing was observed: no rows."""
    return _metrics(watch).get("row_count", 0)


def _metrics(watch: Observation) -> dict:
    try:
        return watch.get
    except Py4JJavaError as error:
        if "AssertionError" not in str(error.java_exception):
            raise
        return {}


def append(df: DataFrame, name: str, partitions: Sequence[str] = ()) -> None:
    """Append by column name; a table that does not exist yet is created."""
    if df.sparkSession.catalog.tableExists(name):
        _in_table_order(df, name).write.mode("append").insertInto(name)
        return
    writer = df.write.mode("append").format("parquet")
    (writer.partitionBy(*partitions) if partitions else writer).saveAsTable(name)


def overwrite(df: DataFrame, name: str, location: str | None = None) -> None:
    """Replace the table and its schema, at an explicit location if given."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", location) if location else writer).saveAsTable(name)


def _in_table_order(df: DataFrame, name: str) -> DataFrame:
    return df.select(*df.sparkSession.table(name).columns)


def overwrite_rows(df: DataFrame, name: str) -> None:
    """Replace all rows, keep the declared table."""
    df = laid_out(df, name) if buckets_of(df.sparkSession, name) else df
    _in_table_order(df, name).write.mode("overwrite").insertInto(name)


def replace_partitions(df: DataFrame, name: str, partitions: Sequence[str]) -> None:
    """Replace exactly the partitions that occur in ``df``; all others stay.

    The plan runs once. Adaptive execution sizes the files, and a failed write leaves the old partitions in place.
    """
    with _dynamic_overwrite(df.sparkSession):
        _in_table_order(laid_out(df, name, partitions), name).write.mode("overwrite").insertInto(name)


Partition = dict[str, str | None]


def partition_values(spark: SparkSession, name: str) -> list[Partition]:
    """All partitions of a catalog table, from its metadata; no file is opened."""
    parts = ([x.split("=", 1) for x in r[0].split("/")] for r in spark.sql(f"SHOW PARTITIONS {name}").collect())
    return [{c: None if v == "__HIVE_DEFAULT_PARTITION__" else unquote(v) for c, v in part} for part in parts]


def between(columns: Sequence[str], start: DateLike, end: DateLike) -> Callable[[Partition], bool]:
    """Whether a partition by (year), (year, month) or (year, month, day) touches the closed window."""
    low, high = ((d.year, d.month, d.day)[: len(columns)] for d in (as_date(start), as_date(end)))

    def inside(partition: Partition) -> bool:
        values = [partition[c] for c in columns]
        return None not in values and low <= tuple(int(v) for v in values) <= high

    return inside


def replace_window(df: DataFrame, name: str, partitions: Sequence[str], inside: Callable[[Partition], bool]) -> int:
    """Make the partitions for which ``inside`` holds equal to ``df``; all others stay. Returns the number of rows.

    Like ``replace_partitions``, but a partition of the window that has no rows any more goes as well. Which partitions
    were written is observed during the write. A failure before the last step leaves old partitions, never
    half-written ones; a rerun mends it.
    """
    spark = df.sparkSession
    before = [p for p in partition_values(spark, name) if inside(p)]
    watch = Observation()
    touched = F.collect_set(F.struct(*(F.col(c).cast("string").alias(c) for c in partitions)))
    watched = df.observe(watch, F.count(F.lit(1)).alias("row_count"), touched.alias("touched"))
    replace_partitions(watched, name, partitions)
    metrics = _metrics(watch)
    written = {tuple(row) for row in metrics.get("touched", ())}
    _drop_partitions(spark, name, [p for p in before if tuple(p[c] for c in partitions) not in written])
    return metrics.get("row_count", 0)


def _drop_partitions(spark: SparkSession, name: str, gone: Sequence[Partition]) -> None:
    if not gone:
        return

    def spec(partition: Partition) -> str:
        return "PARTITION (" + ", ".join(f"`{c}` = '{v}'" for c, v in partition.items()) + ")"

    if _described(spark, name).get("Type") == "EXTERNAL":
        # Dropping would leave the files of a table at a place of its own: overwrite them with nothing first.
        rest = [c for c in spark.table(name).columns if c not in gone[0]]
        empty = spark.createDataFrame([], spark.table(name).select(*rest).schema)
        for partition in gone:
            spark.sql(f"INSERT OVERWRITE TABLE {name} {spec(partition)} SELECT * FROM {{empty}}", empty=empty)
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS " + ", ".join(map(spec, gone)))


def last_date(spark: SparkSession, name: str, columns: Sequence[str]) -> dt.date | None:
    """Latest (year, month, day) partition, from the catalog's list."""
    known = [[p[c] for c in columns] for p in partition_values(spark, name)]
    return max((dt.date(*map(int, v)) for v in known if None not in v), default=None)


def measure(spark: SparkSession, name: str, columns: Sequence[str] = ()) -> None:
    """Store the table's size and row count, and value counts of ``columns``, for Spark's choice of joins."""
    of = f" FOR COLUMNS {', '.join(columns)}" if columns else ""
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS{of}")


def write_bucketed(
    df: DataFrame, name: str, buckets: int, column: str, location: str | None = None
) -> None:
    """Bucketed and sorted by ``column``: equal bucket counts join without an exchange.

    A bucket is one task and cannot be split, so keep columns with a hot value out of here.
    """
    writer = df.write.mode("overwrite").format("parquet").bucketBy(buckets, column).sortBy(column)
    (writer.option("path", location) if location else writer).saveAsTable(name)


def bucket_count(rows: int, rows_per_bucket: int = 4_000_000, least: int = 16) -> int:
    """Buckets that keep one bucket, hence one task, at a bounded number of rows."""
    return max(least, -(-rows // rows_per_bucket))


def fixed_files(df: DataFrame, files: int) -> DataFrame:
    """An exact number of output files; costs one shuffle."""
    return df.repartition(files)


def create_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)
