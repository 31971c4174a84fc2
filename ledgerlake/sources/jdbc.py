"""JDBC table scan, split by a numeric column so that many tasks read at once."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

FETCH_SIZE = "10000"


@dataclass(frozen=True)
class Split:
    """How to cut the table: ``parts`` ranges of ``column`` between its lowest and highest value.

    The bounds only place the cuts. Rows outside them, and NULLs, still belong to the outer ranges.
    """

    column: str
    lower: int
    upper: int
    parts: int


def scan_options(split: Split | None, fetch_size: str = FETCH_SIZE) -> dict[str, str]:
    options = {"fetchsize": fetch_size}
    if split is not None:
        options |= {
            "partitionColumn": split.column,
            "lowerBound": str(split.lower),
            "upperBound": str(split.upper),
            "numPartitions": str(split.parts),
        }
    return options


def read_jdbc(
    spark: SparkSession, url: str, table: str, properties: Mapping[str, str], split: Split | None = None
) -> DataFrame:
    """Without ``split`` one task reads the whole table, which only suits small ones."""
    options = {**scan_options(split), **properties}
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def measured_split(
    spark: SparkSession, url: str, table: str, properties: Mapping[str, str], column: str, parts: int
) -> Split | None:
    """Split at the true bounds of ``column``; the database computes them, one row comes back. None if empty."""
    query = f"select min({column}) as low, max({column}) as high from {table}"
    low, high = spark.read.format("jdbc").options(url=url, query=query, **properties).load().first()
    return None if low is None else Split(column, int(low), int(high), parts)
