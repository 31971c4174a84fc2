"""Folder and catalog names for intermediate tables."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below the one that all executors reach: the checkpoint folder, or else the warehouse.

    It is removed when the session's JVM ends, as intermediate tables are of no use after that.
    """
    base = spark.conf.get(SETTING, None) or spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{base.rstrip('/')}/ledgerlake-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def drop_at_end(spark: SparkSession, *objects: str) -> None:
    """Drop catalog objects (``TABLE name`` or ``VIEW name``) when Python ends, if the session still runs then."""

    def drop() -> None:
        if spark._jsc is not None and not spark._jsc.sc().isStopped():
            for each in objects:
                spark.sql(f"DROP {each.replace(' ', ' IF EXISTS ', 1)}")

    atexit.register(drop)
