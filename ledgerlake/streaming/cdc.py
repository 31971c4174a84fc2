"""Landing of change-data-capture records in bronze. Stateless, the same for every source table."""

from __future__ import annotations

import posixpath
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..functions.scalars import as_text, json_long, json_text
from ..schemas import BRONZE_CDC, conform, ddl
from ..sinks.tables import counted, row_count

PARTITION = "ingestion_date"
TRIGGER = "30 seconds"
SOURCE_TABLES = ("users", "cards", "transactions")


def envelope(records: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Raw record plus operation and source time; ``records`` has ``key, value, offset, timestamp``.

    Works on batch and streaming frames alike. In a stream the current time is fixed per micro-batch.
    """
    now = F.current_timestamp() if ingested_at is None else ingested_at
    payload = as_text("value")
    return conform(
        records,
        BRONZE_CDC,
        {
            "kafka_key": as_text("key"),
            "kafka_offset": F.col("offset"),
            "kafka_timestamp": F.col("timestamp"),
            "cdc_payload": payload,
            "operation": json_text(payload, "$.op"),
            "cdc_timestamp": json_long(payload, "$.ts_ms"),
            "ingestion_time": now,
            "ingestion_date": F.date_format(now, "yyyy-MM-dd"),
        },
    )


def _place(path: str) -> str:
    """The path in one spelling: absolute, and local ones without their scheme."""
    scheme, mark, rest = path.partition("://")
    if mark and scheme != "file":
        return f"{scheme}://{posixpath.normpath(rest)}"
    rest = rest if mark else path.removeprefix("file:")
    return posixpath.abspath(rest) if not rest.startswith("/") else "/" + posixpath.normpath(rest).lstrip("/")


def _keep_apart(checkpoint: str, path: str) -> None:
    inner, outer = _place(checkpoint), _place(path)
    if inner == outer or inner.startswith(outer + "/"):
        raise ValueError("keep the checkpoint outside the table directory")


def land_cdc(
    records: DataFrame,
    path: str,
    checkpoint: str,
    table: str | None = None,
    once: bool = False,
    every: str = TRIGGER,
) -> StreamingQuery:
    """Append the stream to Parquet files, exactly once, partitioned by ingestion date.

    The sink's own log makes a repeated micro-batch after a failure add no rows. The checkpoint must lie outside
    ``path``. With ``table`` the files are registered in the catalog. ``once`` drains what is there and stops.
    """
    _keep_apart(checkpoint, path)
    writer = (
        envelope(records)
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(PARTITION)
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)
    return writer.toTable(table) if table else writer.start()


class BatchWriter:
    """Writes each micro-batch to a folder of its own, ``<path>/batch_id=<n>``, replacing what a failed attempt left.

    For ``foreachBatch``: Spark repeats a batch under its number until it is committed, so a repeated one adds nothing. An
    empty batch writes nothing. ``sizes`` has the rows of each batch written by this object.
    """

    def __init__(self, path: str) -> None:
        self.path = path
        self.sizes: dict[int, int] = {}

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            self.sizes[batch_id] = 0
            return
        watched, watch = counted(batch)
        watched.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
        self.sizes[batch_id] = row_count(watch)


def land_batches(
    records: DataFrame,
    write: Callable[[DataFrame, int], None],
    path: str,
    checkpoint: str,
    once: bool = False,
    every: str = TRIGGER,
) -> StreamingQuery:
    """Land the stream batch by batch through a ``BatchWriter(path)``, with sizes reported and replays that add no rows;
    read it back by ``landed_batches``.

    The folder belongs to the checkpoint: batches count from zero again with a new one, so give that a new folder too.
    """
    _keep_apart(checkpoint, path)
    writer = envelope(records).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def landed_batches(spark: SparkSession, path: str) -> DataFrame:
    """All landed rows with their ``batch_id``."""
    return spark.read.schema(f"{ddl(BRONZE_CDC)}, batch_id bigint").parquet(path)


class LandedRows(StreamingQueryListener):
    """Counts the input rows of every micro-batch, however long a run lasts. Register it before the stream starts:
    ``spark.streams.addListener(LandedRows())``."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.rows[str(event.runId)] = 0

    def onQueryProgress(self, event) -> None:  # noqa: N802
        self.rows[str(event.progress.runId)] = self.rows.get(str(event.progress.runId), 0) + event.progress.numInputRows

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def of(self, query: StreamingQuery) -> int:
        return self.rows.get(str(query.runId), 0)
