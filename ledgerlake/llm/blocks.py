"""Documents packed into blocks: one row holds some megabytes of compressed texts, so that what tasks send for a block
and get back for it are few rows of many numbers."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm.text import pieces, raw


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below the one that driver and executors share, removed when the session's JVM ends: the checkpoint
    folder, or one below the warehouse where none is set."""
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    base = base or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints"
    folder = f"{base.rstrip('/')}/blocks-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def release_shuffles(spark: SparkSession) -> None:
    """Let go of shuffle files that no frame refers to any more. Spark removes them once the driver has collected its garbage,
    which a driver that has little to do may put off until the disks are full."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def pack_block(ids: list, texts: list[bytes]) -> bytes:
    sizes = pa.array([len(t) for t in texts], pa.int64())
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), sizes], names=["doc_id", "size"])
    head = batch.serialize().to_pybytes()
    whole = len(head).to_bytes(8, "little") + head + b"".join(texts)
    return zstandard.ZstdCompressor(level=3).compress(whole)


def unpack_block(data: bytes) -> tuple[list, bytes, np.ndarray]:
    """Ids (None where unknown), all texts one after the other, and where each begins and the last ends."""
    whole = zstandard.ZstdDecompressor().decompress(data)
    n = int.from_bytes(whole[:8], "little")
    schema = pa.schema([("doc_id", pa.int64()), ("size", pa.int64())])
    batch = pa.ipc.read_record_batch(pa.py_buffer(whole[8 : 8 + n]), schema)
    return batch["doc_id"].to_pylist(), whole[8 + n :], np.concatenate([[0], np.cumsum(batch["size"].to_numpy())]).astype(np.int64)


def write_blocks(docs: DataFrame, folder: str, block_bytes: int) -> DataFrame:
    """(block, data) of all rows of `docs` (doc_id, text; null texts are empty), written to `folder` and read again, so
    that a block's number stays what it is when a task is repeated. A block ends with the text that fills it."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        number, size = 0, 0
        ids: list = []
        texts: list[bytes] = []

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([first + number], pa.int64()), pa.array([pack_block(ids, texts)], pa.binary())], names=["block", "data"])

        for piece in pieces(batches, "text", block_bytes // 4):
            ids += piece["doc_id"].to_pylist()
            texts += raw(piece)
            size += sum(map(len, texts[-piece.num_rows :]))
            if size >= block_bytes:
                yield block()
                ids, texts, size, number = [], [], 0, number + 1
        if ids:
            yield block()

    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    # the data are compressed already
    rows.mapInArrow(packed, "block long, data binary").write.option("compression", "none").parquet(folder)
    return docs.sparkSession.read.parquet(folder)


def planes(values: np.ndarray) -> bytes:
    """Whole numbers in as many bytes as the greatest needs: their width, then all lowest bytes, all second ones, and so on."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    width = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    return bytes([width]) + np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def numbers(data) -> np.ndarray:
    """What `planes` wrote."""
    held = np.frombuffer(data, np.uint8)
    width = int(held[0])
    out = np.zeros(((len(held) - 1) // width, 8), np.uint8)
    out[:, :width] = held[1:].reshape(width, -1).T
    return out.view(np.uint64).reshape(-1)
