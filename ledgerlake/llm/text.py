"""Shared text helpers of the training-data operators.

A word is a run of characters other than space and the controls 9 to 13. On UTF-8 bytes that is what `bytes.split()`
cuts, and `bytes.lower()` lowers A-Z alone, so texts are handled as bytes. Batches are cut into pieces of a few
megabytes, which bounds a Python worker's memory whatever Spark puts into one Arrow batch.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECE_BYTES = 1 << 20
WORD = r"[^\x20\x09-\x0D]+"


def pieces(batches: Iterable[pa.RecordBatch], column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of the batches whose texts hold about `limit` bytes; a longer text makes its own slice."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.array(pa.compute.fill_null(pa.compute.binary_length(batch[column]), 0), dtype=np.int64)
        ends, start = np.cumsum(sizes + 64), 0
        while start < len(sizes):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def raw(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The column's texts as bytes, null as empty."""
    return [x or b"" for x in batch[column].cast(pa.large_binary()).to_pylist()]


class Tokens:
    """Words of a slice: `ids` into `vocab`, and `offs`, the place where each document begins."""

    def __init__(self, texts: Iterable[bytes], end: bytes | None = None):
        words, offs = [], [0]
        for text in texts:
            words += text.split()
            if end is not None:
                words.append(end)
            offs.append(len(words))
        self.vocab = dict(zip(dict.fromkeys(words), range(len(words)), strict=False))
        self.ids = np.fromiter(map(self.vocab.__getitem__, words), np.int64, len(words))
        self.offs = np.array(offs, dtype=np.int64)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word of the vocabulary."""
        return np.fromiter(map(xxhash.xxh3_64_intdigest, self.vocab), np.uint64, len(self.vocab))

    def docs(self) -> np.ndarray:
        """The document's index of every word."""
        return np.repeat(np.arange(len(self.offs) - 1), np.diff(self.offs))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(hashes: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word windows within documents, in order, and how many each document has."""
    n = len(hashes)
    counts = np.maximum(np.diff(offs) - k + 1, 0)
    if n < k:
        return np.zeros(0, np.uint64), counts
    out = hashes[: n - k + 1].copy()
    for i in range(1, k):
        out = mix(out) + hashes[i : n - k + 1 + i]
    out = mix(out)
    starts = np.repeat(offs[:-1] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    return out[starts], counts


def runs(batches: Iterator[pa.RecordBatch], key: list[str], columns: list[str], most: int | None = None) -> Iterator[tuple[pa.Table, bool]]:
    """Rows of a stream sorted by `key`, a run of equal keys at a time; runs longer than `most` come in parts.
    Yields a part and whether the run goes on after it."""
    held: list[pa.Table] = []
    n_held = 0

    def changes(table: pa.Table) -> np.ndarray:
        values = [table[k].to_numpy() for k in key]
        return np.flatnonzero(np.any([v[1:] != v[:-1] for v in values], axis=0)) + 1

    def last_key(table: pa.Table) -> tuple:
        return tuple(table[k][-1].as_py() for k in key)

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch]).select(columns)
        cuts = [0, *changes(table), table.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            part = table.slice(a, b - a)
            if held and last_key(held[-1]) != last_key(part.slice(0, 1)):
                yield pa.concat_tables(held), False
                held, n_held = [], 0
            held.append(part)
            n_held += part.num_rows
            while most and n_held > most:
                whole = pa.concat_tables(held)
                yield whole.slice(0, most), True
                held, n_held = [whole.slice(most)], n_held - most
    if held:
        yield pa.concat_tables(held), False


def held_out(doc_id: Column, remainder: int) -> Column:
    """crc32 of the id as text, modulo 5, equals `remainder`; false for a null id."""
    return F.coalesce(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == remainder, F.lit(False))


def crc_fold(doc_ids: Iterable) -> np.ndarray:
    """The same remainder for ids in Python."""
    return np.array([zlib.crc32(("" if d is None else str(d)).encode()) % 5 for d in doc_ids], dtype=np.int64)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, remainder: int = 0) -> DataFrame:
    """(doc_id, text, y) of at most `max_rows` labelled documents outside the held-out fold, picked by a hash of the id.

    A document labelled more than once gets the mean label, ties up; of an id with several rows the greatest text stands
    for it, so there are no more rows than ids. The picked ids are bounded by `max_rows`, which is why they may be broadcast."""
    picked = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), remainder))
        .groupBy("doc_id")
        .agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    found = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(picked), "doc_id")
    return found.groupBy("doc_id", "y").agg(F.max("text").alias("text")).select("doc_id", "text", "y")
