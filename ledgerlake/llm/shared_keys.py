"""Which hashed keys of a block occur in other documents, too: each block sends its distinct keys, cut to as many bits as
tell them apart, to their ranges of hashes, and gets two bits for each back. Hashes that collide make a key look shared
that is not, which costs work but loses nothing. A block has a row for each range, so rows are as many as blocks times ranges:
blocks must be the larger, the more there are."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlake.llm.blocks import numbers, planes, unpack_block
from ledgerlake.llm.text import runs


@dataclass
class Layout:
    """How hashes are cut: to `bits`, the first `range_bits` of which are the range."""

    bits: int
    range_bits: int

    @staticmethod
    def of(blocks: int, block_bytes: int, blocks_per_range: int = 8) -> Layout:
        """Ranges of some megabytes (as many blocks as told at most), and about a thousand possible values for each anchor there is."""
        range_bits = max(4, (max(blocks, 1) // blocks_per_range).bit_length())
        return Layout(min(60, max(range_bits + 8, (max(blocks, 1) * (block_bytes // 8)).bit_length() + 10)), range_bits)

    def cut(self, hashes: np.ndarray) -> np.ndarray:
        return hashes >> np.uint64(64 - self.bits)

    def borders(self, keys: np.ndarray) -> np.ndarray:
        """Where each range begins in rising keys, and the end."""
        edges = np.arange(1 << self.range_bits, dtype=np.uint64) << np.uint64(self.bits - self.range_bits)
        return np.append(np.searchsorted(keys, edges), len(keys))


def rising(keys: np.ndarray) -> bytes:
    """Keys that rise, as their differences."""
    return planes(np.diff(keys, prepend=np.uint64(0)))


def distinct_keys(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, rising, which of them several rows of the block have, and the index of each key. Rows rise."""
    order = np.argsort(key, kind="stable")
    key, doc = key[order], doc[order]
    begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[: len(key)])
    ends = np.append(begins, len(key))[1:] - 1
    index = np.empty(len(key), np.int64)
    index[order] = np.repeat(np.arange(len(begins)), ends + 1 - begins)
    return key[begins], doc[begins] != doc[ends], index


def _more(times: np.ndarray) -> bytes:
    """How often each key counts, 65,536 at most: a bit for those that count more than once, and how much more."""
    more = np.minimum(times - 1, (1 << 16) - 1).astype("<u2")
    return np.packbits(more > 0).tobytes() + more[more > 0].tobytes() if more.any() else b""


def _from_more(data: bytes, n: int) -> np.ndarray:
    out = np.ones(n, np.int64)
    if data:
        bits = np.frombuffer(data, np.uint8, -(-n // 8))
        out[np.unpackbits(bits, count=n).astype(bool)] += np.frombuffer(data[len(bits) :], "<u2")
    return out


def shared_keys(
    blocks: DataFrame, own: Callable[[bytes, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray | None]], layout: Layout, folder: str, hot: int = 1000
) -> DataFrame:
    """(block, part, data): for each block and range the flags of its keys, read by `read_flags`: whether several rows
    have the key, and whether it counts more than `hot` times in all blocks. `own` gives a block's distinct keys, which of
    them several of its rows have, and how often each counts (None: once), from all texts and where each begins. Written
    below `folder`."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch["block"].to_pylist(), batch["data"].to_pylist(), strict=True):
                _, text, offs = unpack_block(data)
                key, several, times = own(text, offs)
                cuts = layout.borders(key)
                filled = np.flatnonzero(np.diff(cuts))
                columns = [
                    pa.array(filled.astype(np.int32)), pa.array([block] * len(filled), pa.int64()),
                    pa.array([rising(key[cuts[r] : cuts[r + 1]]) for r in filled], pa.binary()),
                    pa.array([np.packbits(several[cuts[r] : cuts[r + 1]]).tobytes() for r in filled], pa.binary()),
                    pa.array([b"" if times is None else _more(times[cuts[r] : cuts[r + 1]]) for r in filled], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["range", "block", "keys", "several", "more"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, _ in runs(batches, ["range"], ["range", "block", "keys", "several", "more"]):
            lists = [np.cumsum(numbers(x), dtype=np.uint64) for x in table["keys"].to_pylist()]
            several = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(k)) for x, k in zip(table["several"].to_pylist(), lists, strict=True)])
            keys, inverse, counts = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
            times = np.concatenate([_from_more(x, len(k)) for x, k in zip(table["more"].to_pylist(), lists, strict=True)])
            heavy = np.bincount(inverse, times, len(keys)) > hot
            shared = counts > 1
            shared[inverse[several.astype(bool)]] = True
            ends = np.cumsum([len(k) for k in lists])
            flags = [np.concatenate([np.packbits(x[inverse[end - len(k) : end]]) for x in (shared, heavy)]).tobytes() for end, k in zip(ends, lists, strict=True)]
            yield pa.RecordBatch.from_arrays([table["block"].combine_chunks(), table["range"].combine_chunks(), pa.array(flags, pa.binary())], names=["block", "part", "data"])

    lists = blocks.mapInArrow(listed, "range int, block long, keys binary, several binary, more binary")
    flags = lists.repartition("range").sortWithinPartitions("range", "block").mapInArrow(compared, "block long, part int, data binary")
    flags.write.parquet(f"{folder}/flags")
    return blocks.sparkSession.read.parquet(f"{folder}/flags")


def read_flags(flags: list[bytes], borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shared, and hot, for a block's distinct keys, from the flags of its ranges in order."""
    sizes = np.diff(borders)
    out, at = np.zeros((2, int(sizes.sum())), dtype=bool), 0
    for n, bits in zip(sizes[sizes > 0].tolist(), flags, strict=True):
        half = len(bits) // 2
        for k in range(2):
            out[k, at : at + n] = np.unpackbits(np.frombuffer(bits[k * half : (k + 1) * half], np.uint8), count=n)
        at += n
    return out[0], out[1]
