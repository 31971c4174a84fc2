"""Best-fit packing of documents into training sequences of several permitted lengths.

A document of more tokens than the longest permitted length is cut into pieces of that length and a rest. Pieces are
packed best-fit decreasing: each goes to the open bin with the least room that still holds it; if none does, a bin of
the size that costs least is opened. A bin costs its capacity plus a fixed charge, spread over the tokens that the
pieces still to come can fill it with, so the permitted lengths are weighed against each other at every opening. In the
end every bin is downsized to the smallest permitted length that holds its contents.

Packing a corpus needs no global order: pieces are dealt by a hash of the document to shards of `SHARD_TOKENS` tokens on
average, and each shard is packed by itself, from a sorted stream, by counting rooms. What a shard loses against packing
all at once is at most one bin that isn't full of each length. Shards grow in number with the corpus, not in size, and a
hash deals a hot source over all of them. Pieces of full length fill a bin each and are written without search.

Defined results: a null or empty text has no words but one end token, a piece of length 1. Rows that repeat are packed
each. Further columns are left out. The result has a row for each piece; its tokens are those from `start` on.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.text import WORD

CAPACITIES, SHARD_TOKENS, BIN_COST = (512, 1024, 2048, 4096), 4_000_000, 16


def best_fit(sizes: np.ndarray, capacities: tuple[int, ...] = CAPACITIES, bin_cost: int = BIN_COST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each piece, and each bin's capacity. `sizes` fall from the first on; none exceeds the greatest capacity."""
    caps, n = sorted(capacities), len(sizes)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    rooms: list[int] = []  # distinct rooms of open bins, rising
    open_bins: dict[int, list[int]] = {}
    filled: list[int] = []
    left = np.concatenate([np.cumsum(sizes[::-1])[::-1], [0]])  # tokens still to come from each piece on
    for i, size in enumerate(map(int, sizes)):
        at = bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            b = open_bins[room].pop()
            if not open_bins[room]:
                del open_bins[room], rooms[at]
        else:
            # cost by token of a size: what the pieces to come can fill of it shares its capacity and the fixed charge
            fits = [c for c in caps if c >= size]
            room = min(fits, key=lambda c: ((c + bin_cost) / min(c, int(left[i])), c))
            b = len(filled)
            filled.append(0)
        bins[i], offsets[i] = b, filled[b]
        filled[b] += size
        room -= size
        if room:
            if room not in open_bins:
                open_bins[room] = []
                insort(rooms, room)
            open_bins[room].append(b)
    return bins, offsets, np.array(caps)[np.searchsorted(caps, filled)] if filled else np.zeros(0, np.int64)


def count_tokens(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens): words and one end token of each row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)) + 1).cast("long").alias("n_tokens"))


def pack(lengths: DataFrame, capacities: tuple[int, ...] = CAPACITIES, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """doc_id, piece, start, n_tokens, shard, bin, offset, capacity: where each piece of each row of `lengths`
    (doc_id, n_tokens) lies. A bin is named by its shard and number."""
    longest = max(capacities)
    total = lengths.agg(F.sum("n_tokens")).first()[0] or 0
    shards = max(1, -(-int(total) // shard_tokens))
    pieces = lengths.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_tokens") - 1) / longest))))
    pieces = pieces.select(
        "doc_id", "piece", (F.col("piece") * longest).alias("start"), F.least(F.lit(longest), F.col("n_tokens") - F.col("piece") * longest).alias("n_tokens"),
        F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards)).cast("int").alias("shard"),
    )
    names = ["doc_id", "piece", "start", "n_tokens", "shard", "bin", "offset", "capacity"]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                table = pa.Table.from_batches(held).combine_chunks()
                bins, offsets, caps = best_fit(table["n_tokens"].to_numpy(), capacities)
                out = table.append_column("bin", pa.array(bins)).append_column("offset", pa.array(offsets))
                yield from out.append_column("capacity", pa.array(caps[bins])).select(names).to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            shard = batch["shard"].to_numpy()
            cuts = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1), len(shard)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                part = batch.slice(a, b - a)
                if held and held[0]["shard"][0].as_py() != shard[a]:
                    yield from flush()
                    held = []
                held.append(part)
        yield from flush()

    dealt = pieces.repartition("shard").sortWithinPartitions("shard", F.desc("n_tokens"), "doc_id", "piece")
    return dealt.mapInArrow(packed, "doc_id long, piece long, start long, n_tokens long, shard int, bin long, offset long, capacity long")
