"""MinHash near-duplicates by an LSH forest, with links confirmed on full shingle sets.

1. Each text gives its set of distinct 5-word shingles (as 64-bit hashes), 64 MinHash values and a 128-bit fingerprint
   of the set. Texts with equal sets are one from here on: their smallest doc_id stands for them.
2. The forest: 16 trees, each an order of the signatures that begins with other hash values. A tree's texts are sorted
   by their first four values and then, deeper, by the rest; texts that share at least the first four are a region. In a
   small region every pair is compared by its whole signature, which finds all neighbours down to that depth. A large
   region is sorted further and cut by depth: neighbours in the sorted order are joined as they are, whatever
   their common prefix, so a large region ends up in one candidate class and loses nothing.
   A pair with similarity 0.85 shares four values in none of 16 trees with probability 7e-6.
3. Candidate classes (connected components over those neighbours) are where links can be. Within a class the
   intersections of full sets are counted exactly, by an index of its shingles. A class of more than `BLOCK` texts is
   dealt out as pairs of blocks to many tasks, each holding two blocks; that work grows with the square of such a class.
4. Components over the confirmed links, and then over all members.

Regions and classes are read in sorted streams, never as one group in memory beyond `REGION` or two blocks of rows.

Defined results: a text that is null or has no word has an empty set and is its own component. Rows with one doc_id are
one vertex (with different texts, the set with the greatest fingerprint stands for it), each with its own row and
n_shingles. Rows with a null doc_id are linked with nothing and have a null component. Further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.components import components
from ledgerlake.llm.text import Tokens, mix, pieces, raw, runs, windows

SHINGLE, TREES, DEPTH, PERCENT = 5, 16, 4, 85
REGION, BLOCK, SMALL = 2048, 1500, 6
_N = TREES * DEPTH
_RANDOM = mix(np.arange(1, 2 * _N + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTOR, _SHIFT = (_RANDOM[:_N] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (_RANDOM[_N:] >> np.uint64(32)).astype(np.uint32)


def least_equal(percent: int) -> int:
    """Of 64 signature bytes a pair must share so many: five standard deviations below that similarity."""
    share = percent / 100
    return int(_N * (share - 5 * np.sqrt(share * (1 - share) / _N)))


def shingle_sets(texts: list[bytes], k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one after the other, and where each text's begin. A text with fewer
    than k words has one shingle, of all of them."""
    tokens = Tokens(t.lower() for t in texts)
    hashes = tokens.hashes()[tokens.ids] if len(tokens.ids) else np.zeros(0, np.uint64)
    lengths = np.diff(tokens.offs)
    full, counts = windows(hashes, tokens.offs, k)
    starts = np.concatenate([[0], np.cumsum(counts)])
    sets = []
    for i, n in enumerate(lengths):
        if n >= k:
            sets.append(np.unique(full[starts[i] : starts[i + 1]]))
        elif n:
            part = hashes[tokens.offs[i] : tokens.offs[i + 1]]
            sets.append(windows(part, np.array([0, n]), int(n))[0])
        else:
            sets.append(np.zeros(0, np.uint64))
    offs = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), offs


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, hash h of the text, n_shingles, fingerprint (f1, f2), the region key of each tree, and a byte of each MinHash value."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            sets, offs = shingle_sets(raw(piece))
            n = len(offs) - 1
            full = np.flatnonzero(np.diff(offs))
            low, prints = np.zeros((n, _N), np.uint32), np.zeros((n, 2), np.uint64)
            if len(full):
                cut = offs[:-1][full]
                prints[full, 0] = np.add.reduceat(mix(sets), cut)
                prints[full, 1] = np.add.reduceat(mix(sets ^ np.uint64(0x5851F42D4C957F2D)), cut)
                short = (sets >> np.uint64(32)).astype(np.uint32)
                for i in range(_N):
                    low[full, i] = np.minimum.reduceat((short ^ _SHIFT[i]) * _FACTOR[i], cut)
            keys = np.zeros((n, TREES), np.uint64)
            for t in range(TREES):
                key = np.full(n, t + 1, np.uint64)
                for i in range(t * DEPTH, (t + 1) * DEPTH):
                    key = mix(key) + low[:, i]
                keys[:, t] = mix(key)
            tops = np.ascontiguousarray((low * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8))
            arrays = [piece["doc_id"], piece["h"], pa.array(np.diff(offs)), *(pa.array(p.view(np.int64)) for p in np.ascontiguousarray(prints.T))]
            arrays += [pa.array(list(keys.view(np.int64)), pa.list_(pa.int64())), pa.array([r.tobytes() for r in tops], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "h", "n_shingles", "f1", "f2", "keys", "tops"])

    schema = "doc_id long, h long, n_shingles long, f1 long, f2 long, keys array<long>, tops binary"
    return _rows(docs).mapInArrow(signed, schema)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text", "xxhash64(cast(text as string)) h")


def _classes(linked: np.ndarray) -> np.ndarray:
    """The smallest index connected with each, from a symmetric boolean matrix."""
    n = len(linked)
    root = np.full(n, -1)
    for i in range(n):
        if root[i] >= 0:
            continue
        root[i], front = i, np.array([i])
        while len(front):
            reach = linked[front].any(axis=0) & (root < 0)
            front = np.flatnonzero(reach)
            root[front] = i
    return root


def _similar(tops: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs could be links, by signature and set size."""
    n, least = len(sizes), least_equal(percent)
    out = np.zeros((n, n), dtype=bool)
    for a in range(0, n, 32):
        equal = (tops[a : a + 32, None, :] == tops[None, :, :]).sum(axis=2, dtype=np.uint8)
        small, large = np.minimum(sizes[a : a + 32, None], sizes[None]), np.maximum(sizes[a : a + 32, None], sizes[None])
        out[a : a + 32] = (equal >= least) & (100 * small >= percent * large)
    return out


def forest_neighbours(texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(u, v): candidate neighbours among `texts` (doc_id, n_shingles, keys, tops), from all trees."""
    least = least_equal(percent)

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = None  # last row of the region part before, where the region goes on

        def emit(u, v):
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

        def small_regions(table: pa.Table) -> Iterator[pa.RecordBatch]:
            """All pairs of regions of up to SMALL rows, by their distance in the sorted order, for the whole table."""
            region, ids, sizes = (table[c].to_numpy() for c in ("region", "doc_id", "n_shingles"))
            tops = np.frombuffer(b"".join(table["tops"].to_pylist()), np.uint8).reshape(-1, _N)
            for gap in range(1, SMALL):
                at = np.flatnonzero(region[gap:] == region[:-gap])
                if not len(at):
                    break
                a, b = at, at + gap
                close = ((tops[a] == tops[b]).sum(axis=1) >= least) & (100 * np.minimum(sizes[a], sizes[b]) >= percent * np.maximum(sizes[a], sizes[b]))
                if close.any():
                    yield emit(ids[a[close]], ids[b[close]])

        waiting: list[pa.Table] = []
        n_waiting = 0
        for part, more in runs(batches, ["region"], ["region", "doc_id", "n_shingles", "tops"], REGION):
            if not more and tail is None and part.num_rows <= SMALL:
                if part.num_rows > 1:
                    waiting.append(part)
                    n_waiting += part.num_rows
                    if n_waiting >= 20_000:
                        yield from small_regions(pa.concat_tables(waiting))
                        waiting, n_waiting = [], 0
                continue
            ids = part["doc_id"].to_numpy()
            if more or tail is not None:  # a large region: neighbours in its order
                chain = ids if tail is None else np.concatenate([[tail], ids])
                yield emit(chain[:-1], chain[1:])
                tail = ids[-1] if more else None
            else:
                tops = np.frombuffer(b"".join(part["tops"].to_pylist()), np.uint8).reshape(-1, _N)
                root = _classes(_similar(tops, part["n_shingles"].to_numpy(), percent))
                at = np.flatnonzero(root != np.arange(len(root)))
                if len(at):
                    yield emit(ids[at], ids[root[at]])
        if waiting:
            yield from small_regions(pa.concat_tables(waiting))

    rows = texts.where("n_shingles > 0").select("doc_id", "n_shingles", "tops", F.explode("keys").alias("region"))
    # by range, so that a region of very many texts is spread over tasks in its order
    order = F.substring("tops", 1, 4)
    dealt = rows.repartitionByRange("region", order).sortWithinPartitions("region", "tops")
    return dealt.mapInArrow(neighbours, "u long, v long").distinct()


def exact_links(sets: np.ndarray, offs: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The symmetric matrix of links between texts, by counting their common shingles."""
    n, sizes = len(offs) - 1, np.diff(offs)
    doc = np.repeat(np.arange(n), sizes)
    _, ids = np.unique(sets, return_inverse=True)
    order = np.argsort(ids, kind="stable")
    posting, counts = doc[order], np.bincount(ids)
    begins = np.concatenate([[0], np.cumsum(counts)])
    linked = np.zeros((n, n), dtype=bool)
    for i in range(n):
        mine = ids[offs[i] : offs[i + 1]]
        mine = mine[counts[mine] > 1]
        if not len(mine):
            continue
        lengths = counts[mine]
        at = np.repeat(begins[mine] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        both = np.bincount(posting[at], minlength=n)
        linked[i] = 100 * both >= percent * (sizes[i] + sizes - both)
    np.fill_diagonal(linked, False)
    return linked


def confirmed_links(docs: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(u, v) that connect what is linked within each candidate class (vertex, h, component), on full sets. The text of
    a vertex is the one with hash h."""
    size = classes.groupBy("component").agg(F.count(F.lit(1)).alias("n"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = classes.join(size, "component").select(
        F.col("vertex").alias("doc_id"), "h", "component", blocks.alias("blocks"), F.pmod(F.xxhash64("vertex"), blocks).cast("int").alias("block")
    )
    # a text goes to every pair of blocks that has its own
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("doc_id", "h", "component", F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"))

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _ in runs(batches, ["component", "a", "b"], ["component", "a", "b", "doc_id", "sets"]):
            if part.num_rows < 2:
                continue
            packed = part["sets"].to_pylist()
            offs = np.concatenate([[0], np.cumsum([len(p) // 8 for p in packed])])
            ids, sets = part["doc_id"].to_numpy(), np.frombuffer(b"".join(packed), np.uint64)
            root = _classes(exact_links(sets, offs, percent))
            at = np.flatnonzero(root != np.arange(len(root)))
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(ids[root[at]])], names=["u", "v"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            sets, offs = shingle_sets(raw(piece))
            rows = [sets[a:b].tobytes() for a, b in zip(offs[:-1], offs[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([piece["doc_id"], piece["component"], piece["a"], piece["b"], pa.array(rows, pa.binary())], names=["doc_id", "component", "a", "b", "sets"])

    texts = _rows(docs).join(dealt, ["doc_id", "h"]).dropDuplicates(["doc_id", "h", "component", "a", "b"])
    held = texts.mapInArrow(packed, "doc_id long, component long, a int, b int, sets binary")
    held = held.repartition("component", "a", "b").sortWithinPartitions("component", "a", "b", "doc_id")
    return held.mapInArrow(linked, "u long, v long")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (doc_id = component_id) of every row of `docs` (doc_id, text). Texts are
    linked from `percent` of common shingles on; below 80 the forest misses more than two in ten thousand at the edge."""
    signed = signatures(docs).checkpoint()
    real = signed.where("n_shingles > 0 and doc_id is not null")
    prints = ["n_shingles", "f1", "f2"]
    # an id stands with one set, equal sets with their smallest id
    one = real.groupBy("doc_id").agg(F.max(F.struct(*prints, "h")).alias("p")).select("doc_id", "p.*")
    first = one.groupBy(*prints).agg(F.min("doc_id").alias("rep"))
    member = one.join(first, prints).select("doc_id", "h", "rep").checkpoint()
    chosen = member.where("doc_id = rep").select("doc_id", "h")
    forest = real.join(chosen, ["doc_id", "h"], "left_semi").dropDuplicates(["doc_id"])
    classes = components(forest_neighbours(forest, percent)).join(chosen.withColumnRenamed("doc_id", "vertex"), "vertex").checkpoint()
    linked = components(confirmed_links(docs, classes, percent))
    whole = member.join(linked.withColumnRenamed("vertex", "rep"), "rep", "left").select(
        "doc_id", F.coalesce("component", "rep").alias("component")
    )
    out = signed.select("doc_id", "n_shingles").join(whole, "doc_id", "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
