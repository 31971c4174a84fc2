"""Prefix trie of conversations, in flat arrays behind a minimal perfect hash.

1. Conversations are rebuilt: conversation c takes the first h turns of conversation c - c % `FAMILY`, h being crc32 of its
   number modulo `HEADS`, then its own turns after its first h. Turns are digests of role and text from the start, so texts
   aren't shuffled. Sorted by conversation, each row extends the digest of the prefix before it, in a stream: a
   conversation is never held as a whole.
2. Distinct prefix digests are the nodes. They are counted with a combine before the shuffle, so a first turn that very
   many conversations share is one row for each task. Members of a node must agree in its parent, last turn and depth, or
   the job stops: no collision of digests passes unseen.
3. Nodes with at most `limit` members hang in light subtrees, which go whole to a shard each; a shard takes many. The
   shard builds a minimal perfect hash of its digests, level by level: a digest that meets no other in a level's table
   has its slot there, the others go on. Slots are verified by the digest they hold. Counts are scattered into arrays by
   slot, parents looked up as slots, and subtrees summed through them, deepest level first.
4. What remains, nodes with more than `limit` members, is at most a `limit`-th of all rows; the sums of the light
   subtrees are scattered in with them, and the same arrays finish the top.

`limit` is a thousand, or a millionth of all rows where that is more, so the top stays within a million nodes, and a light
subtree within `limit` times the length of its conversations. A node's ends are hashed in a sorted stream.

Defined results: rows without conv_id are left out; turns with equal numbers are ordered by their digest; null
roles and texts are empty; a table without rows has no nodes, not even the root. Further columns are left out.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.blocks import scratch_folder
from ledgerlake.llm.text import mix

FAMILY, HEADS = 100, 6
LEAST_LIMIT, MOST_TOP, CHUNK = 1000, 1_000_000, 50_000
ROOT = bytes(16)
_ROW = ["node", "parent", "key", "depth", "size", "conv_id", "last"]


def _head(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def prefixes(conversations: DataFrame) -> DataFrame:
    """A row for each rebuilt conversation and prefix, the empty one included: node and parent (digests of the prefix and
    of that before), key (of the last turn), depth, size (code points of the last text), conv_id, and whether it is the whole."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("key"),
        F.length(text).cast("long").alias("size"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "key")
    heads = turns.where(F.col("conv_id") % FAMILY == 0).withColumn("nth", F.row_number().over(order)).where(F.col("nth") < HEADS)
    heads = heads.select(F.col("conv_id").alias("family"), "nth", "key", "size")
    known = turns.select("conv_id").distinct().withColumn("family", F.col("conv_id") - F.col("conv_id") % FAMILY)
    taken = known.join(heads, "family").where(F.col("nth") <= _head(F.col("conv_id")))
    rows = taken.select("conv_id", "nth", F.lit(None).cast(turns.schema["turn"].dataType).alias("turn"), "key", "size").unionByName(
        turns.withColumn("nth", F.lit(HEADS))
    )
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "nth", "turn", "key").select("conv_id", "nth", "key", "size")

    def extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, skip, depth, node = None, 0, 0, ROOT
        out: list[tuple] = []

        def rows(whole: bool) -> pa.RecordBatch:
            """What can go: the last row waits until it is known whether its conversation goes on."""
            nonlocal out
            ready, out = (out, []) if whole else (out[:-1], out[-1:])
            following = [x[5] for x in [*ready, *out][1:]]
            last = [x[5] != y for x, y in zip(ready, following, strict=False)] + [True] * (whole and len(ready) > 0)
            columns = [*(list(zip(*ready, strict=True)) or [()] * 6), last]
            kinds = [pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=_ROW)

        for batch in batches:
            for conv, nth, key, size in zip(*(batch[c].to_pylist() for c in ("conv_id", "nth", "key", "size")), strict=True):
                if conv != now:
                    now, skip, depth, node = conv, zlib.crc32(str(conv).encode()) % HEADS, 0, ROOT
                    out.append((ROOT, None, b"", 0, 0, conv))
                if nth == HEADS and skip:  # an own turn that the family's replaces
                    skip -= 1
                    continue
                parent, depth = node, depth + 1
                node = hashlib.blake2b(parent + key, digest_size=16).digest()
                out.append((node, parent, key, depth, size, conv))
            yield rows(False)
        yield rows(True)

    return dealt.mapInArrow(extended, "node binary, parent binary, key binary, depth int, size long, conv_id long, last boolean")


class PerfectTable:
    """Slots 0 to n-1 for n distinct 128-bit digests (rows of two numbers), verified on each look-up."""

    def __init__(self, digests: np.ndarray, spare: float = 2.0):
        self.levels: list[tuple[np.uint64, np.ndarray]] = []
        left, used = np.arange(len(digests)), 0
        self.held = np.zeros_like(digests)
        while len(left):
            if len(self.levels) == 200:
                raise ValueError("equal digests in one table")
            size = np.uint64(max(8, int(spare * len(left))))
            at = self._place(digests[left], size)
            alone = np.bincount(at.astype(np.int64), minlength=int(size)) == 1
            slots = np.where(alone, used + np.cumsum(alone) - 1, -1)
            settled = alone[at]
            self.held[slots[at[settled]]] = digests[left[settled]]
            used += int(alone.sum())
            self.levels.append((size, slots))
            left = left[~settled]

    def _place(self, digests: np.ndarray, size: np.uint64, level: int | None = None) -> np.ndarray:
        seed = 0x9E3779B97F4A7C15 * (1 + (len(self.levels) if level is None else level)) % (1 << 64)
        return mix(digests[:, 0] + np.uint64(seed) ^ digests[:, 1]) % size

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """The slot of each digest, -1 where the table has it not."""
        out, left = np.full(len(digests), -1, np.int64), np.arange(len(digests))
        for level, (size, slots) in enumerate(self.levels):
            found = slots[self._place(digests[left], size, level)]
            out[left] = found
            left = left[found < 0]
        at = np.flatnonzero(out >= 0)
        wrong = (self.held[out[at]] != digests[at]).any(axis=1)
        out[at[wrong]] = -1
        return out


def _digests(column: pa.Array) -> np.ndarray:
    """128-bit digests as rows of two numbers; null as the greatest."""
    return np.frombuffer(b"".join(x or b"\xff" * 16 for x in column.to_pylist()), np.uint64).reshape(-1, 2)


def subtree_sums(table: pa.Table) -> list[np.ndarray]:
    """For rows with distinct nodes: the row of the parent (-1 where it isn't here), children, leaves and saved tokens
    of the whole subtree. Columns children, leaves and saved hold what hangs below from elsewhere."""
    nodes, n = _digests(table["node"]), table.num_rows
    hashed = PerfectTable(nodes)
    slot = hashed.slots(nodes)
    parent = np.full(n, -1, np.int64)
    parent[slot] = hashed.slots(_digests(table["parent"]))
    row = np.empty(n, np.int64)
    row[slot] = np.arange(n)

    def scattered(column: str) -> np.ndarray:
        out = np.zeros(n, np.int64)
        out[slot] = table[column].to_numpy()
        return out

    depth = scattered("depth")
    children = scattered("children") + np.bincount(parent[parent >= 0], minlength=n)
    leaves = scattered("leaves") + (children == 0)
    saved = scattered("saved") + (scattered("n_convs") - 1) * scattered("size")
    order = np.argsort(-depth, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        level = level[parent[level] >= 0]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    return [np.where(parent[slot] >= 0, row[parent[slot]], -1), children[slot], leaves[slot], saved[slot]]


_NODE = ["node", "parent", "conv_id", "depth", "size", "n_convs", "children", "leaves", "saved"]
_SUMMED = "node binary, parent binary, conv_id long, depth int, size long, n_convs long, children long, leaves long, saved long, parent_conv_id long, inner boolean"


def _summed(table: pa.Table) -> pa.RecordBatch:
    parent, children, leaves, saved = subtree_sums(table)
    conv = table["conv_id"].to_numpy()
    inner = parent >= 0
    arrays = [table[c].combine_chunks() for c in _NODE[:6]] + [pa.array(x) for x in (children, leaves, saved)]
    arrays += [pa.array(conv[np.maximum(parent, 0)], mask=~inner), pa.array(inner)]
    return pa.RecordBatch.from_arrays(arrays, names=[*_NODE, "parent_conv_id", "inner"])


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard; whole shards are summed together, about CHUNK rows at a time."""
    held: list[pa.Table] = []
    size, enough = 0, CHUNK
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        size += batch.num_rows
        if size >= enough:
            table = pa.concat_tables(held)
            last = table["shard"][-1].as_py()
            cut = table.num_rows - 1
            while cut and table["shard"][cut - 1].as_py() == last:
                cut -= 1
            if cut:
                yield _summed(table.slice(0, cut))
            held, size = [table.slice(cut)], table.num_rows - cut
            enough = max(CHUNK, 2 * size)
    if size:
        yield _summed(pa.concat_tables(held))


def _ends(rows: DataFrame) -> DataFrame:
    """(node, ends_sha256) of nodes at which conversations end."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, hashlib.sha256()
        for batch in batches:
            out = []
            for node, conv in zip(batch["node"].to_pylist(), batch["conv_id"].to_pylist(), strict=True):
                if node != now:
                    if now is not None:
                        out.append((now, state.hexdigest()))
                    now, state = node, hashlib.sha256(str(conv).encode())
                else:
                    state.update(b",%d" % conv)
            nodes, texts = zip(*out, strict=True) if out else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(texts, pa.string())], names=["node", "ends_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])

    ends = rows.where("last").select("node", "conv_id")
    return ends.repartition("node").sortWithinPartitions("node", "conv_id").mapInArrow(hashed, "node binary, ends_sha256 string")


def conversation_trie(conversations: DataFrame, limit: int | None = None) -> DataFrame:
    """A row for each node: node (its digest), parent, depth, conv_id and parent_conv_id (smallest members), n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256."""
    spark = conversations.sparkSession
    folder = scratch_folder(spark)
    prefixes(conversations).write.parquet(f"{folder}/prefixes")
    rows = spark.read.parquet(f"{folder}/prefixes")
    if limit is None:
        limit = max(LEAST_LIMIT, rows.count() // MOST_TOP)
    one = {c: (F.min(c), F.max(c)) for c in ("parent", "key", "depth", "size")}
    agree = F.lit(True)
    for least, most in one.values():
        agree &= least.eqNullSafe(most)
    nodes = rows.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), agree.alias("agree"), *(F.min(c).alias(c) for c in ("parent", "depth", "size"))
    )
    checked = F.when(~F.col("agree"), F.raise_error(F.lit("two prefixes have one digest")).cast("long")).otherwise(F.col("n_convs"))
    nodes = nodes.select("node", "parent", "conv_id", "depth", "size", checked.alias("n_convs"))
    nodes.write.parquet(f"{folder}/nodes")
    nodes = spark.read.parquet(f"{folder}/nodes")

    # a light subtree hangs below the deepest node of its conversations that has more than `limit` members
    top = nodes.where(F.col("n_convs") > limit)
    deepest = rows.select("node", "conv_id", "depth").join(top.select("node"), "node", "left_semi").groupBy("conv_id").agg(F.max("depth").alias("above"))
    at = rows.select("conv_id", "depth", "node").join(deepest, "conv_id", "left").where(F.col("depth") == F.coalesce(F.col("above") + 1, F.lit(0)))
    nothing = [F.lit(0).cast("long").alias(c) for c in ("children", "leaves", "saved")]
    light = nodes.where(F.col("n_convs") <= limit).join(at.select("conv_id", F.col("node").alias("shard")), "conv_id")
    light = light.select(*_NODE[:6], *nothing, "shard").repartition("shard").sortWithinPartitions("shard").mapInArrow(_by_shard, _SUMMED)
    light.write.parquet(f"{folder}/light")
    light = spark.read.parquet(f"{folder}/light")

    hanging = light.where("not inner and parent is not null")
    below = hanging.groupBy("parent").agg(F.count(F.lit(1)).alias("c"), F.sum("leaves").alias("l"), F.sum("saved").alias("s")).withColumnRenamed("parent", "node")
    sums = [F.coalesce(c, F.lit(0).cast("long")).alias(n) for c, n in ((F.col("c"), "children"), (F.col("l"), "leaves"), (F.col("s"), "saved"))]

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if held:
            yield _summed(pa.concat_tables(held))

    # at most MOST_TOP nodes
    heavy = top.join(below, "node", "left").select(*_NODE[:6], *sums).repartition(1).mapInArrow(whole, _SUMMED)
    heavy.write.parquet(f"{folder}/heavy")
    heavy = spark.read.parquet(f"{folder}/heavy")

    above = heavy.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    hanging = light.where("not inner").drop("parent_conv_id").join(above, "parent", "left")
    every = light.where("inner").unionByName(hanging).unionByName(heavy)
    none = hashlib.sha256(b"").hexdigest()
    return every.join(_ends(rows), "node", "left").select(
        "node", "parent", "conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"),
    )
