"""Language-model scores from a weighted backoff automaton over smoothed n-grams.

States are the n-grams seen in training (contexts of up to `order - 1` words) and a root. From a state an arc leads on
for each word seen after it, and a failure arc to the state of its shorter suffix. With c the training count of an
n-gram and h its context,

    arc:      log10 (c(h,w) + m p(w|h')) / (c(h) + m)        failure:  log10 m / (c(h) + m)
    root:     log10 (c(w) + 0.5) / (N + 0.5 (V + 1))

so probabilities over all words and one unknown word sum to one in each state (Dirichlet smoothing with the shorter
context's distribution as prior of mass m). A text is walked once from left to right; the state is the longest known suffix.

The automaton of a corpus has no bounded size, so it is never broadcast nor loaded whole:

1. Texts are packed into blocks of a few megabytes, compressed and written to the shared folder.
2. A block lists the hashes of its distinct n-grams with their counts in its training texts, sorted and cut into ranges of
   hashes. Listing an n-gram is at once the request for its total. One shuffle brings each range's lists together;
   their totals are added up and sent back for every list, in its order, and written.
3. A block meets its totals and has all arcs of the automaton that its texts can reach. All texts of a block walk it.

N-grams are 64-bit hashes throughout. A hot word is one hash in a list per block, so it weighs no more than any other.

Defined results: a null or empty text is one end token. A null id counts as training. Rows that repeat are learned from
and scored each. Without training texts every word has probability 1. Further columns are left out.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.text import Tokens, crc_fold, mix, pieces, raw, runs

ORDER, MASS, BLOCK_BYTES, RANGE_BITS = 2, 20.0, 5 << 19, 8
END, START = b"\n", np.uint64(0x3C733E)  # the end token is no word, as words have no line ends


@dataclass
class Grams:
    """Distinct n-grams of a block. `keys` rise; `at[k]` is, for each token, the place of the k+1-gram that ends there,
    or -1 where the text is too short; `context[k]` that of its context."""

    keys: np.ndarray
    counts: np.ndarray
    at: list[np.ndarray]
    context: list[np.ndarray]


def block_grams(tokens: Tokens, training: np.ndarray, order: int = ORDER) -> Grams:
    """N-grams up to `order`; a text is preceded by one start sign, whose count is that of the texts."""
    hashes = mix(tokens.hashes())[tokens.ids] if len(tokens.ids) else np.zeros(0, np.uint64)
    n, first = len(hashes), np.zeros(len(hashes), dtype=bool)
    starts = tokens.offs[:-1][np.diff(tokens.offs) > 0]
    first[starts] = True
    learned = np.repeat(training, np.diff(tokens.offs)).astype(np.int64)
    begin = mix(np.full(1, START))[0]
    keys, contexts, valid = [hashes], [], [np.ones(n, dtype=bool)]
    context = np.where(first, begin, np.concatenate([[begin], hashes[:-1]]) if n else hashes)
    place = np.arange(n) - np.repeat(tokens.offs[:-1], np.diff(tokens.offs))
    for k in range(2, order + 1):
        contexts.append(context)
        # the (k-1)-gram before, and the word; a text's beginning has the start sign as its only context before
        keys.append(mix(context * np.uint64(2 * k + 1) + hashes))
        valid.append(place >= k - 2)
        context = np.concatenate([[begin], keys[-1][:-1]]) if n else hashes
    everything = np.concatenate([begin[None] if n else hashes, *keys])
    weights = np.concatenate([[int(training.sum())] if n else [], learned, *(learned * v for v in valid[1:])])
    found, inverse = np.unique(everything, return_inverse=True)
    counts = np.bincount(inverse, weights, len(found)).astype(np.int64)
    at = [np.where(v, inverse[1 + i * n : 1 + (i + 1) * n], -1) for i, v in enumerate(valid)]
    where = [np.searchsorted(found, c) for c in contexts]
    return Grams(found, counts, at, where)


def walk(grams: Grams, totals: np.ndarray, n_tokens: int, n_words: int, mass: float = MASS) -> tuple[np.ndarray, np.ndarray]:
    """log10 probability of every token by the root alone, and by the automaton. Totals are in the order of `grams.keys`."""
    denominator = n_tokens + 0.5 * (n_words + 1)
    base = np.log10((totals[grams.at[0]] + 0.5) / denominator)
    p = 10**base
    for at, context in zip(grams.at[1:], grams.context, strict=True):
        state = totals[context]  # how often the context was seen; none: not a state, and the shorter one holds
        seen = np.where(at >= 0, totals[at], 0)
        known = (state > 0) & (at >= 0)
        p = np.where(known, (seen + mass * p) / (state + mass), p)
    return base, np.log10(p)


def _pack(ids: list, texts: list[bytes]) -> bytes:
    table = pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.large_binary())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return zstandard.ZstdCompressor(level=1).compress(sink.getvalue().to_pybytes())


def _unpack(block: bytes) -> tuple[list, list[bytes]]:
    table = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(block)).read_all()
    return table["doc_id"].to_pylist(), table["text"].to_pylist()


def _planes(values: np.ndarray) -> bytes:
    """Whole numbers in as many bytes as the greatest needs: that width, then all lowest bytes, all second ones, and so
    on, so that what is mostly zero lies together and packs well."""
    values = values.astype(np.uint64)
    width = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    return bytes([width]) + np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _numbers(data) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8)
    width = int(planes[0])
    out = np.zeros(((len(planes) - 1) // width, 8), np.uint8)
    out[:, :width] = planes[1:].reshape(width, -1).T
    return out.view(np.uint64).reshape(-1)


def _ranges(keys: np.ndarray, bits: int = RANGE_BITS) -> np.ndarray:
    """Where each of 2^bits ranges of hashes begins in rising keys, and the end."""
    borders = (np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).astype(np.uint64)
    return np.append(np.searchsorted(keys, borders), len(keys))


def _folder(spark) -> str:
    base = spark.sparkContext.getCheckpointDir()
    return f"{base}/{uuid.uuid4()}"


def score_texts(docs: DataFrame, train_rest: int = 1, order: int = ORDER, mass: float = MASS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row. Texts whose
    crc32(doc_id) modulo 5 is `train_rest` are held out of the training."""
    spark = docs.sparkSession
    folder = _folder(spark)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId() if TaskContext.get() else 0, 0
        ids: list = []
        texts: list[bytes] = []
        size = 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([task * (1 << 32) + number], pa.int64()), pa.array([_pack(ids, texts)], pa.binary())], names=["block", "data"])

        for piece in pieces(batches, "text"):
            ids += piece["doc_id"].to_pylist()
            texts += raw(piece)
            size += sum(map(len, texts[-piece.num_rows :]))
            if size >= BLOCK_BYTES:
                yield block()
                ids, texts, size, number = [], [], 0, number + 1
        if ids:
            yield block()

    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    rows.mapInArrow(packed, "block long, data binary").write.parquet(f"{folder}/blocks")
    blocks = spark.read.parquet(f"{folder}/blocks")

    def read_block(data: bytes) -> tuple[list, np.ndarray, Tokens, Grams]:
        ids, texts = _unpack(data)
        training = crc_fold(ids) != train_rest
        training |= np.array([i is None for i in ids], dtype=bool)
        tokens = Tokens((t.lower() for t in texts), END)
        return ids, training, tokens, block_grams(tokens, training, order)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch["block"].to_pylist(), batch["data"].to_pylist(), strict=True):
                _, training, tokens, grams = read_block(data)
                cuts = _ranges(grams.keys)
                # which keys are single words: they make up N and V
                single = np.zeros(len(grams.keys), np.uint64)
                single[grams.at[0]] = 1
                mixed = (grams.counts.astype(np.uint64) << np.uint64(1)) | single
                keys = np.diff(grams.keys, prepend=np.uint64(0))
                filled = np.flatnonzero(np.diff(cuts))
                lists = [_planes(np.concatenate([grams.keys[cuts[r] : cuts[r] + 1], keys[cuts[r] + 1 : cuts[r + 1]]])) for r in filled]
                counts = [_planes(mixed[cuts[r] : cuts[r + 1]]) for r in filled]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(filled.astype(np.int32)), pa.array([block] * len(filled), pa.int64()), pa.array(lists, pa.binary()), pa.array(counts, pa.binary())],
                    names=["range", "block", "keys", "counts"],
                )

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, _ in runs(batches, ["range"], ["range", "block", "keys", "counts"]):
            lists = [np.cumsum(_numbers(x.as_buffer()), dtype=np.uint64) for x in table["keys"]]
            mixed = np.concatenate([_numbers(x.as_buffer()) for x in table["counts"]])
            keys, inverse = np.unique(np.concatenate(lists), return_inverse=True)
            totals = np.bincount(inverse, (mixed >> np.uint64(1)).astype(np.float64), len(keys)).astype(np.uint64)
            single = np.zeros(len(keys), dtype=bool)
            single[inverse[(mixed & np.uint64(1)).astype(bool)]] = True
            ends = np.cumsum([len(x) for x in lists])
            # the range's share of N and V travels with its first list
            n_tokens, n_words = int(totals[single].sum()), int((single & (totals > 0)).sum())
            for k, (block, end, values) in enumerate(zip(table["block"].to_pylist(), ends, lists, strict=True)):
                mine = totals[inverse[end - len(values) : end]]
                yield pa.RecordBatch.from_arrays(
                    [table["range"].chunk(0).slice(0, 1), pa.array([block], pa.int64()), pa.array([_planes(mine)], pa.binary()), pa.array([0 if k else n_tokens], pa.int64()), pa.array([0 if k else n_words], pa.int64())],
                    names=["range", "block", "totals", "tokens", "words"],
                )

    lists = blocks.mapInArrow(listed, "range int, block long, keys binary, counts binary")
    totals = lists.repartition("range").sortWithinPartitions("range", "block").mapInArrow(added, "range int, block long, totals binary, tokens long, words long")
    totals.write.parquet(f"{folder}/totals")
    totals = spark.read.parquet(f"{folder}/totals")
    corpus = totals.agg(F.sum("tokens"), F.sum("words")).first()
    n_tokens, n_words = int(corpus[0] or 0), int(corpus[1] or 0)

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, _ in runs(batches, ["block"], ["block", "range", "data"]):
            data = table["data"].to_pylist()  # the texts first, then the totals by range
            ids, training, tokens, grams = read_block(data[0])
            sums = np.concatenate([_numbers(d) for d in data[1:]]).astype(np.float64)
            del table, data
            base, full = walk(grams, sums, n_tokens, n_words, mass)
            known = sums[grams.at[0]] > 0
            cut = tokens.offs[:-1]  # every text has its end token
            arrays = [
                pa.array(ids, pa.int64()), pa.array(~training), pa.array(np.diff(tokens.offs)), pa.array(np.add.reduceat(known.astype(np.int64), cut)),
                pa.array(np.full(len(ids), n_tokens)), pa.array(np.add.reduceat(base, cut)), pa.array(np.add.reduceat(full, cut)),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    both = blocks.select("block", F.lit(-1).alias("range"), "data").unionByName(totals.select("block", "range", F.col("totals").alias("data")))
    both = both.repartition("block").sortWithinPartitions("block", "range")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return both.mapInArrow(walked, schema)
