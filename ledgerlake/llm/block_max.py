"""Ranked lexical search over an inverted index, by Block-Max MaxScore.

1. The index: texts are cut into shards of about `SHARD_BYTES`. A shard has its lexicon, lengths of its documents, and a
   posting list for each term, in blocks of `BLOCK` postings. Gaps between documents and occurrences are packed into as
   many bytes as the block's largest needs; beside each block stand its last document, its greatest number of occurrences and
   its smallest document length, from which a bound of its scores follows whatever the corpus turns out to be.
2. Document counts, lengths and document frequencies are sums over the shards' headers.
3. A task searches its shards one after the other and keeps, for each query, the best scores so far. Lists of a query stand
   in the order of their bounds; as long as the smallest ones together stay below the k-th best score they are not
   essential: a document in none of the others can't be among the best. Documents of the essential lists are scored,
   then looked up in the non-essential lists, the most promising first: documents whose score so far, with the bound of
   the block they would be in and of the lists left, stays below the k-th best are rejected before a block is unpacked.
4. The tasks' best are merged: a window by query keeps the k best of each partition before its shuffle.

A score is the sum over the query's distinct terms of w * ((10^9 tf) div (1000 tf + 20 m)), m = 50 + (50 n N) div L, and
w = floor(1000 ln((2N + 2) / (2 df + 1))), with N documents that have a term, L terms in all, n in the document.

Queries go to every task: at most `MOST_QUERY_BYTES` of text at a time, larger sets in several passes over the index.

Defined results: null and empty texts have no terms and are never found; a query without known terms finds nothing. Rows
with one doc_id are documents of their own. Equal scores go by rising doc_id, null last. Rows of the queries with one id
are one query; those without an id are left out. Further columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.blocks import numbers, planes
from ledgerlake.llm.text import Tokens, pieces, raw

SHARD_BYTES, BLOCK, MOST_QUERY_BYTES = 6 << 20, 64, 8 << 20
#: Letters, digits and all that isn't ASCII make up terms; A-Z are lowered.
_TO_TERMS = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))
_INDEX = "doc_ids binary, unknown binary, lengths binary, n_docs long, n_terms long, lexicon binary, frequencies binary, heads binary, postings binary"


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TO_TERMS).split()


def _packed(values: np.ndarray, width: np.ndarray, at: np.ndarray, out: np.ndarray) -> None:
    """Write values of `width` bytes each to the places `at`, lowest byte first."""
    for k in range(int(width.max(initial=0))):
        wide = width > k
        out[at[wide] + k] = (values[wide] >> (8 * k)) & 0xFF


def _widths(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Bytes that the largest value of each run needs."""
    most = np.maximum.reduceat(values, begins)
    return 1 + (most > 0xFF) + (most > 0xFFFF) + (most > 0xFFFFFF)


def index_shard(ids: list, texts: list[bytes]) -> pa.RecordBatch:
    """The index of some documents, as one row."""
    tokens = Tokens(t.translate(_TO_TERMS) for t in texts)
    names = sorted(tokens.vocab)
    rank = np.empty(len(names), np.int64)
    rank[np.fromiter(map(tokens.vocab.__getitem__, names), np.int64, len(names))] = np.arange(len(names))
    n, lengths = len(texts), np.diff(tokens.offs)
    pairs, tf = np.unique(rank[tokens.ids] * n + tokens.docs() if len(tokens.ids) else tokens.ids, return_counts=True)
    term, doc = pairs // n, pairs % n
    frequency = np.bincount(term, minlength=len(names))
    begins = np.cumsum(frequency) - frequency
    nth = np.arange(len(term)) - begins[term]
    starts = np.flatnonzero(nth % BLOCK == 0)  # of blocks
    heads = np.zeros((5, 0), np.int64)
    out = np.zeros(0, np.uint8)
    if len(term):
        sizes = np.diff(np.append(starts, len(term)))
        gaps = np.diff(doc, prepend=0)
        gaps[nth == 0] = doc[nth == 0]
        gap_width, tf_width = _widths(gaps, starts), _widths(tf, starts)
        ends = np.cumsum(sizes * (gap_width + tf_width))
        block = np.repeat(np.arange(len(starts)), sizes)
        place = np.arange(len(term)) - starts[block]
        first = (ends - sizes * (gap_width + tf_width))[block]
        out = np.zeros(int(ends[-1]), np.uint8)
        _packed(gaps, gap_width[block], first + place * gap_width[block], out)
        _packed(tf, tf_width[block], first + sizes[block] * gap_width[block] + place * tf_width[block], out)
        heads = np.stack([doc[starts + sizes - 1], np.maximum.reduceat(tf, starts), np.minimum.reduceat(lengths[doc], starts), gap_width, tf_width])
    known = np.array([0 if i is None else i for i in ids], np.int64)
    row = [
        known.tobytes(), np.packbits([i is None for i in ids]).tobytes(), planes(lengths), int((lengths > 0).sum()), int(lengths.sum()),
        zstandard.ZstdCompressor(level=3).compress(b" ".join(names)), planes(frequency), b"".join(len(p).to_bytes(8, "little") + p for p in map(planes, heads)), out.tobytes(),
    ]
    kinds = [pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names=[c.split()[0] for c in _INDEX.split(", ")])


def build_index(docs: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The index of all rows of `docs` (doc_id, text), written to a folder that all executors reach; a row for each shard."""

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[bytes] = []
        size = 0
        for piece in pieces(batches, "text"):
            ids += piece["doc_id"].to_pylist()
            texts += raw(piece)
            size += sum(map(len, texts[-piece.num_rows :]))
            if size >= shard_bytes:
                yield index_shard(ids, texts)
                ids, texts, size = [], [], 0
        if ids:
            yield index_shard(ids, texts)

    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    rows.mapInArrow(indexed, _INDEX).write.parquet(folder)
    return docs.sparkSession.read.parquet(folder)


@dataclass
class Corpus:
    """What scores need to know of all documents. N, L, and the weights of the terms that are asked for."""

    n: int
    l: int  # noqa: E741
    weights: dict[bytes, int]

    def damping(self, lengths: np.ndarray) -> np.ndarray:
        return 50 + (50 * lengths * self.n) // self.l

    @staticmethod
    def saturated(tf: np.ndarray, damping: np.ndarray) -> np.ndarray:
        return (1_000_000_000 * tf) // (1000 * tf + 20 * damping)


def corpus_of(index: DataFrame, asked: set[bytes]) -> Corpus:
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lexicon, frequencies in zip(batch["lexicon"].to_pylist(), batch["frequencies"].to_pylist(), strict=True):
                names = zstandard.ZstdDecompressor().decompress(lexicon).split()
                frequency = numbers(frequencies).astype(np.int64)
                found = [(x, k) for k, x in enumerate(names) if x in asked]
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.binary()), pa.array([int(frequency[k]) for _, k in found], pa.int64())], names=["term", "df"])

    total = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n, length = int(total[0] or 0), int(total[1] or 0)
    found = index.select("lexicon", "frequencies").mapInArrow(counted, "term binary, df long").groupBy("term").agg(F.sum("df").alias("df"))
    # as many rows as terms are asked for
    weights = {bytes(r["term"]): math.floor(1000 * math.log((2 * n + 2) / (2 * r["df"] + 1))) for r in found.toLocalIterator()}
    return Corpus(n, length, {t: w for t, w in weights.items() if w > 0})


class Postings:
    """One term's list in a shard."""

    def __init__(self, shard: Shard, term: int, weight: int):
        a, b = shard.block_begins[term], shard.block_begins[term + 1]
        self.shard, self.weight, self.blocks = shard, weight, slice(a, b)
        self.last = shard.heads[0][a:b]
        #: the most a document of each block can get from this term
        self.bounds = weight * shard.corpus.saturated(shard.heads[1][a:b], shard.least_damping[a:b])
        self.bound = int(self.bounds.max())

    def unpacked(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of some of the blocks."""
        docs, counts = [], []
        for k in which.tolist():
            at, size, gap_width, tf_width = (int(x[self.blocks.start + k]) for x in (self.shard.at, self.shard.sizes, *self.shard.heads[3:]))
            middle = at + size * gap_width
            gaps = _unpacked(self.shard.postings[at:middle], gap_width)
            docs.append(np.cumsum(gaps) + (int(self.last[k - 1]) if k else 0))
            counts.append(_unpacked(self.shard.postings[middle : middle + size * tf_width], tf_width))
        doc, tf = np.concatenate(docs), np.concatenate(counts)
        return doc, self.weight * self.shard.corpus.saturated(tf, self.shard.damping[doc])

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        return self.unpacked(np.arange(len(self.last)))


def _unpacked(data: np.ndarray, width: int) -> np.ndarray:
    if width == 1:
        return data.astype(np.int64)
    return (data.reshape(-1, width).astype(np.int64) << (8 * np.arange(width))).sum(axis=1)


class Shard:
    """A row of the index, its lists still packed."""

    def __init__(self, row: dict, corpus: Corpus):
        self.corpus = corpus
        names = zstandard.ZstdDecompressor().decompress(row["lexicon"]).split()
        self.terms = {x: k for k, x in enumerate(names) if x in corpus.weights}
        lengths, frequency = numbers(row["lengths"]).astype(np.int64), numbers(row["frequencies"]).astype(np.int64)
        self.ids = np.frombuffer(row["doc_ids"], np.int64)
        self.unknown = np.unpackbits(np.frombuffer(row["unknown"], np.uint8), count=len(self.ids)).astype(bool)
        self.damping = corpus.damping(lengths)
        self.postings = np.frombuffer(row["postings"], np.uint8)
        self.heads, data = [], row["heads"]
        while data:
            size = int.from_bytes(data[:8], "little")
            self.heads.append(numbers(data[8 : 8 + size]).astype(np.int64))
            data = data[8 + size :]
        blocks = -(-frequency // BLOCK)
        self.block_begins = np.concatenate([[0], np.cumsum(blocks)]).astype(np.int64)
        self.least_damping = corpus.damping(self.heads[2]) if len(self.heads) else np.zeros(0, np.int64)
        nth = np.arange(self.block_begins[-1]) - np.repeat(self.block_begins[:-1], blocks)
        self.sizes = np.minimum(BLOCK, np.repeat(frequency, blocks) - BLOCK * nth)
        used = self.sizes * (self.heads[3] + self.heads[4]) if len(self.heads) else self.sizes
        self.at = np.cumsum(used) - used


def _summed(docs: list[np.ndarray], scores: list[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct documents, rising, with their summed scores."""
    total, here = np.zeros(n, np.int64), np.zeros(n, dtype=bool)
    for doc, score in zip(docs, scores, strict=True):
        total[doc] += score
        here[doc] = True
    doc = np.flatnonzero(here)
    return doc, total[doc]


def search_shard(shard: Shard, query: list[bytes], k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of the shard (by number) that may be among the k best, with their scores; `least` is a score that k
    documents have reached already, or 0."""
    lists = sorted((Postings(shard, shard.terms[t], shard.corpus.weights[t]) for t in query if t in shard.terms), key=lambda p: p.bound)
    reach = np.cumsum([p.bound for p in lists])
    none = np.zeros(0, np.int64)

    def scored(essential: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores of documents in lists from `essential` on that can reach `least`."""
        parts = [p.all() for p in lists[essential:]]
        doc, score = _summed([d for d, _ in parts], [s for _, s in parts], len(shard.ids))
        for i in range(essential - 1, -1, -1):
            one, rest = lists[i], int(reach[i - 1]) if i else 0
            block = np.searchsorted(one.last, doc)
            inside = block < len(one.last)
            most = np.where(inside, one.bounds[np.minimum(block, len(one.last) - 1)], 0)
            stays = score + most + rest >= least
            doc, score, block, inside = doc[stays], score[stays], block[stays], inside[stays]
            needed = np.unique(block[inside])
            if not len(needed):
                continue
            held, gain = one.unpacked(needed)
            at = np.minimum(np.searchsorted(held, doc), len(held) - 1)
            score = score + np.where(held[at] == doc, gain[at], 0)
        stays = score >= max(least, 1)
        return doc[stays], score[stays]

    if not lists or reach[-1] < least:
        return none, none
    if not least:
        # a first k-th best score, from the documents of the most promising list
        _, score = scored(len(lists) - 1, 0)
        least = int(np.partition(score, -k)[-k]) if len(score) >= k else 0
    return scored(int(np.searchsorted(reach, least)), least)


def search(index: DataFrame, queries: DataFrame, k: int, key: str = "item_id") -> DataFrame:
    """key, rank (from 1), doc_id and score of the k best documents of each query (key, text)."""
    out, asked, held = None, {}, 0
    for row in queries.select(F.col(key).cast("long").alias("key"), F.col("text").cast("string").alias("text")).where("key is not null and text is not null").orderBy("key", "text").toLocalIterator():
        if held >= MOST_QUERY_BYTES and row["key"] not in asked:
            out, asked, held = _merged(out, _searched(index, asked, k)), {}, 0
        asked.setdefault(row["key"], set()).update(terms(row["text"].encode()))
        held += len(row["text"])
    out = _merged(out, _searched(index, asked, k))
    best = Window.partitionBy("key").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select(F.col("key").alias(key), "rank", "doc_id", "score")


def _merged(a: DataFrame | None, b: DataFrame) -> DataFrame:
    return b if a is None else a.unionByName(b)


def _searched(index: DataFrame, asked: dict[int, set[bytes]], k: int) -> DataFrame:
    corpus = corpus_of(index, set().union(*asked.values()))
    queries = {key: sorted(words & corpus.weights.keys()) for key, words in asked.items()}

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        best = {key: (none, none, none.astype(bool)) for key in queries}
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row, corpus)
                for key, words in queries.items():
                    score, ids, unknown = best[key]
                    least = int(score[-1]) if len(score) == k else 0
                    doc, gained = search_shard(shard, words, k, least)
                    if not len(doc):
                        continue
                    score, ids, unknown = np.append(score, gained), np.append(ids, shard.ids[doc]), np.append(unknown, shard.unknown[doc])
                    order = np.lexsort((ids, unknown, -score))[:k]
                    best[key] = score[order], ids[order], unknown[order]
        for key, (score, ids, unknown) in best.items():
            if len(score):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(score), key)), pa.array(ids, mask=unknown), pa.array(score)], names=["key", "doc_id", "score"])

    return index.select("doc_ids", "unknown", "lengths", "lexicon", "frequencies", "heads", "postings").mapInArrow(found, "key long, doc_id long, score long")
