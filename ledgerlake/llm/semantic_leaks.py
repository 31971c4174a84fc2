"""Benchmark decontamination by latent semantic retrieval, with word-order and answer checks.

1. Passages are windows of `WIDTH` words that begin every `STRIDE` words of a text; benchmark items are cut the same way.
   Words, lowered and without signs at their ends, count into `2^TERM_BITS` hashed terms. A term counts once in a passage, by the
   square of its idf; document frequencies come from all documents.
2. The latent space is a randomised SVD of the passage-term matrix, made where the passages lie: with a fixed random
   matrix R, each task sums a'(aR) over its passages a, Spark adds up the tasks' sums by term, and the driver
   orthogonalises terms x `RANK` numbers, a size that doesn't grow with the data; this is repeated `POWER` times. Weights
   and space are learned from all passages of all documents, whose terms are written once, in 16 bits each.
3. Cosine search: every passage of every document is compared with every passage of the items, as one product of matrices
   for a piece of text. A document is a candidate for the items of which a passage reaches `NEAR`; nothing else is.
4. For a candidate, passages that are near and close to where rare words of the item, its answer, stand together are
   looked at: the longest common subsequence of the item's words and the text around is taken, by bit-parallel rows. The
   item leaks if it covers `COVER` of the item's words, and `LEAST_WORDS` if it has so many, and the answer is there as well.

Benchmark items are queries against all rows: they go to every task, which is checked to be within `MOST_ITEMS_BYTES`;
larger sets are searched in several passes of that size. Documents are never shuffled.

Defined results: null and empty texts have no passage and leak nothing; so has an item without words. Texts shorter
than a window make one passage. Rows that repeat are judged each, further columns are kept.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.blocks import scratch_folder
from ledgerlake.llm.text import PIECE_BYTES, pieces, raw
from ledgerlake.llm.word_hashes import HashedWords

WIDTH, STRIDE, TERM_BITS, RANK, POWER = 32, 8, 13, 64, 2
LEAST_WORDS = 8  # of an item are needed in order, or all of a shorter one
NEAR, COVER, ANSWER_WORDS, ANSWER_SHARE, MOST_ITEMS_BYTES = 0.45, 0.55, 6, 0.5, 8 << 20
ITEM_GROUP, CHUNK, STEPS = 512, 1024, 512  # items, and passages, compared at once; steps summed at once
_TERMS = 1 << TERM_BITS
_SIGNS = bytes(i for i in range(33, 127) if not chr(i).isalnum())


def _normal_words(texts: list[bytes]) -> HashedWords:
    """Words lowered and without signs at their ends."""
    return HashedWords(texts, _SIGNS)


def term_numbers(hashes: np.ndarray) -> np.ndarray:
    """The hashed term of each word."""
    return (hashes & np.uint64(_TERMS - 1)).astype(np.int64)


def passages(offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, first and past-the-last word (counted over all documents) of each window."""
    lengths = np.diff(offs)
    number = np.where(lengths > WIDTH, -(-(lengths - WIDTH) // STRIDE) + 1, (lengths > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(lengths)), number)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
    first = offs[:-1][doc] + nth * STRIDE
    return doc, first, np.minimum(first + WIDTH, offs[1:][doc])


def first_places(docs: np.ndarray, term: np.ndarray) -> np.ndarray:
    """Which places of a term count: those where the text has it not among the WIDTH words before."""
    place = np.arange(len(term))
    by_term = np.argsort(term.astype(np.uint16), kind="stable")  # of a term, places rise
    soon = (np.diff(term[by_term]) == 0) & (np.diff(place[by_term]) < WIDTH) & (np.diff(docs[by_term]) == 0)
    out = np.ones(len(term), dtype=bool)
    out[by_term[1:][soon]] = False
    return out


def _counted(words: HashedWords) -> np.ndarray:
    """The hashed term of each place that counts, `_TERMS` for the others."""
    term = term_numbers(words.hashes)
    return np.where(first_places(words.docs(), term), term, _TERMS).astype(np.uint16)


def _steps(counted: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps x STRIDE: counted terms, filled up with `_TERMS`, and the step with which each window of `passages` begins. Behind
    each text are empty steps, so that a window is always as many steps and never reaches the next text."""
    lengths = np.diff(offs)
    begins = np.concatenate([[0], np.cumsum(-(-lengths // STRIDE) + WIDTH // STRIDE - 1)])
    steps = np.full(begins[-1] * STRIDE, _TERMS, np.uint16)
    steps[np.arange(len(counted)) + np.repeat(begins[:-1] * STRIDE - offs[:-1], lengths)] = counted
    doc, first, _ = passages(offs)
    return steps.reshape(-1, STRIDE), begins[:-1][doc] + (first - offs[:-1][doc]) // STRIDE


def _row_sums(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of the rows of the table that each line of `rows` names, some lines at once that fit the processor's cache."""
    out = np.zeros((len(rows), table.shape[1]), table.dtype)
    held = np.empty((STEPS, table.shape[1]), table.dtype)
    for a in range(0, len(rows), STEPS):
        part = rows[a : a + STEPS]
        for k in range(part.shape[1]):
            out[a : a + STEPS] += np.take(table, part[:, k], axis=0, out=held[: len(part)], mode="clip")
    return out


def _with_none(table: np.ndarray) -> np.ndarray:
    """The table of terms with a row of zeros for places that don't count."""
    return np.concatenate([table, np.zeros((1, *table.shape[1:]), table.dtype)])


def _over_windows(sums: np.ndarray) -> np.ndarray:
    """Sums over the steps of a window from each step on."""
    out = sums.copy()
    for k in range(1, WIDTH // STRIDE):
        out[: len(out) - k] += sums[k:]
    return out


def _window_sums(table: np.ndarray, counted: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sums, over the windows of `passages`, of the rows of the table of the terms that count there, by way of the sums
    over STRIDE words."""
    steps, first = _steps(counted, offs)
    return _over_windows(_row_sums(_with_none(table), steps))[first]


def counted_terms(docs: DataFrame) -> DataFrame:
    """`terms`: of every text, the hashed terms that count, in 16 bits each. Written once, so that the weights and the
    space are learned from all texts without cutting them again."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            words = _normal_words(raw(piece))
            ends, terms = pa.py_buffer((2 * words.offs).astype(np.int32)), pa.py_buffer(_counted(words))
            yield pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), piece.num_rows, [None, ends, terms])], names=["terms"])

    place = f"{scratch_folder(docs.sparkSession)}/terms"
    docs.selectExpr("cast(text as string) text").mapInArrow(cut, "terms binary").write.parquet(place)
    return docs.sparkSession.read.parquet(place)


def _pieces_of_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Counted terms of some texts, and where each text begins."""
    for piece in pieces(batches, "terms", PIECE_BYTES // 4):
        held = raw(piece, "terms")
        yield np.frombuffer(b"".join(held), np.uint16), np.cumsum([0, *map(len, held)]) // 2


def term_weights(docs: DataFrame, terms: DataFrame | None = None) -> np.ndarray:
    """Weight of each hashed term, from its document frequency over all documents. Tasks send one count for each term.
    `terms` are the documents' `counted_terms`, where they are written already."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(_TERMS, np.int64), 0
        for term, offs in _pieces_of_terms(batches):
            rows = len(offs) - 1
            n += rows
            doc = np.repeat(np.arange(rows), np.diff(offs))
            for begin in range(0, rows, 256):  # a text counts once for a term
                a, b = offs[begin], offs[min(begin + 256, rows)]
                has = np.zeros((256, _TERMS + 1), dtype=bool)
                has[doc[a:b] - begin, term[a:b]] = True
                seen += has[:, :_TERMS].sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(_TERMS + 1)), pa.array(np.append(seen, n))], names=["term", "n"])

    terms = counted_terms(docs) if terms is None else terms
    rows = terms.mapInArrow(counted, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    count = np.zeros(_TERMS + 1)
    count[rows["term"].to_numpy()] = rows["n"].to_numpy()
    return (np.log(np.maximum(1, (count[-1] + 1) / (count[:-1] + 1))) + 0.1) ** 2


def _received(rows: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The terms of the steps, and for each the sum of the rows of the steps it stands in. `rows` end with one of zeros."""
    number = np.bincount(steps.reshape(-1), minlength=_TERMS + 1)[:_TERMS]
    has = np.flatnonzero(number)
    number = number[has]
    at = np.argsort(steps.reshape(-1), kind="stable")[: number.sum()] // STRIDE
    # a term's places in lines of STRIDE, the last of them filled up
    lines = -(-number // STRIDE)
    first = np.cumsum(lines) - lines
    dealt = np.full(lines.sum() * STRIDE, len(rows) - 1)
    dealt[np.repeat(first * STRIDE - (np.cumsum(number) - number), number) + np.arange(len(at))] = at
    sums = _row_sums(rows, dealt.reshape(-1, STRIDE))
    return has, np.add.reduceat(sums, first, axis=0, dtype=np.float64) if len(has) else sums


def latent_space(docs: DataFrame, weight: np.ndarray, rank: int = RANK, power: int = POWER, terms: DataFrame | None = None) -> np.ndarray:
    """Terms x rank: orthonormal directions of the greatest variance of the passages of all documents, by randomised
    subspace iteration. `terms` are the documents' `counted_terms`, where they are written already."""
    terms = counted_terms(docs) if terms is None else terms
    squares = _with_none(weight**2)
    basis = np.linalg.qr(np.random.default_rng(7).standard_normal((_TERMS, rank)))[0]
    for _ in range(power):
        near = _with_none((basis * weight[:, None]).astype(np.float32))

        def summed(batches: Iterator[pa.RecordBatch], near=near) -> Iterator[pa.RecordBatch]:
            total = np.zeros((_TERMS, rank))
            for term, offs in _pieces_of_terms(batches):
                steps, first = _steps(term, offs)
                # a window has a counted term once: its squared length is the sum of squared weights
                share = np.zeros((len(steps), 1), np.float32)
                share[first, 0] = 1 / np.maximum(_over_windows(squares[steps].sum(axis=1))[first], 1e-18)
                seen = _over_windows(_row_sums(near, steps)) * share
                # a'(aR): each step receives the rows of the windows that it lies in
                rows = np.concatenate([seen, np.zeros((1, rank), np.float32)])
                for k in range(1, WIDTH // STRIDE):
                    rows[k : len(seen)] += seen[: len(seen) - k]
                has, sums = _received(rows, steps)
                total[has] += sums
            has = np.flatnonzero(total.any(axis=1))
            lists = pa.ListArray.from_arrays(np.arange(len(has) + 1, dtype=np.int32) * rank, total[has].reshape(-1))
            yield pa.RecordBatch.from_arrays([pa.array(has), lists], names=["term", "row"])

        parts = terms.mapInArrow(summed, "term long, row array<double>")
        added = parts.groupBy("term").agg(*(F.sum(F.col("row")[k]).alias(f"r{k}") for k in range(rank))).toArrow()
        matrix = np.zeros((_TERMS, rank))
        if added.num_rows:
            matrix[added["term"].to_numpy()] = np.stack([added[f"r{k}"].to_numpy() for k in range(rank)], axis=1)
        basis = np.linalg.qr(matrix * weight[:, None] + 1e-12 * basis)[0]
    return basis


@dataclass
class Items:
    """Benchmark items as every task needs them: windows in the latent space, words, and answer words."""

    ids: list[int]
    words: list[list[int]]  # hashes
    answers: list[set[int]]
    owner: np.ndarray  # item of each window
    vectors: np.ndarray  # windows x rank, unit length


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _scaled(space: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return (space * weight[:, None]).astype(np.float32)


def _vectors(words: HashedWords, scaled: np.ndarray) -> np.ndarray:
    """Unit vectors of all passages of the texts, in the latent space."""
    return _unit(_window_sums(scaled, _counted(words), words.offs))


def prepare_items(ids: list[int], texts: list[bytes], space: np.ndarray, weight: np.ndarray) -> Items:
    held = _normal_words(texts)
    words = [held.hashes[a:b].tolist() for a, b in itertools.pairwise(held.offs.tolist())]
    rare = dict(zip(held.hashes.tolist(), weight[term_numbers(held.hashes)].tolist(), strict=True))
    answers = [set(sorted(set(w), key=lambda x: (rare[x], x), reverse=True)[:ANSWER_WORDS]) for w in words]
    owner, _, _ = passages(held.offs)
    return Items(ids, words, answers, owner, _vectors(held, _scaled(space, weight)))


def common_subsequence(a: list, b: list) -> int:
    """Length of the longest common subsequence, by bit-parallel rows over `a`."""
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full, row = (1 << len(a)) - 1, (1 << len(a)) - 1
    for x in b:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def answer_spots(words: HashedWords, items: Items) -> dict[tuple[int, int], list[int]]:
    """(text, item) -> places where enough of the item's answer words stand close together, as a leak has them."""
    asked = sorted((word, item) for item, answer in enumerate(items.answers) for word in answer)
    if not asked:
        return {}
    hashes, owners = np.array([w for w, _ in asked], np.uint64), np.array([i for _, i in asked])
    answer_term = np.zeros(_TERMS, dtype=bool)
    answer_term[term_numbers(hashes)] = True
    at = np.flatnonzero(answer_term[term_numbers(words.hashes)])
    low = np.searchsorted(hashes, words.hashes[at])
    times = np.searchsorted(hashes, words.hashes[at], side="right") - low
    item = owners[np.repeat(low - (np.cumsum(times) - times), times) + np.arange(times.sum())]
    place = np.repeat(at, times)
    doc = np.searchsorted(words.offs, place, side="right") - 1
    order = np.lexsort((place, item, doc))
    place, item, doc = place[order], item[order], doc[order]
    need = np.array([int(np.ceil(max(1.0, ANSWER_SHARE * len(a)))) for a in items.answers])[item]
    width = np.array([WIDTH + 2 * len(w) for w in items.words])[item]
    last = np.arange(len(place)) + need - 1
    fits = last < len(place)
    last = np.minimum(last, len(place) - 1)
    fits &= (doc[last] == doc) & (item[last] == item) & (place[last] - place < width)
    spots: dict[tuple[int, int], list[int]] = {}
    for k in np.flatnonzero(fits).tolist():
        spots.setdefault((int(doc[k]), int(item[k])), []).append(int(place[k]))
    return spots


def near_passages(vectors: np.ndarray, items: Items, group: slice) -> np.ndarray:
    """Passages x items of the group: whether the passage reaches NEAR with one of the item's."""
    low, high = np.searchsorted(items.owner, [group.start, group.stop])
    owner, queries = items.owner[low:high] - group.start, np.ascontiguousarray(items.vectors[low:high].T)
    out = np.zeros((len(vectors), group.stop - group.start), dtype=bool)
    for a in range(0, len(vectors) if len(owner) else 0, CHUNK):
        hit = np.flatnonzero(vectors[a : a + CHUNK] @ queries >= NEAR)
        out[a + hit // len(owner), owner[hit % len(owner)]] = True
    return out


def find_leaks(texts: list[bytes], items: Items, scaled: np.ndarray) -> list[list[tuple[int, float]]]:
    """For each text the (item id, share of the item's words in common order) of items that leak. `scaled` is the
    latent space by weight."""
    found: list[list[tuple[int, float]]] = [[] for _ in texts]
    held = _normal_words(texts)
    if not len(held.hashes) or not len(items.owner):
        return found
    doc, first, _ = passages(held.offs)
    has = np.flatnonzero(np.diff(held.offs))  # texts with passages
    begins = np.searchsorted(doc, has)
    vectors = _vectors(held, scaled)
    spots = None
    for at in range(0, len(items.ids), ITEM_GROUP):
        group = slice(at, min(at + ITEM_GROUP, len(items.ids)))
        if not ((items.owner >= group.start) & (items.owner < group.stop)).any():
            continue
        near = near_passages(vectors, items, group)
        candidates = np.argwhere(np.logical_or.reduceat(near, begins, axis=0))
        if not len(candidates):
            continue
        spots = answer_spots(held, items) if spots is None else spots
        for k, i in candidates.tolist():
            d, item = int(has[k]), at + i
            places = spots.get((d, item))
            if places is None:
                continue
            a, b = begins[k], begins[k + 1] if k + 1 < len(begins) else len(first)
            share = _common_share(held, items, d, item, first[a:b][near[a:b, i]], np.array(places))
            words = items.words[item]
            if share * len(words) >= max(COVER * len(words), min(len(words), LEAST_WORDS)):
                found[d].append((items.ids[item], share))
    return found


def _common_share(held: HashedWords, items: Items, d: int, item: int, near: np.ndarray, places: np.ndarray) -> float:
    """The greatest share of the item's words, in order, around near passages within reach of its answer's places."""
    words, answer = items.words[item], items.answers[item]
    low, high, reach = int(held.offs[d]), int(held.offs[d + 1]), WIDTH + 2 * len(words)
    close = np.searchsorted(places, near - reach) < np.searchsorted(places, near + reach, side="right")
    done, share = -1, 0.0
    for at in near[close].tolist():
        if at + WIDTH <= done:
            continue
        begin, end = max(low, at - len(words)), min(high, at + WIDTH + len(words))
        done = end
        around = held.hashes[begin:end].tolist()
        if len(answer.intersection(around)) >= ANSWER_SHARE * len(answer):
            share = max(share, common_subsequence(words, around) / len(words))
    return share


def _searchers(docs: DataFrame, benchmark: DataFrame) -> list:
    """Functions from texts to leaks, each for benchmark items of bounded size."""
    rows = benchmark.selectExpr("cast(item_id as long) item_id", "cast(text as string) text").where("item_id is not null and text is not null")
    terms = counted_terms(docs)
    weight = term_weights(docs, terms)
    space = latent_space(docs, weight, terms=terms)
    out, ids, texts, held = [], [], [], 0

    def searcher(ids: list[int], texts: list[bytes]):
        items, scaled = prepare_items(ids, texts, space, weight), _scaled(space, weight)
        return lambda found: find_leaks(found, items, scaled)

    for row in rows.orderBy("item_id", "text").toLocalIterator():
        ids.append(row["item_id"])
        texts.append(row["text"].encode())
        held += len(texts[-1])
        if held >= MOST_ITEMS_BYTES:
            out.append(searcher(ids, texts))
            ids, texts, held = [], [], 0
    return [*out, searcher(ids, texts)] if ids or not out else out


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id and share of every leak."""
    out = None
    for search in _searchers(docs, benchmark):

        def searched(batches: Iterator[pa.RecordBatch], search=search) -> Iterator[pa.RecordBatch]:
            for piece in pieces(batches, "text"):
                rows = [(d, i, s) for d, hits in zip(piece["doc_id"].to_pylist(), search(raw(piece)), strict=True) for i, s in hits]
                columns = list(zip(*rows, strict=True)) or [(), (), ()]
                kinds = [pa.int64(), pa.int64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "item_id", "share"])

        part = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(searched, "doc_id long, item_id long, share double")
        out = part if out is None else out.unionByName(part)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` in which no item leaks, with all their columns."""
    for search in _searchers(docs, benchmark):

        def clean(batches: Iterator[pa.RecordBatch], search=search) -> Iterator[pa.RecordBatch]:
            for piece in pieces(batches, "text"):
                yield piece.filter(pa.array([not hits for hits in search(raw(piece))], pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
