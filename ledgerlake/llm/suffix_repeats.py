"""Substring dedup by suffix arrays: every byte that lies in a string of `LENGTH` bytes which also starts in a document
with a smaller doc_id.

1. Texts lie in blocks (`blocks`). Every window of `LENGTH` bytes has an anchor: of the `GRAM`-byte strings in it the one
   with the least hash, the leftmost of equal ones. It depends on the window's bytes only, so equal windows have equal
   anchors. Neighbouring windows with one anchor make a segment, some 70 bytes. Each block sends its distinct anchors,
   cut to as many bits as tell them apart, to their range of hashes; the range answers which occur in two documents.
2. Segments with such an anchor go, once for each block and text and with their smallest doc_id, to their anchor's shard.
   A shard's distinct segments become one string, whose suffix array is made by induced sorting and whose common prefixes
   are computed in the order of the text (`suffix_arrays`). Suffixes in a row that share `LENGTH` bytes are one string;
   the smallest doc_id that has it goes back to the blocks.
3. The block removes what windows with a smaller doc_id cover, and returns spans and the bytes left.

The first step only leaves out windows that occur in one document; hashes that collide cost work, not correctness. The
number of ranges follows that of the blocks, and a shard's string is cut at about `SHARD_BYTES` between anchors. What a block
and a range send each other is a row, so blocks hold several megabytes: rows grow with the square of their number. An anchor
with more than `TEXTS_PER_BLOCK` times `HOT_BLOCKS` texts, counted in each block, is dealt by the hash of each whole window, so
that frequent phrases in many contexts spread. Being in many blocks is not enough: a line that every block has in a few contexts
is a few entries of each, and fifteen times as many window by window.

Defined results: null and empty texts have no bytes and no spans. A row with a null doc_id keeps all its bytes, and
nothing is removed elsewhere for it. Rows with one doc_id don't count as smaller than each other. Texts shorter than
`LENGTH` keep everything. Further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.blocks import numbers, planes, scratch_folder, unpack_block, write_blocks
from ledgerlake.llm.shared_keys import Layout, distinct_keys, read_flags, rising, shared_keys
from ledgerlake.llm.suffix_arrays import permuted_prefixes, suffix_array
from ledgerlake.llm.text import mix, runs

LENGTH, GRAM = 50, 24
BLOCK_BYTES, SHARD_BYTES, HOT_BLOCKS, TEXTS_PER_BLOCK = 1 << 23, 1 << 19, 1000, 32
BLOCKS_PER_RANGE, HASHED_BYTES = 2, 1 << 20
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_HIGH = np.uint64(0xFFFFFFFF00000000)
_CHUNK = 1 << 15
#: Stands for an unknown id: none is greater.
_NO_ID = np.iinfo(np.int64).max


def gram_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each place on, zeros behind the end."""
    n = len(data)
    padded = np.zeros(n + 40, np.uint8)
    padded[:n] = np.frombuffer(data, np.uint8)
    out = np.empty(n, np.uint64)
    for begin in range(0, n, _CHUNK):  # small enough for the processor's cache
        m = min(_CHUNK, n - begin)
        words = np.empty(m + 16, np.uint64)
        for r in range(8):
            words[r::8] = padded[begin + r : begin + r + 8 * len(words[r::8])].view("<u8")
        words ^= words >> np.uint64(32)
        out[begin : begin + m] = mix(words[:m] * _A + words[8 : m + 8] * _B + words[16 : m + 16] * _C)
    return out


@dataclass
class Segments:
    """Runs of windows with one anchor: they start at places first to past - 1 of the block."""

    first: np.ndarray
    past: np.ndarray
    key: np.ndarray  # hash of the anchor
    doc: np.ndarray  # row in the block
    text: np.ndarray  # hash of three strings of GRAM bytes of the windows


def segments(hashes: np.ndarray, offs: np.ndarray, length: int = LENGTH) -> Segments:
    n, width = len(hashes) - length + 1, length - GRAM + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return Segments(none, none, np.zeros(0, np.uint64), none, np.zeros(0, np.uint64))
    anchor = np.empty(n, np.uint32)
    for begin in range(0, n, _CHUNK):
        m = min(_CHUNK, n - begin)
        # least hash of each window; the place in the low half makes it the leftmost of equal ones
        least = (hashes[begin : begin + m + width - 1] & _HIGH) | np.arange(begin, begin + m + width - 1, dtype=np.uint64)
        step = 1
        while 2 * step <= width:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        if step < width:
            least = np.minimum(least[: -(width - step)], least[width - step :])
        anchor[begin : begin + m] = least.astype(np.uint32)
    new = np.empty(n + 1, dtype=bool)
    new[0], new[1:-1], new[-1] = True, anchor[1:] != anchor[:-1], True
    # windows begin in a text, and the last ones of a text are those that still end in it
    new[np.minimum(offs, n)] = True
    new[np.clip(offs[1:] - length + 1, 0, n)] = True
    cuts = np.flatnonzero(new)
    first, past = cuts[:-1], cuts[1:]
    doc = np.searchsorted(offs, first, side="right") - 1
    inside = first + length <= offs[doc + 1]
    first, past, doc = first[inside], past[inside], doc[inside]
    last = past - 1 + length - GRAM
    text = mix(hashes[first] * _A + hashes[np.minimum(first + GRAM, last)] * _B + hashes[last] * _C + (last - first).astype(np.uint64))
    # least hashes are small ones: mixed anew, they spread over all ranges
    return Segments(first, past, mix(hashes[anchor[first]] ^ _A), doc, text)


def block_segments(data: bytes, offs: np.ndarray, length: int) -> Segments:
    """Those of a block, some documents at a time."""
    out, row = [segments(np.zeros(0, np.uint64), offs[:1], length)], 0
    while row < len(offs) - 1:
        stop = max(row + 1, int(np.searchsorted(offs, offs[row] + HASHED_BYTES, side="right")) - 1)
        begin, past = int(offs[row]), int(offs[stop])
        some = segments(gram_hashes(data[begin:past]), offs[row : stop + 1] - begin, length)
        out.append(Segments(some.first + begin, some.past + begin, some.key, some.doc + row, some.text))
        row = stop
    return Segments(*(np.concatenate([getattr(x, c) for x in out]) for c in ("first", "past", "key", "doc", "text")))


def anchors(found: Segments, layout: Layout) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct cut anchors of a block, which of them several rows have, and the anchor's index of each segment."""
    return distinct_keys(layout.cut(found.key), found.doc)


def n_texts(found: Segments, index: np.ndarray) -> np.ndarray:
    """How many different texts the segments of each anchor have."""
    out = np.bincount(index)
    at = np.flatnonzero(out[index] > 1)
    order = np.lexsort((found.text[at], index[at]))
    anchor, text = index[at][order], found.text[at][order]
    new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])])[: len(at)]
    out[out > 1] = 0
    return out + np.bincount(anchor[new], minlength=len(out))


@dataclass
class Entries:
    """Distinct segment texts of a block in the order of their keys; `entry` names that of each occurrence."""

    key: np.ndarray
    texts: list[bytes]
    entry: np.ndarray
    first: np.ndarray
    doc: np.ndarray


def entries(data: bytes, found: Segments, index: np.ndarray, shared: np.ndarray, hot: np.ndarray, layout: Layout, length: int) -> Entries:
    """The segments whose anchor is shared; those whose anchor is hot window by window."""
    plain = np.flatnonzero((shared & ~hot)[index])
    split = np.flatnonzero((shared & hot)[index])
    sizes = found.past[split] - found.first[split]
    window = np.repeat(found.first[split] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    parts = [data[a:b] for a, b in zip(found.first[split].tolist(), (found.past[split] - 1 + length).tolist(), strict=True)]
    hashes, n = gram_hashes(b"".join(parts)), sizes + length - 1  # of these segments, one after the other
    local = window - np.repeat(found.first[split] - (np.cumsum(n) - n), sizes)
    whole = mix(hashes[local] * _A + hashes[local + min(GRAM, length - GRAM)] * _B + hashes[local + length - GRAM])
    key = layout.cut(np.concatenate([found.key[plain], whole]))
    first = np.concatenate([found.first[plain], window])
    past = np.concatenate([found.past[plain] - 1 + length, window + length])
    doc = np.concatenate([found.doc[plain], np.repeat(found.doc[split], sizes)])
    order = np.argsort(key, kind="stable")
    first, past, doc = first[order], past[order], doc[order]
    seen: dict[bytes, int] = {}
    entry = np.fromiter((seen.setdefault(data[a:b], len(seen)) for a, b in zip(first.tolist(), past.tolist(), strict=True)), np.int64, len(first))
    # keys in the order of first appearance rise, too, as equal texts have equal keys
    at = np.flatnonzero(np.concatenate([[True], np.maximum.accumulate(entry)[1:] != np.maximum.accumulate(entry)[:-1]])[: len(entry)])
    return Entries(key[order][at], list(seen), entry, first, doc)


def _least(values: np.ndarray, group: np.ndarray, n: int) -> np.ndarray:
    out = np.full(n, _NO_ID, np.int64)
    np.minimum.at(out, group, values)
    return out


def _ids(values: np.ndarray) -> bytes:
    """Ids as differences from the smallest, which stands in front."""
    base = int(values.min(initial=_NO_ID))
    return base.to_bytes(8, "little", signed=True) + planes((values.view(np.uint64) - np.int64(base).view(np.uint64)))


def _from_ids(data: bytes) -> np.ndarray:
    base = np.frombuffer(data[:8], "<i8").view(np.uint64)
    return (numbers(data[8:]) + base).view(np.int64)


def least_ids(texts: list[bytes], ids: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """For all windows of the distinct texts, one text after the other, the smallest id among equal windows; and where
    each text's windows begin."""
    sizes = np.array([len(t) for t in texts], np.int64)
    string = np.frombuffer(b"".join(texts), np.uint8).astype(np.int16) + 1
    begins = np.cumsum(sizes + 1) - (sizes + 1)
    symbols = np.zeros(int((sizes + 1).sum()), np.int16)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes + 1)
    inside = np.ones(len(symbols), dtype=bool)
    inside[begins + sizes] = False
    symbols[inside] = string
    order = suffix_array(symbols)
    common = permuted_prefixes(symbols, order)
    group_begins = np.flatnonzero(np.concatenate([[True], common[order[1:]] < length]))
    least = np.minimum.reduceat(ids[owner[order]], group_begins)
    result = np.empty(len(symbols), np.int64)
    result[order] = np.repeat(least, np.diff(np.append(group_begins, len(order))))
    place = np.arange(len(symbols)) - begins[owner]
    window = place + length <= sizes[owner]
    return result[window], np.concatenate([[0], np.cumsum(np.maximum(sizes - length + 1, 0))])


def _shard(rows: pa.Table, length: int) -> Iterator[tuple[int, bytes]]:
    """For each block of a range the smallest ids of its entries' windows, as runs."""
    blocks = rows["block"].to_pylist()
    keys = [np.cumsum(numbers(x), dtype=np.uint64) for x in rows["keys"].to_pylist()]
    ids = np.concatenate([_from_ids(x) for x in rows["ids"].to_pylist()])
    sizes = np.concatenate([numbers(x) for x in rows["sizes"].to_pylist()]).astype(np.int64)
    unpacker = zstandard.ZstdDecompressor()
    data = b"".join(unpacker.decompress(x) for x in rows["texts"].to_pylist())
    ends = np.cumsum(sizes)
    all_keys = np.concatenate(keys)
    order = np.argsort(all_keys, kind="stable")
    in_order, starts = all_keys[order], ends - sizes
    number = np.empty(len(order), np.int64)  # distinct text of each entry
    n_runs, run_sizes, run_ids, total = [], [], [], 0
    at = 0
    filled = np.cumsum(sizes[order])
    while at < len(order):
        stop = int(np.searchsorted(filled, (filled[at - 1] if at else 0) + SHARD_BYTES)) + 1
        if stop < len(order):  # all of a key go together
            stop = int(np.searchsorted(in_order, in_order[stop - 1], side="right"))
        part = order[at : min(stop, len(order))]
        seen: dict[bytes, int] = {}
        which = np.fromiter((seen.setdefault(data[a:b], len(seen)) for a, b in zip(starts[part].tolist(), ends[part].tolist(), strict=True)), np.int64, len(part))
        number[part] = total + which
        least, begins = least_ids(list(seen), _least(ids[part], which, len(seen)), length)
        new = np.concatenate([[True], least[1:] != least[:-1]])[: len(least)]
        new[begins[:-1]] = True
        cuts = np.flatnonzero(new)
        n_runs.append(np.diff(np.searchsorted(cuts, begins)))
        run_sizes.append(np.diff(np.append(cuts, len(least))))
        run_ids.append(least[cuts])
        total += len(seen)
        at += len(part)
    n_runs, run_sizes, run_ids = np.concatenate(n_runs), np.concatenate(run_sizes), np.concatenate(run_ids)
    run_begins = np.cumsum(n_runs) - n_runs
    entry_ends = np.cumsum([len(k) for k in keys])
    for block, end, own in zip(blocks, entry_ends, keys, strict=True):
        mine = number[end - len(own) : end]
        many = n_runs[mine]
        run = np.repeat(run_begins[mine] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        parts = [planes(many), planes(run_sizes[run]), _ids(run_ids[run])]
        yield block, b"".join(len(p).to_bytes(8, "little") + p for p in parts)


def _unjoined(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        size = int.from_bytes(data[at : at + 8], "little")
        out.append(data[at + 8 : at + 8 + size])
        at += 8 + size
    return out


def repeated_strings(docs: DataFrame, length: int = LENGTH, block_bytes: int = BLOCK_BYTES, hot_blocks: int = HOT_BLOCKS) -> DataFrame:
    """doc_id, n_bytes, spans (begin and past, in bytes of the text) and kept (the other bytes) of every row of `docs`
    (doc_id, text). `length` is at least 25."""
    if length <= GRAM:
        raise ValueError(f"length must be over {GRAM}")
    spark = docs.sparkSession
    folder = scratch_folder(spark)
    blocks = write_blocks(docs, f"{folder}/blocks", block_bytes)
    layout = Layout.of(blocks.count(), block_bytes, BLOCKS_PER_RANGE)

    def own(text: bytes, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = block_segments(text, offs, length)
        key, several, index = anchors(found, layout)
        return key, several, n_texts(found, index)

    flags = shared_keys(blocks, own, layout, folder, TEXTS_PER_BLOCK * hot_blocks)

    def flagged(data: bytes, flags: list[bytes]) -> tuple[list, bytes, np.ndarray, Entries]:
        ids, text, offs = unpack_block(data)
        found = block_segments(text, offs, length)
        key, _, index = anchors(found, layout)
        shared, hot = read_flags(flags, layout.borders(key))
        return ids, text, offs, entries(text, found, index, shared, hot, layout, length)

    def known(ids: list) -> np.ndarray:
        return np.array([_NO_ID if i is None else i for i in ids], np.int64)

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, _ in runs(batches, ["block"], ["block", "part", "data"]):
            data = table["data"].to_pylist()  # the texts, then the flags by range
            ids, _, _, found = flagged(data[0], data[1:])
            least = _least(known(ids)[found.doc], found.entry, len(found.texts))
            cuts = layout.borders(found.key)
            sizes, packer = np.array([len(t) for t in found.texts], np.int64), zstandard.ZstdCompressor(level=1)
            filled = np.flatnonzero(np.diff(cuts)).tolist()
            parts = [(int(cuts[r]), int(cuts[r + 1])) for r in filled]
            columns = [
                filled, [table["block"][0].as_py()] * len(parts), [rising(found.key[a:b]) for a, b in parts], [_ids(least[a:b]) for a, b in parts],
                [planes(sizes[a:b]) for a, b in parts], [packer.compress(b"".join(found.texts[a:b])) for a, b in parts],
            ]
            kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=["range", "block", "keys", "ids", "sizes", "texts"])

    def sorted_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, _ in runs(batches, ["range"], ["range", "block", "keys", "ids", "sizes", "texts"]):
            part = (1 << layout.range_bits) + table["range"][0].as_py()
            answers = list(_shard(table, length))
            columns = [pa.array([b for b, _ in answers], pa.int64()), pa.array([part] * len(answers), pa.int32()), pa.array([x for _, x in answers], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "part", "data"])

    parts = blocks.select("block", F.lit(-1).alias("part"), "data").unionByName(flags)
    candidates = parts.repartition("block").sortWithinPartitions("block", "part").mapInArrow(sent, "range int, block long, keys binary, ids binary, sizes binary, texts binary")
    found = candidates.repartition("range").sortWithinPartitions("range", "block").mapInArrow(sorted_out, "block long, part int, data binary")
    found.write.parquet(f"{folder}/found")
    found = spark.read.parquet(f"{folder}/found")

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, _ in runs(batches, ["block"], ["block", "part", "data"]):
            data, part = table["data"].to_pylist(), table["part"].to_numpy()
            n_flags = int((part[1:] < 1 << layout.range_bits).sum())
            ids, text, offs, own = flagged(data[0], data[1 : 1 + n_flags])
            answers = [_unjoined(x) for x in data[1 + n_flags :]]
            n_runs = np.concatenate([numbers(x[0]) for x in answers] or [np.zeros(0, np.uint64)]).astype(np.int64)
            sizes = np.concatenate([numbers(x[1]) for x in answers] or [np.zeros(0, np.uint64)]).astype(np.int64)
            least = np.concatenate([_from_ids(x[2]) for x in answers] or [np.zeros(0, np.int64)])
            # each occurrence has its entry's runs
            begins, many = np.cumsum(n_runs) - n_runs, n_runs[own.entry]
            run = np.repeat(begins[own.entry] - (np.cumsum(many) - many), many) + np.arange(many.sum())
            before = np.cumsum(sizes) - sizes  # windows before a run
            occurrence = np.repeat(np.arange(len(own.entry)), many)
            start = own.first[occurrence] + before[run] - before[begins[own.entry]][occurrence]
            mine = known(ids)[own.doc][occurrence]
            goes = (least[run] < mine) & (mine != _NO_ID)
            change = np.zeros(len(text) + 1, np.int32)
            np.add.at(change, start[goes], 1)
            np.add.at(change, start[goes] + sizes[run][goes] + length - 1, -1)
            gone = np.cumsum(change[:-1], dtype=np.int32) > 0
            edge = np.zeros(len(text) + 1, dtype=bool)
            edge[offs] = True  # spans of neighbouring documents are two
            opens = np.flatnonzero(gone & (np.concatenate([[True], ~gone[:-1]])[: len(gone)] | edge[:-1]))
            closes = np.flatnonzero(gone & (np.concatenate([~gone[1:], [True]])[: len(gone)] | edge[1:])) + 1
            owner = np.searchsorted(offs, opens, side="right") - 1
            spans = pa.StructArray.from_arrays([pa.array(opens - offs[owner]), pa.array(closes - offs[owner])], names=["begin", "past"])
            span_offs = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(ids)))]).astype(np.int32)
            left = np.frombuffer(text, np.uint8)[~gone].tobytes()
            kept = np.where(offs > 0, np.cumsum(np.append(~gone, False), dtype=np.int32)[offs - 1], 0).tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(np.diff(offs)), pa.ListArray.from_arrays(pa.array(span_offs), spans), pa.array([left[a:b] for a, b in zip(kept[:-1], kept[1:], strict=True)], pa.binary())],
                names=["doc_id", "n_bytes", "spans", "kept"],
            )

    parts = parts.unionByName(found)
    schema = "doc_id long, n_bytes long, spans array<struct<begin: long, past: long>>, kept binary"
    return parts.repartition("block").sortWithinPartitions("block", "part").mapInArrow(removed, schema)
