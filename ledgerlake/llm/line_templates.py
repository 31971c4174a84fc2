"""Line dedup by a log-template tree: lines that follow one template in many documents are dropped.

Lines are cut at \\n into words; words with a digit are variable from the start. The tree has a fixed depth: first the
number of words, then the leading `LEAD` words. At a leaf, lines meet templates one by one: a line whose words agree with
a template's in `AGREE` of all places joins it, and places where they differ become variable too; else it starts one.

In Spark: a first pass counts, by leaf, the documents that have a line there, combined before the shuffle; only lines at
leaves that enough documents share can recur and go on. These are reduced to distinct lines with their counts. Leaves
are grown in two steps, so that a hot leaf is spread over tasks: one of more than `SHARD_LINES` lines is dealt by blocks of
words, of which all lines of a template share one that it fixes (`block_keys`), so they meet whatever the leaf's size; the
parts grow templates by themselves, then those of a leaf, which are few, are merged. Only a template of a large leaf that
varies in more than 1 - `AGREE` of its places, some with and some without a digit, can miss lines so. Every distinct line
is then matched to its leaf's templates, by the same keys, and documents are counted by template.

A line is dropped if `MIN_DOCS` documents or more follow its template, which must fix `LEAST_FIXED` words at least,
except in the document with the smallest id that follows it. A line without such a template, as those of fewer words, must
be in `EXACT_DOCS` documents word by word. Documents of which recurring lines are more than `MOST_TAKEN` of the words keep
them if they are near duplicates (`near_dup`) of another such document: they are left to document-level dedup.

Defined results: null and empty texts are kept as they are. Lines without letters are dropped only by a template, lines without words never. Rows that repeat
count as one document by their id. Further columns are kept.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import near_dup
from ledgerlake.llm.text import pieces, raw, runs

LEAD, AGREE, MIN_DOCS, LEAST_FIXED, MOST_TAKEN, SHARD_LINES = 3, 0.75, 5, 4, 0.5, 2_000
EXACT_DOCS = 20  # documents that must have a line without a template, word by word
MORE = 20  # a leaf of more than SHARD_LINES * MORE lines is dealt by pairs of blocks
VARIABLE = b"<*>"
_DIGITS = frozenset(b"0123456789")
_NO_LETTERS = bytes(c for c in range(128) if not chr(c).isalpha())


def masked(line: bytes) -> list[bytes]:
    """The line's words, those with a digit replaced by the sign for a variable."""
    if len(line.translate(None, b"0123456789")) == len(line):
        return line.split()
    return [VARIABLE if not _DIGITS.isdisjoint(w) else w for w in line.split()]


def counted(line: bytes) -> tuple[list[bytes], bool]:
    """The words a line counts by, and whether it can have a template: masked, or as they are where too few would be left
    for a template; none without a letter."""
    words = masked(line)
    if len(words) - words.count(VARIABLE) >= LEAST_FIXED:
        return words, True
    return line.split() if line.translate(None, _NO_LETTERS) else [], False


def leaf_of(words: list[bytes], lead: int = LEAD) -> int:
    """Hash of the tree path: the number of words and the leading ones."""
    return xxhash.xxh3_64_intdigest(b"%d " % len(words) + b" ".join(words[:lead])) - (1 << 63)


def block_keys(words: list[bytes], level: int, lead: int = LEAD, share: float = AGREE, fixed: bool = False) -> list[int]:
    """Keys of which lines of one length and beginning share at least one, however many there are, if they follow a template
    that varies in no more places than `share` allows: with d such places, the words after the leading ones are cut into
    d + level blocks, of which `level` at least have no variable. Each choice of `level` blocks is a key. Level 0, and
    lines too short for it, have the key 0. With `fixed`, only keys of blocks without a variable, or 0 if there is none."""
    free = len(words) - lead
    differ = int(len(words) * (1 - share) + 1e-9)
    level = min(level, free - differ)
    if level < 1:
        return [0]
    cuts = [lead + free * i // (differ + level) for i in range(differ + level + 1)]
    blocks = [(b"%d " % a + b" ".join(words[a:b]), VARIABLE in words[a:b]) for a, b in itertools.pairwise(cuts)]
    chosen = itertools.combinations([text for text, varies in blocks if not (fixed and varies)], level)
    return [xxhash.xxh3_64_intdigest(b"\n".join(c)) - (1 << 63) for c in chosen] or [0]


def grow(lines: list[tuple[list[bytes], int]], share: float = AGREE) -> list[tuple[list[bytes], int]]:
    """Templates of one leaf with how many they stand for, from lines (or templates) of equal length, in the given order.
    A line joins the template that fixes most of its words among those it agrees with; of equals, the earliest."""
    if not lines:
        return []
    numbers = {VARIABLE: 0}
    rows = np.array([[numbers.setdefault(w, len(numbers)) for w in words] for words, _ in lines])
    made, stands, n = np.zeros_like(rows), np.zeros(len(rows), np.int64), 0
    for row, (_, count) in zip(rows, lines, strict=True):
        same = (made[:n] == row) & (row != 0)
        fits = (same | (made[:n] == 0) | (row == 0)).sum(axis=1) >= share * len(row)
        k = n
        if fits.any():
            k = int(np.argmax(np.where(fits, same.sum(axis=1), -1)))
            made[k][~same[k]] = 0
        else:
            made[n] = row
            n += 1
        stands[k] += count
    names = list(numbers)
    return [([names[w] for w in t], int(c)) for t, c in zip(made[:n], stands[:n], strict=True)]


def _line_rows(docs: DataFrame) -> DataFrame:
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").where("doc_id is not null and text is not null")


def document_leaves(docs: DataFrame, lead: int = LEAD) -> DataFrame:
    """Distinct (leaf, doc_id) of lines that could become templates."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            leaves, ids = [], []
            for doc, text in zip(piece["doc_id"].to_pylist(), raw(piece), strict=True):
                mine = {leaf_of(w, lead) for w, _ in map(counted, text.split(b"\n")) if w}
                leaves += mine
                ids += [doc] * len(mine)
            yield pa.RecordBatch.from_arrays([pa.array(leaves, pa.int64()), pa.array(ids, pa.int64())], names=["leaf", "doc_id"])

    return _line_rows(docs).mapInArrow(found, "leaf long, doc_id long")


def recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, lead: int = LEAD, share: float = AGREE) -> DataFrame:
    """(doc_id, line, first_doc): each document's masked lines, as hashes, whose template recurs, and the smallest id that
    follows it."""
    busy = document_leaves(docs, lead).groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs).select("leaf")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            rows: dict[tuple, tuple] = {}
            for doc, text in zip(piece["doc_id"].to_pylist(), raw(piece), strict=True):
                for words, grown_by in map(counted, text.split(b"\n")):
                    if words:
                        line = b" ".join(words)
                        rows[doc, line] = (leaf_of(words, lead), doc, line, grown_by)
            leaf, ids, lines, grows = zip(*rows.values(), strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaf, pa.int64()), pa.array(ids, pa.int64()), pa.array(lines, pa.binary()), pa.array(grows, pa.bool_())], names=["leaf", "doc_id", "line", "grows"]
            )

    occurring = _line_rows(docs).mapInArrow(cut, "leaf long, doc_id long, line binary, grows boolean").join(busy, "leaf", "left_semi")
    # a row for each distinct line: how many have it; copies in thousands of documents become one row
    distinct = occurring.groupBy("leaf", F.xxhash64("line").alias("h"), "line", "grows").agg(F.countDistinct("doc_id").alias("docs")).checkpoint()
    lines = F.count(F.lit(1))
    size = distinct.where("grows").groupBy("leaf").agg(F.when(lines <= SHARD_LINES, 0).when(lines <= SHARD_LINES * MORE, 1).otherwise(2).alias("level"))
    levelled = distinct.where("grows").join(size, "leaf")

    def keyed(whole: bool):
        """Lines of large leaves with each of their keys; with `whole`, also with 0, by which all lines of a leaf meet."""

        def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at, keys = [], []
                for k, (line, level) in enumerate(zip(batch["line"].to_pylist(), batch["level"].to_pylist(), strict=True)):
                    mine = dict.fromkeys([*block_keys(line.split(), level, lead, share), *[0] * whole])
                    at += [k] * len(mine)
                    keys += mine
                out = batch.take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(keys, pa.int64())], names=[*out.schema.names, "key"])

        rows = levelled.select("leaf", "h", "line", "docs", "level")
        large = rows.where("level > 0").mapInArrow(over, "leaf long, h long, line binary, docs long, level int, key long")
        return rows.where("level = 0").withColumn("key", F.lit(0).cast("long")).unionByName(large)

    def grown(key: list[str]):
        def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table, _ in runs(batches, key, [*key, "line", "docs", "level"]):
                rows = sorted(zip(table["line"].to_pylist(), table["docs"].to_pylist(), strict=True), key=lambda r: (-r[1], r[0]))
                level = table["level"][0].as_py()
                # all lines of a template have met here: what too few documents have in a part of a large leaf is in no template by this key
                least = min_docs if level else 2
                kept = [(b" ".join(t), n) for t, n in grow([(line.split(), n) for line, n in rows], share) if n >= least]
                leaves = pa.array([table["leaf"][0].as_py()] * len(kept), pa.int64())
                levels = pa.array([level] * len(kept), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [leaves, pa.array([t for t, _ in kept], pa.binary()), pa.array([n for _, n in kept], pa.int64()), levels], names=["leaf", "line", "docs", "level"]
                )

        return over

    schema = "leaf long, line binary, docs long, level int"
    local = keyed(False).select("leaf", "key", "line", "docs", "level").repartition("leaf", "key").sortWithinPartitions("leaf", "key")
    # equal templates of several keys are one; what is left of a leaf has been generalised or repeats
    local = local.mapInArrow(grown(["leaf", "key"]), schema).groupBy("leaf", "line", "level").agg(F.max("docs").alias("docs"))
    merged = local.repartition("leaf").sortWithinPartitions("leaf").mapInArrow(grown(["leaf"]), schema)

    def by_fixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A key that every line has which follows the template: of blocks it fixes, or 0."""
        for batch in batches:
            keys = [block_keys(t.split(), n, lead, share, True)[0] for t, n in zip(batch["line"].to_pylist(), batch["level"].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch["leaf"], batch["line"], pa.array(keys, pa.int64())], names=["leaf", "template", "key"])

    merged = merged.mapInArrow(by_fixed, "leaf long, template binary, key long")

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a line with one of its leaf's templates that it follows; how many words the template fixes."""
        for batch in batches:
            keep, fixed = [], []
            for k, (line, template) in enumerate(zip(batch["line"].to_pylist(), batch["template"].to_pylist(), strict=True)):
                words, places = line.split(), template.split()
                if len(words) == len(places) and all(t in (VARIABLE, w) for t, w in zip(places, words, strict=True)):
                    keep.append(k)
                    fixed.append(sum(t != VARIABLE for t in places))
            out = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*(out[c] for c in ("leaf", "h", "template")), pa.array(fixed, pa.int64())], names=["leaf", "h", "template", "fixed"])

    pairs = keyed(True).select("leaf", "key", "h", "line").join(merged, ["leaf", "key"]).drop("key").mapInArrow(matched, "leaf long, h long, template binary, fixed long")
    # the most specific template that a line follows
    best = pairs.groupBy("leaf", "h").agg(F.max(F.struct("fixed", "template")).alias("b")).select("leaf", "h", F.col("b.fixed").alias("fixed"), F.xxhash64("b.template").alias("t"))
    # a line whose template fixes too little, or that has none, stands for itself
    fits = F.coalesce(F.col("fixed") >= LEAST_FIXED, F.lit(False))
    least = F.when(fits, min_docs).otherwise(max(min_docs, EXACT_DOCS))
    assigned = distinct.join(best, ["leaf", "h"], "left").select("leaf", "h", "docs", F.when(fits, F.col("t")).otherwise(F.col("h")).alias("t"), least.alias("least"))
    # no more documents follow a template than its lines have together; the rest is counted exactly
    enough = assigned.groupBy("leaf", "t", "least").agg(F.sum("docs").alias("n")).where("n >= least").drop("n")
    assigned = assigned.drop("docs").join(enough, ["leaf", "t", "least"]).select(F.col("h").alias("line"), F.struct("leaf", "t", "least").alias("template"))
    # a document with several lines of a template is one, counted from (template, doc_id)
    had = line_hashes(docs).join(assigned, "line").dropDuplicates(["doc_id", "line"]).checkpoint()
    counts = had.groupBy("template").agg(F.countDistinct("doc_id").alias("docs"), F.min("doc_id").alias("first_doc")).where("docs >= template.least")
    return had.join(counts.select("template", "first_doc"), "template").drop("template")


def line_hashes(docs: DataFrame) -> DataFrame:
    """(doc_id, line, words, total): hashes of the lines as they count, each once in a row of `docs`, how many of the row's
    words they make up, and how many it has."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            rows: list[tuple] = []
            for doc, text in zip(piece["doc_id"].to_pylist(), raw(piece), strict=True):
                lines: Counter[bytes] = Counter()
                for words, _ in map(counted, text.split(b"\n")):
                    lines[b" ".join(words)] += len(words)
                total = len(text.split())
                rows += [(doc, line, n, total) for line, n in lines.items() if line]
            columns = zip(*rows, strict=True) if rows else [()] * 4
            kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["doc_id", "line", "words", "total"])

    rows = _line_rows(docs).mapInArrow(hashed, "doc_id long, line binary, words int, total int")
    return rows.select("doc_id", F.xxhash64("line").alias("line"), "words", "total")


def copies(docs: DataFrame, recurring: DataFrame, most_taken: float = MOST_TAKEN) -> DataFrame:
    """doc_id of those made up of recurring lines by more than `most_taken` that are near duplicates of another."""
    shares = recurring.groupBy("doc_id").agg((F.sum("words") / F.max("total")).alias("share")).where(F.col("share") > most_taken / 2).checkpoint()
    # what a copy is linked with recurs nearly as much itself
    texts = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").join(shares, "doc_id", "left_semi").checkpoint()
    linked = near_dup.near_duplicates(texts).select("doc_id", "component_id").distinct()
    several = linked.groupBy("component_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("component_id")
    return linked.join(several, "component_id").join(shares.where(F.col("share") > most_taken), "doc_id", "left_semi").select("doc_id")


def drop_recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS, most_taken: float = MOST_TAKEN) -> DataFrame:
    """`docs` with recurring lines taken out of `text`; all rows and columns stay. See the module for which lines go."""
    recurring = recurring_lines(docs, min_docs).checkpoint()
    losing = recurring.where("doc_id <> first_doc").join(copies(docs, recurring, most_taken), "doc_id", "left_anti")
    # a document's lines to drop; bounded by the document
    gone = losing.groupBy("doc_id").agg(F.collect_set("line").alias("gone"))
    # the row travels as one column, so that no name of the input can meet one of ours
    row = docs.select(F.col("doc_id").cast("long").alias("id"), F.struct(*docs.columns).alias("row"))
    joined = row.join(gone.withColumnRenamed("doc_id", "id"), "id", "left").select(F.col("row")["text"].alias("words"), "gone", "row")
    columns = docs.columns
    at, kind = columns.index("text"), docs.schema["text"].dataType.simpleString()

    def rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "words"):
            texts: list[str | None] = piece["words"].to_pylist()
            for k, drop in enumerate(piece["gone"].to_pylist()):
                if not drop or not texts[k]:
                    continue
                unwanted = {x & 0xFFFFFFFFFFFFFFFF for x in drop}
                parts = texts[k].encode().split(b"\n")
                lines = [b" ".join(counted(p)[0]) for p in parts]
                stays = [not x or xxhash.xxh64_intdigest(x, seed=42) not in unwanted for x in lines]
                texts[k] = b"\n".join(p for p, s in zip(parts, stays, strict=True) if s).decode()
            arrays = piece["row"].flatten()
            arrays[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    if kind != "string":
        raise TypeError(f"text must be a string column, not {kind}")
    return joined.mapInArrow(rewritten, docs.schema)
