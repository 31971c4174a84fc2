"""Toxicity as a linear-chain conditional random field over words, with states clean and toxic.

Labels are given for documents, so the tokens to learn from are derived: words, or beginnings of words, that are found
in documents labelled toxic and hardly ever in others are cues, and a word of a toxic document that shows a cue is
labelled toxic. The field is trained on windows of such words by full gradient steps on its log-likelihood. Scoring
runs forward and backward over every word of a text; the marginals give the offending words and, by a logistic
calibration of the largest and of what all say together, the document's score.

Forward and backward passes over a slice are one chain of 2x2 matrices (the first word of a document resets it), cut
into equal rows that are walked together, so their cost doesn't depend on single long texts.

Learning uses a bounded sample of labelled rows (`MAX_LABELLED`, `MAX_WINDOWS`); every document is scored, without a
shuffle. Defined results: a null or empty text has no spans and the score of marginals 0; without labels of both
classes every score is 0. Rows that repeat are scored each; further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.blocks import scratch_folder
from ledgerlake.llm.text import PIECE_BYTES, Tokens, labelled_sample, pieces, raw

MAX_LABELLED = 8_000  # labelled documents, at most
SAMPLE_TASKS = 24  # files of the sample
MAX_WINDOWS = 6_000  # windows of WINDOW words the field is trained on, at most
WINDOW, STEPS, L2, LEAST_WEIGHT = 32, 40, 1e-6, 0.02
CUE_DOCS, CUE_SHARE, CUE_LIFT, PREFIXES = 4, 0.02, 25.0, (4, 5, 6, 7)
_SIGNS = bytes(i for i in range(33, 127) if not chr(i).isalnum())


def word_core(word: bytes) -> bytes:
    """The word without signs at its ends, A-Z lowered."""
    return word.strip(_SIGNS).lower()


def core_keys(core: bytes) -> list[bytes]:
    """The word itself and its longer beginnings, by bytes: what a cue may be."""
    return [b"=" + core, *(core[:n] + b"^" for n in PREFIXES if len(core) > n)] if core else []


def word_features(core: bytes) -> tuple[list[bytes], bytes, bytes]:
    """Features of a word by itself, of the word that follows it, and of the word before it."""
    return [*core_keys(core), b"bias"], b"<" + core, b">" + core


@dataclass
class SpanField:
    """`weights`: how far each feature speaks for toxic; `moves`: log-weights of state changes; logistic calibration."""

    weights: dict[bytes, float]
    moves: np.ndarray  # 2 x 2
    calibration: np.ndarray  # weights of `calibration_inputs`

    def emissions(self, tokens: Tokens) -> np.ndarray:
        get = self.weights.get
        bias, stems = get(b"bias", 0.0), {k[: PREFIXES[0]] for k in self.weights if k[-1:] == b"^"}
        scores = []
        for word in tokens.vocab:
            core = word_core(word)
            own = bias + get(b"=" + core, 0.0)
            if core[: PREFIXES[0]] in stems:
                own += sum(get(x, 0.0) for x in core_keys(core)[1:])
            scores.append((own, get(b"<" + core, 0.0), get(b">" + core, 0.0)))
        own, lead, follow = np.array(scores, dtype=float).reshape(-1, 3).T
        score = own[tokens.ids]
        if len(score) > 1:
            inner = np.ones(len(score) + 1, dtype=bool)
            inner[tokens.offs] = False  # no neighbour across documents
            link = inner[1:-1]
            score[1:] += lead[tokens.ids[:-1]] * link
            score[:-1] += follow[tokens.ids[1:]] * link
        return score

    def marginals(self, tokens: Tokens) -> np.ndarray:
        return chain_marginals(self.emissions(tokens), tokens.offs, self.moves)

    def score(self, largest: np.ndarray, total: np.ndarray) -> np.ndarray:
        z = calibration_inputs(largest, total) @ self.calibration
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def calibration_inputs(largest: np.ndarray, total: np.ndarray) -> np.ndarray:
    """A constant, how sure the surest word is, and the evidence of all words."""
    return np.stack([np.ones(len(largest)), -np.log1p(-np.minimum(largest, 1 - 1e-6)), np.log1p(total)], axis=1)


def _scan(matrices: np.ndarray) -> np.ndarray:
    """Running products M1, M1 M2, ... of 2x2 matrices, each scaled to sum to one."""
    n = len(matrices)
    if n <= 64:
        out = matrices.copy()
        for i in range(1, n):
            out[i] = out[i - 1] @ out[i]
            out[i] /= out[i].sum()
        return out
    width = int(np.ceil(np.sqrt(n)))
    height = -(-n // width)
    grid = np.broadcast_to(np.eye(2), (height * width, 2, 2)).copy()
    grid[:n] = matrices
    grid = np.ascontiguousarray(grid.reshape(height, width, 2, 2).transpose(2, 3, 1, 0))  # 2 x 2 x width x height
    for i in range(1, width):
        (a, b), (c, d) = grid[:, :, i - 1]
        (e, f), (g, h) = grid[:, :, i]
        p, q, r, s = a * e + b * g, a * f + b * h, c * e + d * g, c * f + d * h
        total = p + q + r + s
        grid[0, 0, i], grid[0, 1, i], grid[1, 0, i], grid[1, 1, i] = p / total, q / total, r / total, s / total
    carry = _scan(np.ascontiguousarray(grid[:, :, -1].transpose(2, 0, 1)))
    lead = np.concatenate([np.eye(2)[None], carry[:-1]]).transpose(1, 2, 0)  # 2 x 2 x height
    out = np.einsum("ijh,jkwh->hwik", lead, grid).reshape(-1, 2, 2)[:n]
    return out / out.sum(axis=(1, 2), keepdims=True)


def chain_marginals(score: np.ndarray, offs: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Probability of the second state at each place of independent chains; `score` is its log-weight there."""
    n = len(score)
    if not n:
        return np.zeros(0)
    score, move = np.clip(score, -30, 30), np.exp(moves)
    emit = np.stack([np.ones(n), np.exp(score)], axis=1)
    emit /= emit.sum(axis=1, keepdims=True)
    starts = offs[:-1][np.diff(offs) > 0]
    ends = offs[1:][np.diff(offs) > 0] - 1
    step = move[None] * emit[:, None, :]
    step[starts] = np.repeat(emit[starts][:, None, :], 2, axis=1)  # whatever came before
    forward = _scan(step)[:, 0, :]
    back = np.empty_like(step)  # from the right: row vector beta_t = beta_{t+1} (E M)^T
    back[:-1] = (move[None] * emit[1:, None, :]).transpose(0, 2, 1)
    back[ends] = 0.5
    backward = _scan(back[::-1])[::-1][:, 0, :]
    both = forward * backward
    return both[:, 1] / both.sum(axis=1)


def fit_field(words: np.ndarray, vocab: list[bytes], marked: np.ndarray) -> SpanField:
    """`words`: windows x WINDOW places of words in `vocab`, -1 past the end; `marked`: those labelled toxic."""
    names: dict[bytes, int] = {b"": 0}  # the padding
    own, lead, follow = np.zeros((len(vocab) + 1, 2 + len(PREFIXES)), np.int64), np.zeros(len(vocab) + 1, np.int64), np.zeros(len(vocab) + 1, np.int64)
    for k, word in enumerate(vocab):
        keys, before, after = word_features(word_core(word))
        own[k, : len(keys)] = [names.setdefault(x, len(names)) for x in keys]
        lead[k], follow[k] = names.setdefault(before, len(names)), names.setdefault(after, len(names))
    none = np.zeros((len(words), 1), np.int64)
    before = np.concatenate([none, lead[words][:, :-1]], axis=1)
    after = np.concatenate([follow[words][:, 1:], none], axis=1)
    features = np.concatenate([own[words], before[..., None], after[..., None]], axis=2)
    real = words >= 0
    features[~real] = 0
    flat, width = features.reshape(-1), features.shape[2]
    weights, moves = np.zeros(len(names)), np.zeros((2, 2))
    speed, move_speed = np.full(len(names), 1e-8), np.full((2, 2), 1e-8)
    target = marked.astype(float)
    pairs = (real[:, :-1] & real[:, 1:]).astype(float)
    seen = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            seen[a, b] = (pairs * (target[:, :-1] == a) * (target[:, 1:] == b)).sum()
    lengths = real.sum(axis=1)
    offs = np.concatenate([[0], np.cumsum(lengths)])
    for _ in range(STEPS):
        score = np.clip(weights[features].sum(axis=2), -30, 30)
        p = np.zeros(words.shape)
        p[real] = chain_marginals(score[real], offs, moves)
        push = (target - p) * real
        grad = np.bincount(flat, np.repeat(push.reshape(-1), width), len(names)) / len(words) - L2 * weights
        grad[0] = 0
        speed += grad**2
        weights += 0.5 * grad / np.sqrt(speed)
        expected = _pair_counts(score, p, moves, pairs)
        move_grad = (seen - expected) / max(1.0, pairs.sum())
        move_speed += move_grad**2
        moves += 0.1 * move_grad / np.sqrt(move_speed)
    kept = {name: float(weights[k]) for name, k in names.items() if k and abs(weights[k]) >= LEAST_WEIGHT}
    return SpanField(kept, moves, np.zeros(3))


def _pair_counts(score: np.ndarray, p: np.ndarray, moves: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Expected numbers of state changes. With both ends' marginals p and q fixed, the odds ratio of the four
    combinations is that of `moves`, which leaves one quadratic equation for the joint probability."""
    ratio = np.exp(moves[0, 0] + moves[1, 1] - moves[0, 1] - moves[1, 0])
    a, b = p[:, :-1], p[:, 1:]
    if abs(ratio - 1) < 1e-9:
        both = a * b
    else:
        s = 1 + (a + b) * (ratio - 1)
        both = (s - np.sqrt(np.maximum(s * s - 4 * ratio * (ratio - 1) * a * b, 0))) / (2 * (ratio - 1))
    both = np.clip(both, 0, np.minimum(a, b))
    return np.array([[(pairs * (1 - a - b + both)).sum(), (pairs * (b - both)).sum()], [(pairs * (a - both)).sum(), (pairs * both).sum()]])


def cue_words(sample: DataFrame) -> set[bytes]:
    """Words and beginnings that mark toxic documents of the labelled sample, by documents that have them."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            counts: dict[bytes, list[int]] = {}
            for text, y in zip(raw(piece), piece["y"].to_pylist(), strict=True):
                for key in {k for w in set(map(word_core, text.split())) for k in core_keys(w)}:
                    counts.setdefault(key, [0, 0])[y] += 1
            rows = list(counts.values())
            names = ["key", "clean", "toxic"]
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), *(pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1))], names=names)

    totals = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean, toxic = totals.get(0, 0), totals.get(1, 0)
    if not clean or not toxic:
        return set()
    lift = ((F.col("toxic") + 0.0) / toxic) / ((F.col("clean") + 0.1) / clean)
    rows = (
        sample.mapInArrow(keyed, "key binary, clean long, toxic long")
        .groupBy("key")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where((F.col("toxic") >= max(CUE_DOCS, CUE_SHARE * toxic)) & (lift >= CUE_LIFT))
    )
    return {bytes(r["key"]) for r in rows.select("key").collect()}  # bounded: from MAX_LABELLED documents only


def fit_toxic_spans(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_LABELLED) -> SpanField:
    # copies of a text would turn its chance words into cues; the bounded sample is written once and read from there on
    place = f"{scratch_folder(docs.sparkSession)}/sample"
    sample = labelled_sample(docs, labels, label, max_rows)
    sample = sample.groupBy(F.xxhash64("text").alias("h")).agg(F.min_by(F.struct(*sample.columns), "doc_id").alias("first")).select("first.*")
    sample.repartition(SAMPLE_TASKS).write.parquet(place)
    sample = docs.sparkSession.read.schema(sample.schema).parquet(place)
    cues = cue_words(sample)
    if not cues:
        return SpanField({}, np.zeros((2, 2)), np.array([-30.0, 0.0, 0.0]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Windows of words with their marks, and a rank by which the bounded number is chosen."""
        for piece in pieces(batches, "text"):
            out: list[tuple] = []
            for doc, text, y in zip(piece["doc_id"].to_pylist(), raw(piece), piece["y"].to_pylist(), strict=True):
                words = text.split()
                for at in range(0, len(words), WINDOW):
                    part = words[at : at + WINDOW]
                    shown = [int(not cues.isdisjoint(core_keys(word_core(w)))) for w in part]
                    marks = shown if y else [0] * len(part)
                    # windows with a cue, from documents of either label, make one half; others the other
                    out.append((0 if any(shown) else 1, xxhash.xxh3_64_intdigest(b"%d %d" % (doc, at)) >> 1, part, marks))
            kinds = [pa.int32(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int32())]
            columns = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["grade", "rank", "words", "marks"])

    cutting = sample.mapInArrow(cut, "grade int, rank long, words array<binary>, marks array<int>")
    halves = [cutting.where(F.col("grade") == g).orderBy("rank").limit(MAX_WINDOWS // 2).toArrow() for g in (0, 1)]
    texts = [w for h in halves for w in h["words"].to_pylist()]
    marks = [m for h in halves for m in h["marks"].to_pylist()]
    vocab = {w: i for i, w in enumerate(dict.fromkeys(w for t in texts for w in t))}
    words, marked = np.full((len(texts), WINDOW), -1), np.zeros((len(texts), WINDOW), dtype=bool)
    for k, (t, m) in enumerate(zip(texts, marks, strict=True)):
        words[k, : len(t)], marked[k, : len(m)] = [vocab[w] for w in t], np.array(m, dtype=bool)
    field = fit_field(words, list(vocab), marked)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            largest, total, _, _ = _aggregate(field, raw(piece))
            yield pa.RecordBatch.from_arrays([piece["doc_id"], piece["y"], pa.array(largest), pa.array(total)], names=["doc_id", "y", "largest", "total"])

    known = sample.mapInArrow(summed, "doc_id long, y int, largest double, total double").toArrow()
    x = calibration_inputs(known["largest"].to_numpy(), known["total"].to_numpy())
    y, beta = known["y"].to_numpy().astype(float), np.zeros(3)
    ridge = np.diag([1e-3, 0.1, 0.1])
    for _ in range(25):  # Newton's method with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        beta += np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ beta)
    field.calibration = beta
    return field


def _aggregate(field: SpanField, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Largest marginal and evidence, minus the log of the product of 1 - p, of each text; the marginals of all words, and
    the word with which each text begins."""
    tokens = Tokens(texts)
    p = field.marginals(tokens)
    full = np.diff(tokens.offs) > 0
    largest, total = np.zeros(len(texts)), np.zeros(len(texts))
    if len(p):
        largest[full] = np.maximum.reduceat(p, tokens.offs[:-1][full])
        total[full] = np.add.reduceat(-np.log1p(-np.minimum(p, 1 - 1e-6)), tokens.offs[:-1][full])
    return largest, total, p, tokens.offs


def tag_toxic(docs: DataFrame, field: SpanField, least: float = 0.5) -> DataFrame:
    """doc_id, score, and spans: (first word, word past the last, largest marginal) of each run of toxic words."""

    def tagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text", 3 * PIECE_BYTES):  # large ones have fewer distinct words in all
            texts = raw(piece)
            largest, total, p, offs = _aggregate(field, texts)
            spans: list[list[dict]] = [[] for _ in texts]
            hot = np.flatnonzero(p >= least)
            doc = np.searchsorted(offs, hot, side="right") - 1
            breaks = np.flatnonzero((np.diff(hot) > 1) | (np.diff(doc) > 0)) + 1 if len(hot) else []
            for run in np.split(hot, breaks) if len(hot) else []:
                d = int(np.searchsorted(offs, run[0], side="right") - 1)
                spans[d].append({"first": int(run[0] - offs[d]), "past": int(run[-1] - offs[d] + 1), "marginal": float(p[run].max())})
            kind = pa.list_(pa.struct([("first", pa.int64()), ("past", pa.int64()), ("marginal", pa.float64())]))
            yield pa.RecordBatch.from_arrays([piece["doc_id"], pa.array(field.score(largest, total)), pa.array(spans, kind)], names=["doc_id", "score", "spans"])

    schema = "doc_id long, score double, spans array<struct<first: long, past: long, marginal: double>>"
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(tagged, schema)
