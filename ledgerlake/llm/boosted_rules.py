"""Quality rules as gradient-boosted trees over document statistics, some of them monotonic, scored from node arrays.

Every document gets the same statistics (`stats.py`), computed where it lies: no shuffle. The trees are fitted on the
driver from a bounded sample of labelled rows (`MAX_LABELLED`), then flattened into complete binary trees: one array of
split features, one of thresholds and one of leaf values. Scoring walks all trees of a slice at once, a level at a time.

Defined results: a null or empty text has zero counts and fails the base rule; without usable labels (none, or of one
class) every document that passes the base rule gets the mean label, or 1. Rows that repeat are scored each. Columns
that the input carries besides doc_id and text are left out, so none can clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlake.llm.stats import COUNTS, FEATURES, document_stats
from ledgerlake.llm.text import labelled_sample, pieces, raw

MAX_LABELLED = 20_000  # labelled rows that the model is fitted on, at most
N_BINS, N_TREES, DEPTH, RATE, LEAST_WEIGHT, L2 = 32, 60, 3, 0.2, 2.0, 1.0


@dataclass
class Forest:
    """Complete binary trees: node k of a level-ordered tree has the children 2k+1 and 2k+2."""

    base: float
    feature: np.ndarray  # trees x (2^depth - 1)
    threshold: np.ndarray
    leaf: np.ndarray  # trees x 2^depth

    def margin(self, x: np.ndarray) -> np.ndarray:
        trees, inner = self.feature.shape
        if not trees:
            return np.full(len(x), self.base)
        tree, row = np.arange(trees)[None, :], np.arange(len(x))[:, None]
        at = np.zeros((len(x), trees), dtype=np.int64)
        for _ in range((inner + 1).bit_length() - 1):
            at = 2 * at + 1 + (x[row, self.feature[tree, at]] > self.threshold[tree, at])
        return self.base + self.leaf[tree, at - inner].sum(axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def quantile_cuts(values: np.ndarray, n_bins: int = N_BINS) -> np.ndarray:
    """Inner bin borders: values up to a border lie below it."""
    return np.unique(np.quantile(values, np.linspace(0, 1, n_bins + 1)[1:-1]))


def _leaf(g: float, h: float, low: float, high: float) -> float:
    return float(np.clip(-g / (h + L2), low, high))


def _best_split(binned, rows, grad, hess, sizes, signs, low, high):
    """(gain, feature, bin, left value, right value) of the best permitted split, or None."""
    best, whole = None, (grad[rows].sum(), hess[rows].sum())
    for f, size in enumerate(sizes):
        if size < 2:
            continue
        at = binned[rows, f]
        g, h = (np.cumsum(np.bincount(at, weights=w[rows], minlength=size))[:-1] for w in (grad, hess))
        rg, rh = whole[0] - g, whole[1] - h
        left, right = np.clip(-g / (h + L2), low, high), np.clip(-rg / (rh + L2), low, high)
        # loss removed by giving each side its own clipped value
        gain = -(g * left + 0.5 * (h + L2) * left**2) - (rg * right + 0.5 * (rh + L2) * right**2)
        fits = (h >= LEAST_WEIGHT) & (rh >= LEAST_WEIGHT) & ((right - left) * signs[f] >= 0)
        if fits.any():
            k = int(np.argmax(np.where(fits, gain, -np.inf)))
            if best is None or gain[k] > best[0]:
                best = (float(gain[k]), f, k, float(left[k]), float(right[k]))
    return best


def fit_forest(x: np.ndarray, y: np.ndarray, signs: list[int]) -> Forest:
    """Boosted trees for the logistic loss. `signs`: -1 or 1 where the score may only fall or rise with a feature."""
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    mean = float(y.mean()) if len(y) else 1.0
    base = float(np.log((mean + 1e-4) / (1 - mean + 1e-4)))
    if not len(y) or y.min() == y.max():
        return Forest(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    cuts = [quantile_cuts(x[:, f]) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    sizes, margin = [len(c) + 1 for c in cuts], np.full(len(y), base)
    feature, threshold, leaf = np.zeros((N_TREES, inner), np.int64), np.full((N_TREES, inner), np.inf), np.zeros((N_TREES, leaves))
    for t in range(N_TREES):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-6)
        # node: rows, bounds that keep a monotonic feature's sides apart further down, own value
        level = {0: (np.arange(len(y)), -np.inf, np.inf, _leaf(grad.sum(), hess.sum(), -np.inf, np.inf))}
        for depth in range(DEPTH):
            below = {}
            for node, (rows, low, high, value) in level.items():
                split = _best_split(binned, rows, grad, hess, sizes, signs, low, high) if len(rows) else None
                if split is None:  # all go left, which keeps the node's value
                    below[2 * node + 1] = (rows, low, high, value)
                    below[2 * node + 2] = (rows[:0], low, high, value)
                    continue
                _, f, k, left, right = split
                feature[t, node], threshold[t, node] = f, cuts[f][k]
                middle, goes_left = (left + right) / 2, binned[rows, f] <= k
                bounds = {-1: ((middle, high), (low, middle)), 0: ((low, high), (low, high)), 1: ((low, middle), (middle, high))}[signs[f]]
                below[2 * node + 1] = (rows[goes_left], *bounds[0], left)
                below[2 * node + 2] = (rows[~goes_left], *bounds[1], right)
            level = below
        for node, (rows, _, _, value) in level.items():
            leaf[t, node - inner] = RATE * value
            margin[rows] += RATE * value
    return Forest(base, feature, threshold, leaf)


def labelled_features(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the bounded sample, ordered by id so that a fit doesn't depend on the partitions."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            _, feats = document_stats(raw(piece))
            yield pa.RecordBatch.from_arrays([piece["doc_id"], piece["y"], pa.array(list(feats))], names=["doc_id", "y", "x"])

    found = labelled_sample(docs, labels, label, max_rows)
    rows = found.mapInArrow(measured, "doc_id long, y int, x array<double>").toArrow()
    x = np.array(rows["x"].to_pylist(), dtype=float).reshape(len(rows), len(FEATURES))
    y = rows["y"].to_numpy().astype(float)
    order = np.lexsort((*x.T, y, rows["doc_id"].to_numpy()))
    return x[order], y[order]


def fit_quality_rules(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_LABELLED) -> Forest:
    x, y = labelled_features(docs, labels, label, max_rows)
    return fit_forest(x, y, list(FEATURES.values()))


def apply_quality_rules(docs: DataFrame, forest: Forest, least: float = 0.3) -> DataFrame:
    """doc_id, the counts, the features, base_failed, score (probability of good quality) and kept (score >= least)."""

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            counts, feats = document_stats(raw(piece))
            failed = (counts[:, 0] < 50) | (100 * counts[:, 4] > 50 * counts[:, 0])
            score = forest.probability(feats)
            arrays = [piece["doc_id"], *(pa.array(c) for c in counts.T), *(pa.array(f) for f in feats.T)]
            arrays += [pa.array(failed), pa.array(score), pa.array(~failed & (score >= least))]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    names = ["doc_id", *COUNTS, *FEATURES, "base_failed", "score", "kept"]
    kinds = ["long"] * (1 + len(COUNTS)) + ["double"] * len(FEATURES) + ["boolean", "double", "boolean"]
    schema = ", ".join(f"{n} {k}" for n, k in zip(names, kinds, strict=True))
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(judged, schema)
