"""Quality classifier as a generalised additive model with pairwise interactions.

Boosting goes round the features in turn: each gets a small step tree on what the others leave unexplained, added to
that feature's lookup table. Afterwards the pairs of features that explain most of the rest get two-dimensional tables,
boosted in turn by trees of one cut on either axis. A score is then a sum of table entries: bin each feature, look up, add.

The tables are fitted on the driver from a bounded sample of labelled rows (`MAX_LABELLED`); documents are scored where
they lie, without a shuffle. Defined results: a null or empty text has the features of an empty document and is scored
like any other; without usable labels every score is the mean label, or 1. Rows that repeat are scored each; further
columns are left out of the scoring and, in `keep_good`, kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerlake.llm.boosted_rules import MAX_LABELLED, labelled_features, quantile_cuts
from ledgerlake.llm.stats import document_stats
from ledgerlake.llm.text import pieces, raw

N_BINS, PAIR_BINS, ROUNDS, PAIR_ROUNDS, N_PAIRS, RATE, L2, LEAST_WEIGHT = 32, 8, 60, 40, 6, 0.15, 1.0, 1.0


@dataclass
class AdditiveModel:
    base: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for f, (cuts, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            total += table[np.searchsorted(cuts, x[:, f], side="left")]
        coarse = {f: np.searchsorted(self.pair_cuts[f], x[:, f], side="left") for f in {f for p in self.pairs for f in p}}
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[coarse[a], coarse[b]]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _gain(g, h):
    return g * g / (h + L2)


def step_tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Values by bin of a tree with up to 2^depth steps over ordered bins, from gradient and weight sums by bin."""
    out = np.full(len(g), -g.sum() / (h.sum() + L2))
    if depth == 0 or len(g) < 2:
        return out
    lg, lh = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = np.where((lh >= LEAST_WEIGHT) & (h.sum() - lh >= LEAST_WEIGHT), _gain(lg, lh) + _gain(g.sum() - lg, h.sum() - lh), -np.inf)
    k = int(np.argmax(gain)) + 1
    if not np.isfinite(gain[k - 1]):
        return out
    return np.concatenate([step_tree(g[:k], h[:k], depth - 1), step_tree(g[k:], h[k:], depth - 1)])


def cross_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best tree with one cut on each axis, from sums by cell."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    best, values = 0.0, np.zeros_like(g)
    for i in range(g.shape[0] - 1):
        for j in range(g.shape[1] - 1):
            def quarter(c, i=i, j=j):
                return np.array([c[i, j], c[i, -1] - c[i, j], c[-1, j] - c[i, j], c[-1, -1] - c[i, -1] - c[-1, j] + c[i, j]])

            qg, qh = quarter(cg), quarter(ch)
            gain = float(_gain(qg, qh).sum())
            if gain > best:
                best, v = gain, -qg / (qh + L2)
                values = np.empty_like(g)
                values[: i + 1, : j + 1], values[: i + 1, j + 1 :], values[i + 1 :, : j + 1], values[i + 1 :, j + 1 :] = v
    return best, values


def fit_additive(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Cyclic boosting for the logistic loss, main effects first, then the chosen pairs."""
    mean = float(y.mean()) if len(y) else 1.0
    model = AdditiveModel(float(np.log((mean + 1e-4) / (1 - mean + 1e-4))))
    if not len(y) or y.min() == y.max():
        return model
    n_features, margin = x.shape[1], np.full(len(y), model.base)
    model.cuts = [quantile_cuts(x[:, f], N_BINS) for f in range(n_features)]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    binned = [np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(model.cuts)]

    def slopes():
        p = 1 / (1 + np.exp(-margin))
        return p - y, np.maximum(p * (1 - p), 1e-6)

    for _ in range(ROUNDS):
        for f in range(n_features):
            grad, hess = slopes()
            size = len(model.tables[f])
            step = RATE * step_tree(np.bincount(binned[f], grad, size), np.bincount(binned[f], hess, size))
            model.tables[f] += step
            margin += step[binned[f]]

    model.pair_cuts = [quantile_cuts(x[:, f], PAIR_BINS) for f in range(n_features)]
    coarse = [np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(model.pair_cuts)]

    def cells(a, b, weights):
        shape = len(model.pair_cuts[a]) + 1, len(model.pair_cuts[b]) + 1
        return np.bincount(coarse[a] * shape[1] + coarse[b], weights, shape[0] * shape[1]).reshape(shape)

    grad, hess = slopes()
    ranked = sorted(combinations(range(n_features), 2), key=lambda p: (-cross_tree(cells(*p, grad), cells(*p, hess))[0], p))
    model.pairs = ranked[:N_PAIRS]
    model.pair_tables = [np.zeros((len(model.pair_cuts[a]) + 1, len(model.pair_cuts[b]) + 1)) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (a, b) in enumerate(model.pairs):
            grad, hess = slopes()
            step = RATE * cross_tree(cells(a, b, grad), cells(a, b, hess))[1]
            model.pair_tables[k] += step
            margin += step[coarse[a], coarse[b]]
    return model


def fit_quality_model(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_LABELLED) -> AdditiveModel:
    return fit_additive(*labelled_features(docs, labels, label, max_rows))


def score_quality(docs: DataFrame, model: AdditiveModel) -> DataFrame:
    """doc_id and score, the probability of good quality, of every row."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            score = model.probability(document_stats(raw(piece))[1])
            yield pa.RecordBatch.from_arrays([piece["doc_id"], pa.array(score)], names=["doc_id", "score"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(scored, "doc_id long, score double")


def keep_good(docs: DataFrame, model: AdditiveModel, least: float = 0.3) -> DataFrame:
    """The rows that score `least` or more, with all their columns."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            score = model.probability(document_stats(raw(piece))[1])
            yield piece.filter(pa.array(score >= least))

    return docs.mapInArrow(kept, docs.schema)
