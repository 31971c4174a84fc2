"""Quality rules, additive model and toxicity against plain versions, on odd rows, and on held-out rows."""

import itertools
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm import additive_model, boosted_rules, queries, stats, toxic_spans
from ledgerlake.llm.text import labelled_sample
from ledgerlake.llm.text import Tokens, crc_fold, held_out

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "a b c a b c a b c"), (6, "x\nx\n\nx y\n y"), (7, "#*$%&|<> é ü"),
    (8, "word " * 30_000), (9, "same text twice"), (9, "same text twice"), (10, "same text twice"), (None, "no id"), (11, "\x1c\x85  a\x00b"),
]


@pytest.fixture(scope="module")
def odd(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
    return spark.createDataFrame(ODD, schema).withColumn("score", F.lit("clash")).withColumn("y", F.lit(None).cast("int"))


def plain_counts(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return [len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside)]


def test_counts_of_odd_texts(spark, odd):
    forest = boosted_rules.fit_forest(np.zeros((0, 14)), np.zeros(0), list(stats.FEATURES.values()))
    rows = boosted_rules.apply_quality_rules(odd, forest).collect()
    assert len(rows) == len(ODD)
    got = sorted((str(r.doc_id), [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words], r.base_failed, r.kept) for r in rows)
    want = []
    for doc, text in ODD:
        c = plain_counts(text)
        failed = c[0] < 50 or 100 * c[4] > 50 * c[0]
        want.append((str(doc), c, failed, not failed))
    assert got == sorted(want)


def test_counts_of_given_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] for r in queries.quality_rules(spark, SF).collect()}
    assert got == {k: plain_counts(v) for k, v in texts.items()}


def test_repeats_with_a_large_vocabulary():
    ids = np.array([0, 1, 2, 5, 0, 1, 2, 7])
    assert stats.repeated_words(ids, 10) == stats.repeated_words(ids, 1 << 22) == 6


def test_monotonic_and_flat_forest():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 3))
    y = (x[:, 0] + np.sin(3 * x[:, 1]) + rng.normal(scale=0.5, size=3000) > 0).astype(float)
    forest = boosted_rules.fit_forest(x[:2000], y[:2000], [1, 0, -1])
    assert ((forest.probability(x[2000:]) > 0.5) == y[2000:]).mean() > 0.8
    line = np.linspace(-3, 3, 200)
    for rest in rng.normal(size=(20, 3)):
        for f, sign in ((0, 1), (2, -1)):
            grid = np.tile(rest, (200, 1))
            grid[:, f] = line
            assert (np.diff(forest.margin(grid)) * sign >= -1e-9).all()
    # the flat walk agrees with one node after another
    row, total = x[2500], forest.base
    for t in range(len(forest.feature)):
        k = 0
        while k < forest.feature.shape[1]:
            k = 2 * k + 1 + (row[forest.feature[t, k]] > forest.threshold[t, k])
        total += forest.leaf[t, k - forest.feature.shape[1]]
    assert np.isclose(total, forest.margin(row[None])[0])


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, size=(4000, 4))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    model = additive_model.fit_additive(x[:3000], y[:3000])
    assert (0, 1) in model.pairs
    assert ((model.probability(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9


def test_model_without_labels(spark, odd):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = additive_model.fit_quality_model(odd, labels)
    assert {round(r.score, 3) for r in additive_model.score_quality(odd, model).collect()} == {1.0}
    assert additive_model.keep_good(odd, model).columns == odd.columns
    assert additive_model.keep_good(odd, model).count() == len(ODD)
    field = toxic_spans.fit_toxic_spans(odd, labels)
    assert max(r.score for r in toxic_spans.tag_toxic(odd, field).collect()) < 1e-6
    none = odd.limit(0)
    assert toxic_spans.tag_toxic(none, field).count() == additive_model.score_quality(none, model).count() == 0


@pytest.mark.parametrize(("query", "label", "least"), [("op10_quality_classifier", "quality", 0.95), ("op9_toxicity", "toxic", 0.9)])
def test_held_out_rows(spark, query, label, least):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", label)
    got = queries.QUERIES[query](spark, sf).join(labels, "doc_id").where("held_out")
    rows = got.collect()
    assert sum(r.predicted == r[label] for r in rows) / len(rows) >= least
    assert all(0 <= r.score <= 1 for r in rows)


def test_toxic_documents_are_found(spark):
    """Not only mostly right, which a model that never says toxic would be, too."""
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = queries.QUERIES["op9_toxicity"](spark, sf).join(labels, "doc_id").collect()
    hits = sum(r.predicted and r.toxic for r in rows)
    assert hits >= 0.6 * sum(r.toxic for r in rows) and hits >= 0.7 * sum(r.predicted for r in rows)


def test_sample_has_one_row_for_an_id(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, None), (3, "c"), (None, "d")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, None), (None, 1), (9, 1)], "doc_id long, quality int")
    got = labelled_sample(docs, labels, "quality", 10, remainder=-1)
    assert sorted(map(tuple, got.collect())) == [(1, "b", 1), (2, None, 0)]


def test_marginals_against_all_paths():
    rng = np.random.default_rng(2)
    offs = np.array([0, 1, 1, 6, 9])
    score, moves = rng.normal(size=9) * 2, rng.normal(size=(2, 2))
    want = []
    for a, b in itertools.pairwise(offs):
        weight = np.zeros((b - a, 2))
        for path in itertools.product((0, 1), repeat=b - a):
            w = np.exp(sum(score[a + i] * s for i, s in enumerate(path)) + sum(moves[s, t] for s, t in itertools.pairwise(path)))
            for i, s in enumerate(path):
                weight[i, s] += w
        want += [w[1] / w.sum() for w in weight if b > a]
    assert np.allclose(toxic_spans.chain_marginals(score, offs, moves), want)


def test_long_chain_equals_plain_recursion():
    rng = np.random.default_rng(3)
    n, moves = 5000, np.array([[0.3, -0.2], [-0.4, 0.5]])
    score = rng.normal(size=n)
    alpha, beta = np.ones((n, 2)), np.ones((n, 2))
    emit = np.stack([np.ones(n), np.exp(score)], 1)
    alpha[0] = emit[0] / emit[0].sum()
    for i in range(1, n):
        alpha[i] = (alpha[i - 1] @ np.exp(moves)) * emit[i]
        alpha[i] /= alpha[i].sum()
    for i in range(n - 2, -1, -1):
        beta[i] = np.exp(moves) @ (emit[i + 1] * beta[i + 1])
        beta[i] /= beta[i].sum()
    both = alpha * beta
    assert np.allclose(toxic_spans.chain_marginals(score, np.array([0, n]), moves), both[:, 1] / both.sum(1))


def test_spans_name_the_words(spark):
    field = toxic_spans.SpanField({b"=idiot": 9.0, b"bias": -4.0}, np.zeros((2, 2)), np.array([-3.0, 2.0, 0.0]))
    docs = spark.createDataFrame([(1, "you Idiot! IDIOT, yes idiot"), (2, "fine words")], "doc_id long, text string")
    got = {r.doc_id: ([(s.first, s.past) for s in r.spans], r.score > 0.5) for r in toxic_spans.tag_toxic(docs, field).collect()}
    assert got == {1: ([(1, 3), (4, 5)], True), 2: ([], False)}


def test_fold_is_the_same_in_both_places(spark):
    ids = [0, 1, 17, 123456789, -5]
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", held_out(F.col("doc_id"), 1).alias("h")).collect()
    assert [r.h for r in rows] == [bool(x) for x in crc_fold(ids) == 1]
    assert Tokens([b"a b", b"", b"b"]).offs.tolist() == [0, 2, 2, 3]
