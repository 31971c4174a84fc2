"""Decontamination, language model, URL filter and the pipeline against plain versions, and on odd rows."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from ledgerlake.llm import backoff_lm, host_trust, queries, semantic_leaks
from ledgerlake.llm.word_hashes import HashedWords

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def folder(spark):
    queries.shared_folder(spark)


# ------------------------------------------------------------------ decontamination


def plain_subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_hashed_words_are_the_words():
    """Equal words have equal hashes wherever they stand, different ones different ones, and each text its number."""
    texts = [b"One, two\t(one) TWO  ...\n", b"", b"   ", "\u00e9t\u00e9 \u00c9t\u00e9 x\x0by\x0cz".encode(), b"one", bytes(range(1, 256)), b"-"]
    for signs in (b"", semantic_leaks._SIGNS):
        words = [[w for w in (x.strip(signs) if signs else x for x in t.lower().split()) if w] for t in texts]
        held = HashedWords(texts, signs)
        flat = [w for t in words for w in t]
        assert np.diff(held.offs).tolist() == [len(t) for t in words] and held.docs().tolist() == [k for k, t in enumerate(words) for _ in t]
        assert len(dict(zip(held.hashes.tolist(), flat, strict=True))) == len(set(zip(held.hashes.tolist(), flat, strict=True))) == len(set(flat))
    assert len(HashedWords([]).hashes) == 0 and HashedWords([]).offs.tolist() == [0]
    long = HashedWords([b"ab cd " * 900_000])
    assert len(long.hashes) == 1_800_000 and len(np.unique(long.hashes)) == 2


def test_common_subsequence():
    rng = random.Random(0)
    for _ in range(60):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(0, 30))] for _ in range(2))
        assert semantic_leaks.common_subsequence(a, b) == plain_subsequence(a, b)


def plain_words(text):
    """The text's words lowered and without signs at their ends, one space between."""
    signs = "".join(map(chr, semantic_leaks._SIGNS))
    lowered = text.encode().lower().decode()
    return " ".join(w for w in (x.strip(signs) for x in lowered.encode().split(b" ") for x in x.decode().split()) if w)


def test_planted_paraphrases(spark):
    """Items with a fifth of their words changed are found in nine of ten cases; clean documents are left alone."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id < 400")
    items = {r.item_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()}
    rng, rows, planted = random.Random(1), [], {}
    normal = {i: plain_words(t) for i, t in items.items()}
    for k, r in enumerate(docs.collect()):
        text = r.text
        clean = not any(f" {n} " in f" {plain_words(text)} " for n in normal.values())
        if k % 8 == 0 and clean:
            item = rng.choice(sorted(items))
            words = [w if rng.random() > 0.2 else f"zz{rng.randint(0, 99)}" for w in items[item].split()]
            at = rng.randrange(len(text.split()) + 1)
            text = " ".join([*text.split()[:at], *words, *text.split()[at:]])
            planted[r.doc_id] = item
        rows.append((r.doc_id, text, clean and r.doc_id not in planted))
    found = semantic_leaks.leaks(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame(list(items.items()), "item_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    assert sum((d, i) in got for d, i in planted.items()) >= 0.9 * len(planted)
    assert sum(d in {d for d, _, clean in rows if clean} for d, _ in got) <= 2


def planted(items, docs, share, rng):
    """Texts with an item in each, of which a share of the words are replaced by words of other texts."""
    words = [w for t in docs for w in t.split()]
    out = []
    for k, item in enumerate(items):
        own = docs[k % len(docs)].split()
        at = rng.randrange(len(own) + 1)
        out.append(" ".join([*own[:at], *(w if rng.random() >= share else rng.choice(words) for w in item.split()), *own[at:]]))
    return out


def test_recall_and_the_part_of_the_latent_space(spark):
    """Nine of ten items are found, verbatim and with up to three tenths of their words replaced, and it is the cosine
    that proposes them: few other pairs of document and item are candidates, and none is left with vectors of noise."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").orderBy("item_id").collect()]
    texts = [r.text for r in table.where("length(text) < 4000").orderBy("doc_id").collect()]
    weight = semantic_leaks.term_weights(table)
    space = semantic_leaks.latent_space(table, weight)
    prepared = semantic_leaks.prepare_items(list(range(len(items))), [i.encode() for i in items], space, weight)
    scaled = semantic_leaks._scaled(space, weight)
    for share in (0, 0.2, 0.3):
        rows = [t.encode() for t in planted(items, texts, share, random.Random(3))]
        found = semantic_leaks.find_leaks(rows, prepared, scaled)
        assert sum(k in {i for i, _ in hits} for k, hits in enumerate(found)) >= 0.9 * len(items)
    vectors = semantic_leaks._vectors(semantic_leaks._normal_words(rows), scaled)
    assert semantic_leaks.near_passages(vectors, prepared, slice(0, len(items))).mean() < 0.15
    noise = np.random.default_rng(1).standard_normal(prepared.vectors.shape).astype(np.float32)
    prepared.vectors = semantic_leaks._unit(noise)
    assert sum(map(len, semantic_leaks.find_leaks(rows, prepared, scaled))) < 0.1 * len(items)


def plain_leaks(text, items, space, weight):
    """All passages of a text against all passages of all items, one by one."""
    out = []
    words = semantic_leaks._normal_words([text]).hashes.tolist()

    def windows(words):
        n = len(words)
        count = -(-(n - semantic_leaks.WIDTH) // semantic_leaks.STRIDE) + 1 if n > semantic_leaks.WIDTH else int(n > 0)
        return [(k * semantic_leaks.STRIDE, words[k * semantic_leaks.STRIDE :][: semantic_leaks.WIDTH]) for k in range(count)]

    def vector(words, begin):
        """Terms count at their first place within WIDTH words, also of what lies before the window."""
        total = np.zeros(space.shape[1])
        terms = semantic_leaks.term_numbers(np.array(words, np.uint64))
        for k in range(begin, min(begin + semantic_leaks.WIDTH, len(words))):
            if terms[k] not in terms[max(0, k - semantic_leaks.WIDTH + 1) : k]:
                total += space[terms[k]] * weight[terms[k]]
        return total / max(np.linalg.norm(total), 1e-12)

    mine = [(at, vector(words, at)) for at, _ in windows(words)]
    for number, item in enumerate(items.words):
        own = [vector(item, at) for at, _ in windows(item)]
        spread = semantic_leaks.WIDTH + 2 * len(item)
        answer, need = items.answers[number], max(1, math.ceil(semantic_leaks.ANSWER_SHARE * len(items.answers[number])))
        spots = [k for k, w in enumerate(words) if w in answer]
        places = [a for a, b in zip(spots, spots[need - 1 :], strict=False) if b - a < spread]
        best, done = 0.0, -1
        for at, v in mine:
            if max((float(v @ o) for o in own), default=-1) < semantic_leaks.NEAR or not any(at - spread <= p <= at + spread for p in places) or at + semantic_leaks.WIDTH <= done:
                continue
            begin, done = max(0, at - len(item)), min(len(words), at + semantic_leaks.WIDTH + len(item))
            around = words[begin:done]
            if len(answer & set(around)) >= semantic_leaks.ANSWER_SHARE * len(answer):
                best = max(best, plain_subsequence(item, around) / len(item))
        if best * len(item) >= max(semantic_leaks.COVER * len(item), min(len(item), semantic_leaks.LEAST_WORDS)):
            out.append((number, round(best, 9)))
    return out


def test_search_equals_plain_search(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r.text.encode() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = [r.text for r in table.where("length(text) < 1500").orderBy("doc_id").limit(25).collect()]
    rows = [t.encode() for t in planted([i.decode() for i in items], texts, 0.25, random.Random(5))] + [b"", b"one two", b"the " * 300]
    weight = semantic_leaks.term_weights(table)
    space = semantic_leaks.latent_space(table, weight)
    prepared = semantic_leaks.prepare_items(list(range(len(items))), items, space, weight)
    got = semantic_leaks.find_leaks(rows, prepared, semantic_leaks._scaled(space, weight))
    assert [[(i, round(s, 9)) for i, s in hits] for hits in got] == [plain_leaks(t, prepared, space, weight) for t in rows]


def test_leaks_odd_rows(spark):
    item = "the quick brown fox jumps over the lazy dog while seven wizards brew potions quietly"
    docs = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "!!! ..."), (None, item), (5, "pad " * 9000 + item)], "doc_id long, text string").selectExpr("*", "1 as share")
    bench = spark.createDataFrame([(7, item), (8, None), (9, ""), (None, item)], "item_id long, text string")
    assert Counter((r.doc_id, r.item_id) for r in semantic_leaks.leaks(docs, bench).collect()) == Counter([(1, 7), (1, 7), (None, 7), (5, 7)])
    kept = semantic_leaks.drop_leaks(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {2, 3, 4}
    assert semantic_leaks.leaks(docs, bench.limit(0)).count() == semantic_leaks.leaks(docs.limit(0), bench).count() == 0


def test_short_items_need_all_their_words(spark):
    docs = spark.createDataFrame([(1, "pale moon over old quiet harbour"), (2, "pale moon over new quiet streets"), (3, "nothing")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "pale moon over old quiet harbour")], "item_id long, text string")
    assert [r.doc_id for r in semantic_leaks.leaks(docs, bench).collect()] == [1]


def test_large_benchmarks_go_in_parts(spark, monkeypatch):
    monkeypatch.setattr(semantic_leaks, "MOST_ITEMS_BYTES", 1)
    test_leaks_odd_rows(spark)


# ------------------------------------------------------------------ language model


def plain_scores(texts, order=2):
    """(held_out, n_tokens, n_known, base, score) of (id, text) rows, n-gram by n-gram."""
    words = [(d, [*(t or "").encode().lower().split(), b"\n"]) for d, t in texts]
    held = [d is not None and zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in words]
    grams = [Counter() for _ in range(order)]
    for (_, w), h in zip(words, held, strict=True):
        if not h:
            full = [None, *w]
            for k in range(order):
                grams[k].update(tuple(full[i - k : i + 1]) for i in range(max(1, k), len(full)))
    starts = sum(not h for h in held)
    n, v = sum(grams[0].values()), len(grams[0])
    out = []
    for (_, w), h in zip(words, held, strict=True):
        full, base, score = [None, *w], 0.0, 0.0
        for i in range(1, len(full)):
            p = (grams[0][full[i],] + 0.5) / (n + 0.5 * (v + 1))
            base += math.log10(p)
            for k in range(1, order):
                if i < k:
                    break
                context = tuple(full[i - k : i])
                seen = starts if context == (None,) else grams[k - 1][context]
                if seen:
                    p = (grams[k][tuple(full[i - k : i + 1])] + backoff_lm.MASS * p) / (seen + backoff_lm.MASS)
            score += math.log10(p)
        out.append((h, len(w), sum(grams[0][x,] > 0 for x in w), n, base, score))
    return out


def compare(got, texts, order=2):
    want = Counter((str(d), *x[:4], round(x[4], 6), round(x[5], 6)) for (d, _), x in zip(texts, plain_scores(texts, order), strict=True))
    assert Counter((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got) == want


def test_scores_of_given_texts(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    compare(queries.lm_scores(spark, SF).collect(), texts)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_of_odd_texts(spark, monkeypatch, order):
    monkeypatch.setattr(backoff_lm, "BLOCK_BYTES", 40)  # many blocks
    texts = [(1, "a b A b"), (2, None), (3, ""), (4, "b a b c"), (4, "b a b c"), (None, "a"), (5, "x " * 500), (17, "a b q")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "0 as score", "0 as block")
    compare(backoff_lm.score_texts(docs, order=order).collect(), texts, order)
    assert backoff_lm.score_texts(docs.limit(0), order=order).count() == 0


def test_probabilities_sum_to_one():
    words = [b"a", b"b", b"c", b"\n", b"never"]
    train = [(0, "a b a"), (2, "b c"), (3, "a a b")]
    total = sum(10 ** (plain_scores([*train, (1, "")])[0][5] * 0) for _ in words)  # as many as words
    assert total == len(words)
    texts = [t for _, t in train]
    grams = Counter(w for t in texts for w in [*t.split(), "\n"])
    pairs = Counter(p for t in texts for p in zip(t.split(), [*t.split()[1:], "\n"]))
    n, v, m = sum(grams.values()), len(grams), backoff_lm.MASS
    root = {w: (grams[w] + 0.5) / (n + 0.5 * (v + 1)) for w in [*grams, "unknown"]}
    assert math.isclose(sum(root.values()), 1)
    assert math.isclose(sum((pairs["a", w] + m * p) / (grams["a"] + m) for w, p in root.items()), 1)


# ------------------------------------------------------------------ URL filter


def plain_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    return host, path[: min([i for i in map(path.find, "?#") if i >= 0], default=len(path))]


def plain_rule(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in host_trust.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


URLS = [None, "", "no scheme", "http://", "http://Www.Example.ORG/es/x?y", "https://example.org/en/17#t", "ftp://a.com/fr/", "x://b.com/de/q", "http://b.com", "http://org", "http://org/",
        "http://borg/", "http://u@c.net:80/p//q://r", "http://a.com?x=/fr/", "HTTP://É.com/fr/é"]


def test_urls_and_rules(spark):
    pages = spark.createDataFrame([(k, u, None, "z") for k, u in enumerate(URLS)] + [(1, "", None, "z")], "page_id long, url string, html string, host string")
    rows = host_trust.filter_urls(pages).collect()
    assert len(rows) == len(URLS) + 1
    for r in rows:
        host, path = plain_url(URLS[r.page_id])
        rule, verdict = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")
    assert host_trust.filter_urls(pages.limit(0)).count() == 0


def test_spread_against_a_matrix(spark):
    rng = np.random.default_rng(0)
    n = 12
    adjacent = rng.random((n, n)) < 0.2
    np.fill_diagonal(adjacent, False)
    edges = [("t", f"h{i}", f"h{j}") for i in range(n) for j in range(n) if adjacent[i, j]]
    seeds = [("t", "h1"), ("t", "h4")]
    got = {r.host: r["rank"] for r in host_trust.spread(spark.createDataFrame(edges, "kind string, src string, dst string"), spark.createDataFrame(seeds, "kind string, host string")).collect()}
    start = np.zeros(n)
    start[[1, 4]] = 0.5
    rank = start
    step = adjacent / np.maximum(adjacent.sum(1, keepdims=True), 1)
    for _ in range(host_trust.STEPS):
        rank = 0.15 * start + 0.85 * rank @ step
    assert all(math.isclose(got.get(f"h{i}", 0.0), rank[i], abs_tol=1e-12) for i in range(n))


def test_distrust_runs_against_links(spark):
    html = '<a href="http://bad.com/de/x">x</a> <A HREF=\'https://other.net/\'>y</A> <a href="/local">z</a>'
    pages = spark.createDataFrame(
        [(1, "http://bad.com/de/1", ""), (2, "http://farm.info/p", html), (3, "http://good.org/a", '<a href="http://friend.info/">'), (4, "http://friend.info/", ""), (5, "http://alone.info/", None)],
        "page_id long, url string, html string",
    )
    got = {r.page_id: (r.rule, r.verdict) for r in host_trust.filter_urls(pages).collect()}
    assert got == {1: ("com/de/", "block"), 2: (None, "block"), 3: ("org/", "allow"), 4: (None, "allow"), 5: (None, "allow")}


# ------------------------------------------------------------------ pipeline


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before, at = docs, docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, at, SF).write.parquet(f"{tmp_path}/{k}")
        before, at = at, spark.read.parquet(f"{tmp_path}/{k}")
        if name != "packing":
            assert at.columns == docs.columns
            assert {r.doc_id for r in at.select("doc_id").collect()} <= {r.doc_id for r in before.select("doc_id").collect()}
        if name == "near_dedup":
            from test_dedup import plain_components

            groups = plain_components({r.doc_id: r.text for r in before.collect()}, 80)
            assert sorted(r.doc_id for r in at.collect()) == sorted(k for k, (_, c) in groups.items() if k == c)
    left = {r.doc_id: len((r.text or "").encode().split()) + 1 for r in before.collect()}
    packed = Counter()
    for r in at.collect():
        packed[r.doc_id] += r.n_tokens
    assert packed == left


def test_pipeline_odd_rows(spark, tmp_path):
    good = [" ".join(random.Random(k).choices(["some", "plain", "words", "of", "prose", f"t{k}", f"u{k}"], k=70)) for k in range(4)]
    rows = [(1, good[0], "en"), (1, good[0], "en"), (2, good[0], "en"), (3, None, None), (4, "", "en"), (None, good[1], "en"), (None, good[1], "en"), (5, good[2] * 300, "en")]
    spark.createDataFrame(rows, "doc_id long, text string, gone string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, good[3])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert Counter(r.doc_id for r in out.where("piece = 0").collect()) == Counter({1: 1, 3: 1, 4: 1, None: 2, 5: 1})


def test_all_are_registered():
    names = contract.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


def test_terms_are_counted_by_document(spark):
    """Forms of a word, and words of one hashed term, count once for a text."""
    terms = semantic_leaks._TERMS
    names = [b"w%d" % k for k in range(3 * terms)]
    numbers = semantic_leaks.term_numbers(HashedWords(names).hashes)
    twin = next(k for k in range(1, len(names)) if numbers[k] == numbers[0])
    texts = [f"w0 w0, w0. (w0) W0 w{twin} ...", "other", None, "more words"]
    weight = semantic_leaks.term_weights(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert np.isclose(weight[numbers[0]], (np.log(5 / 2) + 0.1) ** 2)


NAMES = [f"w{k}" for k in range(150)]


def texts_of_all_lengths():
    """More texts than any sample of 5,000 holds; null and empty ones among them."""
    rng = random.Random(5)
    texts = [" ".join(rng.choices(NAMES[k % 80 : k % 80 + 70], k=rng.choice((1, 3, 8, 9, 20)))) for k in range(6000)]
    return texts + [" ".join(rng.choices(NAMES, k=n)) for n in (31, 32, 33, 39, 40, 41, 100, 333)] + [None, "", "..."]


def plain_space(texts, weight):
    """The terms in use, and the space of all windows, one by one."""
    width = semantic_leaks.WIDTH
    number = dict(zip(NAMES, semantic_leaks.term_numbers(HashedWords([n.encode() for n in NAMES]).hashes).tolist(), strict=True))
    used = sorted(set(number.values()))
    windows = []
    for text in texts:
        words = [used.index(number[w]) for w in (text or "").split() if w in number]
        for at in range(0, max(len(words) - width, 0) + semantic_leaks.STRIDE if words else 0, semantic_leaks.STRIDE):
            row = np.zeros(len(used))
            for k in range(at, min(at + width, len(words))):
                row[words[k]] += words[k] not in words[max(0, k - width + 1) : k]
            windows.append(row * weight[used])
    unit = np.array(windows) / np.maximum(np.linalg.norm(windows, axis=1, keepdims=True), 1e-9)
    space = np.linalg.qr(np.random.default_rng(7).standard_normal((semantic_leaks._TERMS, semantic_leaks.RANK)))[0][used]
    for _ in range(semantic_leaks.POWER):
        space = np.linalg.qr(unit.T @ (unit @ space))[0]
    return used, space


def same_space(got, want, used):
    return np.abs(got[used] @ got[used].T - want @ want.T).max() < 1e-3


def test_space_is_fitted_on_all_passages(spark):
    """However many documents there are, null and repeated ids among them."""
    texts = texts_of_all_lengths()
    table = spark.createDataFrame([(None if k % 7 == 0 else k // 2, t) for k, t in enumerate(texts)], "doc_id long, text string")
    weight = semantic_leaks.term_weights(table)
    used, want = plain_space(texts, weight)
    assert same_space(semantic_leaks.latent_space(table, weight), want, used)


def test_pipeline_learns_from_all_documents_it_cleans(spark, tmp_path, monkeypatch):
    """The stage searches in the space of all documents that it is given, and drops the one in which the item leaks."""
    texts, item = texts_of_all_lengths(), " ".join(NAMES[:40])
    texts += [" ".join([*NAMES[100:120], item, *NAMES[120:150]])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    seen, prepare = [], semantic_leaks.prepare_items
    monkeypatch.setattr(semantic_leaks, "prepare_items", lambda *given: seen.append(given[2:]) or prepare(*given))
    kept = {r.doc_id for r in corpus_pipeline.decontaminate(spark, docs, str(tmp_path)).select("doc_id").collect()}
    assert kept == set(range(len(texts) - 1))
    ((space, weight),) = seen
    used, want = plain_space(texts, weight)
    assert same_space(space, want, used)
