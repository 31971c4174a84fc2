"""Near duplicates, line templates, passages and packing against plain versions, and on odd rows."""

import itertools
import random
from collections import Counter, defaultdict

import compare
import numpy as np
import pytest

from ledgerlake.llm import bin_packing, components, line_templates, near_dup, passage_chains, queries
from ledgerlake.llm.text import windows

SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def folder(spark):
    queries.shared_folder(spark)


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def plain_components(texts, percent=85):
    sets = {k: shingles(t) for k, t in texts.items()}
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and both and 100 * both >= percent * len(sets[a] | sets[b]):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {k: (len(s), find(k)) for k, s in sets.items()}


def near_texts(seed, n, groups):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 90))) for _ in range(n)]
    for _ in range(groups):
        base = rng.choices(words, k=120)
        for _ in range(rng.randint(2, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    return dict(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_of_random_groups(spark, seed):
    texts = near_texts(seed, 60, 12) | {900: "", 901: None, 902: "a B", 903: "A b", 904: "x"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(docs).collect()}
    assert got == plain_components(texts)


def test_near_duplicates_of_given_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = queries.near_dedup(spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == plain_components(texts)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_near_duplicates_match_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = compare.connect(sf)
    assert compare.differences(queries.near_dedup(spark, sf), con, queries.SQL["op2_near_dedup"]) == []
    con.close()


def test_large_regions_and_blocks(spark, monkeypatch):
    """With tiny limits every region is large and every class is dealt out in blocks; the result stays the same."""
    texts = near_texts(3, 20, 6)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for name, value in (("REGION", 3), ("SMALL", 1), ("BLOCK", 3)):
        monkeypatch.setattr(near_dup, name, value)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(docs).collect()}
    assert got == plain_components(texts)


@pytest.mark.parametrize("percent", [80, 90])
def test_near_duplicates_from_another_threshold_on(spark, percent):
    words = [f"w{k}" for k in range(104)]  # 100 shingles; of each changed word at an end one shingle is lost on either side
    texts = {0: " ".join(words)} | {k: " ".join([*words[:-k], *(f"x{k}_{j}" for j in range(k))]) for k in range(1, 20)}
    rows = near_dup.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), percent).collect()
    sets = {k: shingles(t) for k, t in texts.items()}
    root = {k: k for k in texts}
    for _ in texts:
        for a, b in itertools.combinations(texts, 2):
            if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[a] = root[b] = min(root[a], root[b])
    assert {r.doc_id: r.component_id for r in rows} == root and len(set(root.values())) > 1


def test_near_duplicates_odd_rows(spark):
    rows = [(1, "a b c d e f", 0), (1, "a b c d e f", 0), (2, "A B C D E F", 0), (None, "a b c d e f", 0), (3, "w " * 20_000, 0), (4, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component long")
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(docs).collect())
    assert got == Counter([(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (None, 2, None, True), (3, 1, 3, True), (4, 0, 4, True)])
    assert near_dup.near_duplicates(docs.limit(0)).count() == 0


def test_components_of_a_long_path(spark):
    path = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)]
    rows = components.components(spark.createDataFrame(path, "u long, v long")).collect()
    assert {r.vertex: r.component for r in rows} == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def test_windows_stay_inside_documents():
    h = np.arange(1, 9, dtype=np.uint64)
    got, counts = windows(h, np.array([0, 2, 2, 8]), 3)
    assert counts.tolist() == [0, 0, 4] and len(set(got.tolist())) == 4
    assert windows(h, np.array([0, 8]), 3)[0][2:].tolist() == got.tolist()


# ------------------------------------------------------------------ lines


def line_docs(spark):
    own = ["alpha beta gamma delta unique{0} epsilon{0} zeta{0} eta{0}", "second own line of text{0} here{0} now{0} then{0}"]
    rows = []
    for k in range(8):
        text = "\n".join([own[0].format("abcdefgh"[k]), f"served in {k} ms from host node{k} today ok", own[1].format("abcdefgh"[k] * 2)])
        rows.append((k, text, "x"))
    rows += [(50 + k, "whole text copied a b c\nsecond line copied too d e f", "x") for k in range(7)]
    rows += [(90, None, "x"), (91, "", "x"), (92, "\n\n", "x"), (93, "solo line with five words", None), (None, "served in 3 ms from host node3 today ok", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, gone string")


def test_recurring_templates_are_dropped(spark):
    docs = line_docs(spark)
    before = {r.doc_id: r.text for r in docs.collect()}
    out = line_templates.drop_recurring_lines(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    after = {r.doc_id: r.text for r in out.collect()}
    assert after[0] == before[0]  # the first that has it
    for k in range(1, 8):
        lines = before[k].split("\n")
        assert after[k] == "\n".join([lines[0], lines[2]])
    for k in before:
        if k is None or k >= 50:
            assert after[k] == before[k]
    assert line_templates.drop_recurring_lines(docs.limit(0)).count() == 0


def test_hot_leaf_in_shards(spark, monkeypatch):
    monkeypatch.setattr(line_templates, "SHARD_LINES", 2)
    test_recurring_templates_are_dropped(spark)


def test_large_leaf_keeps_templates_of_single_lines(spark, monkeypatch):
    """Lines with alphabetic variables, each in one document, meet however small the parts of a leaf are."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghij", k=8))
    own = lambda: " ".join(word() for _ in range(12))
    rows = [(k, f"{own()}\nserved in full by the {word()} host {word()} ok") for k in range(6)]
    rows += [(100 + k, f"{own()}\nserved in full " + " ".join(word() for _ in range(6))) for k in range(300)]  # the same leaf
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def dropped():
        before, after = ({r.doc_id: r.text for r in d.collect()} for d in (docs, line_templates.drop_recurring_lines(docs)))
        return {k for k in before if before[k] != after[k]}

    whole = dropped()
    assert whole == set(range(1, 6))
    for lines in (2, 200):
        monkeypatch.setattr(line_templates, "SHARD_LINES", lines)
        assert dropped() == whole


def test_documents_are_counted_by_template(spark):
    """Lines of one template in one document count once for it."""
    line, own = "the {} of the frame is set to {}".format, "some words of its own {0} that {0} no {0} other {0} text {0} has {0} at all {0} so {0} they {0} stay {0}".format
    names = "abcdefghijklmnopqrst"
    rows = [(k, "\n".join([*(own(c * 5 + names[k]) for c in "xyz"), *(line("part", names[k] * 3 + c) for c in "uvw")])) for k in range(2)]
    rows += [(7 + k, f"the part of {c}{c} q{c} r{c} s{c} t{c} u{c}") for k, c in enumerate(names[10:15])]  # five documents have the leaf
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert dict(line_templates.drop_recurring_lines(docs).collect()) == dict(rows)
    rows += [(20 + k, own(names[k] * 7) + "\n" + line("part", names[k] * 6)) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    after = dict(line_templates.drop_recurring_lines(docs).collect())
    assert {k for k, text in rows if after[k] != text} == {1, 20, 21, 22}


def test_boilerplate_goes_whatever_its_share(spark):
    """A footer longer than the page, and a short menu line, go from all but the first page; copies keep their lines."""
    footer = "\n".join(f"{c} this part of the footer is the same on every page of it" for c in "pqrst")
    own = lambda k: " ".join(f"own{k}x{i}" for i in range(40))
    rows = [(k, f"{own(k)}\nHome 2\n{footer}") for k in range(25)] + [(40 + k, f"whole copy of one\n{footer}\nand its own end line") for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    after = dict(line_templates.drop_recurring_lines(docs).collect())
    assert after == dict(rows) | {k: own(k) for k in range(1, 25)}


def test_grow_generalises_what_differs():
    lines = [(b"a b c d".split(), 2), (b"a b x d".split(), 1), (b"q r s t".split(), 1)]
    assert line_templates.grow(lines) == [(b"a b <*> d".split(), 3), (b"q r s t".split(), 1)]


# ------------------------------------------------------------------ passages


def test_planted_passages(spark):
    rng = random.Random(5)
    words = [f"v{i}" for i in range(5000)]
    texts = {k: rng.choices(words, k=rng.randint(0, 300)) for k in range(40)}
    passage = rng.choices(words, k=80)
    planted = {}
    for k in (3, 11, 20, 33):
        changed = list(passage)
        if k > 3:
            for _ in range(3):
                changed[rng.randrange(80)] = "other"
            del changed[rng.randrange(80)]
        at = rng.randrange(len(texts[k]) + 1)
        texts[k] = texts[k][:at] + changed + texts[k][at:]
        planted[k] = at
    rows = [(k, " ".join(t), 1) for k, t in texts.items()] + [(100, None, 1), (101, "", 1), (102, "too short", 1), (None, " ".join(passage), 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, at int")
    got = passage_chains.repeated_passages(docs).collect()
    assert {r.doc_id for r in got} == {11, 20, 33} and {r.ref_id for r in got} <= {3, 11, 20}
    reach = passage_chains.K + passage_chains.WINDOW  # an end that a skipped word cuts off may be too short for a seed
    for r in got:
        assert abs(r.first_word - planted[r.doc_id]) <= reach and abs(r.past_word - planted[r.doc_id] - 79) <= reach
        assert r.n_same >= 50
    assert passage_chains.repeated_passages(docs.limit(0)).count() == 0


def test_exact_repeats_are_found(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    first, want = {}, defaultdict(set)
    texts = {r.doc_id: (r.text or "").encode().lower().split() for r in docs.collect()}
    for k in sorted(texts):
        for i in range(len(texts[k]) - 59):
            if first.setdefault(tuple(texts[k][i : i + 60]), k) != k:
                want[k].add(i)
    got = {r.doc_id for r in queries.substring_dedup(spark, SF).collect()}
    assert len(set(want) - got) <= 0.02 * len(want)


def plain_chain(pos, ref):
    best = []
    for i in range(len(pos)):
        options = [
            best[j] + 1 - passage_chains.GAP_COST * (pos[i] - pos[j] + ref[i] - ref[j])
            for j in range(i)
            if pos[j] < pos[i] and ref[j] < ref[i]
        ]
        best.append(max([1.0, *options]))
    return max(best)


def test_chains_weigh_as_much_as_all_pairs_say():
    rng = np.random.default_rng(0)
    for _ in range(50):
        pos = np.sort(rng.integers(0, 40, size=14))
        ref = rng.integers(0, 40, size=14)
        order = np.lexsort((ref, pos))
        weight, members = passage_chains._best_chain(pos[order], ref[order])
        assert np.isclose(weight, plain_chain(pos[order], ref[order]))
        assert (np.diff(pos[order][members]) > 0).all() and (np.diff(ref[order][members]) > 0).all()


def test_chains_of_swapped_passages(spark):
    """Exact passages of 50 words are chained beside another in swapped order as they are alone."""
    rng = random.Random(3)
    words = lambda n: [f"u{rng.randrange(10**9)}" for _ in range(n)]
    rows, want = [], set()
    for k in range(40):
        a, b = words(50), words(50)
        rows += [(2 * k, " ".join([*words(30), *a, *words(70), *b])), (2 * k + 1, " ".join([*b, *words(90), *a, *words(20)]))]
        want |= {(2 * k + 1, 0, 50), (2 * k + 1, 140, 190)}
    got = passage_chains.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.first_word, r.past_word) for r in got} == want


def test_seeds_elsewhere_take_no_passage_away(spark):
    """A passage is found though smaller ids have all of its six-word windows, each alone, or the document has one twice."""
    rng = random.Random(4)
    words = lambda n: [f"t{rng.randrange(10**9)}" for _ in range(n)]
    passage, twice = words(60), words(60)
    single = [(k, " ".join([*words(20), *passage[k : k + 6], *words(20)])) for k in range(55)]
    rows = [(100, [*words(30), *passage, *words(30)]), (200, [*words(40), *passage, *words(9)]), (300, [*words(9), *twice])]
    again = [w for k in range(55) for w in [*twice[k : k + 6], *words(20)]]
    rows = single + [(k, " ".join(t)) for k, t in [*rows, (400, [*again, *twice])]]
    got = passage_chains.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.ref_id, r.first_word, r.past_word) for r in got} == {(200, 100, 40, 100), (400, 300, len(again), len(again) + 60)}


def test_parts_of_a_passage_elsewhere_take_it_not_away(spark):
    """Twenty passages of 60 words in two documents; parts of 30 to 36 words of each in three documents with smaller ids."""
    rng = random.Random(6)
    words = lambda n: [f"p{rng.randrange(10**9)}" for _ in range(n)]
    passages = [words(60) for _ in range(20)]
    rows = []
    for k in range(3):
        parts = [words(25) + p[a : a + rng.randint(30, 36)] for p in passages for a in [rng.randint(0, 24)]]
        rows.append((k, " ".join(w for p in parts for w in p)))
    want = set()
    for k in (10, 20):
        text = words(10)
        for p in rng.sample(passages, 20):
            if k == 20:
                want.add((len(text), len(text) + 60))
            text += p + words(80)
        rows.append((k, " ".join(text)))
    rows += [(30, " ".join(words(500))), (40, None)]
    got = passage_chains.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.first_word, r.past_word) for r in got if (r.doc_id, r.ref_id) == (20, 10)} == want
    assert {r.doc_id for r in got} == {20}


def test_changed_passages_against_all_pairs(spark):
    """Passages of 80 to 200 words, and up to three copies with a tenth of their words changed: of the words that comparing
    all pairs along all diagonals finds nine tenths are found, and nearly nothing else."""
    rng = random.Random(8)
    words = lambda n: [f"c{rng.randrange(10**6)}" for _ in range(n)]
    texts = {k: words(rng.randint(50, 200)) for k in range(60)}
    for _ in range(25):
        passage = words(rng.randint(80, 200))
        first = True
        for k in rng.sample(sorted(texts), rng.randint(2, 4)):
            at = rng.randrange(len(texts[k]) + 1)
            texts[k][at:at] = passage if first else [w if rng.random() > 0.1 else f"x{rng.randrange(10**6)}" for w in passage]
            first = False
    want = set()
    for a, b in itertools.combinations(sorted(texts), 2):
        for shift in range(-len(texts[a]), len(texts[b])):
            low, high = max(0, -shift), min(len(texts[a]), len(texts[b]) - shift)
            if high - low >= 50:
                same = np.array([texts[a][i] == texts[b][i + shift] for i in range(low, high)])
                want |= {(b, low + first + shift, low + past + shift) for first, past, _ in passage_chains.stretches(same)}
    assert len(want) > 50
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in texts.items()], "doc_id long, text string")
    got = passage_chains.repeated_passages(docs, block_bytes=4000).collect()
    words_of = lambda spans: {(d, i) for d, first, past in spans for i in range(first, past)}
    asked, found = words_of(want), words_of((r.doc_id, r.first_word, r.past_word) for r in got)
    assert len(asked & found) >= 0.9 * len(asked) and len(asked & found) >= 0.95 * len(found)


def test_all_documents_that_share_a_changed_passage_are_paired(spark):
    """Twelve documents have a passage, each with four words changed, so that none shares a longer run with one than with others."""
    rng = random.Random(12)
    words = lambda n: [f"a{rng.randrange(10**9)}" for _ in range(n)]
    passage, rows, at = words(90), [], {}
    for k in range(12):
        changed = [f"x{rng.randrange(10**9)}" if i in (17, 35, 53, 71) else w for i, w in enumerate(passage)]
        at[k] = rng.randrange(40)
        rows.append((k, " ".join([*words(at[k]), *changed, *words(rng.randrange(40))])))
    got = passage_chains.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.ref_id) for r in got} == {(b, a) for a, b in itertools.combinations(range(12), 2)}
    assert all((r.first_word, r.past_word, r.ref_word, r.n_same) == (at[r.doc_id], at[r.doc_id] + 90, at[r.ref_id], 86) for r in got)


def test_copies_and_exact_passages_name_the_first(spark, monkeypatch):
    """Also in several passes, over seeds that hundreds of places have."""
    rng = random.Random(13)
    words = lambda n: [f"e{rng.randrange(10**9)}" for _ in range(n)]
    copied, passage, line = words(70), words(90), words(12)
    rows = [(k, copied) for k in (5, 3, 9)] + [(k, [*words(20), *passage, *words(20)]) for k in (11, 12, 13, 14)]
    rows += [(k, [*words(3), *line * 200]) for k in (21, 22)] + [(30, None), (5, copied), (None, copied)]
    docs = spark.createDataFrame([(k, t and " ".join(t)) for k, t in rows], "doc_id long, text string")
    monkeypatch.setattr(passage_chains, "LEAST_LINKS", 2)
    monkeypatch.setattr(passage_chains, "LINKS_PER_BLOCK", 1)
    got = {(r.doc_id, r.ref_id, r.first_word, r.past_word) for r in passage_chains.repeated_passages(docs).collect()}
    assert {x for x in got if x[0] < 20} == {(5, 3, 0, 70), (9, 3, 0, 70), *((k, 11, 20, 110) for k in (12, 13, 14))}
    assert {(d, r) for d, r, _, _ in got if d > 20} == {(22, 21)}


def test_many_pairs_at_once_are_chained_and_aligned_as_each_alone(monkeypatch):
    """Also where seeds repeat and cross, in documents of all sizes, in small portions, and with few and many trees in step."""
    rng = np.random.default_rng(17)
    line = rng.integers(0, 1 << 32, 40, dtype=np.uint32)
    texts = []
    for k in range(24):
        parts = [line[rng.integers(0, 12) :] if rng.random() < 0.6 else rng.integers(0, 1 << 32, rng.integers(0, 40), dtype=np.uint32) for _ in range(rng.integers(0, 9))]
        text = np.concatenate([*parts, np.zeros(0, np.uint32)]).astype(np.uint32)
        text[rng.random(len(text)) < 0.03] = 7
        texts.append(np.tile(text, 6) if k % 5 == 0 else text)
    seeds, places = [], []
    for text in texts:
        grams = np.array([hash(tuple(text[i : i + passage_chains.K].tolist())) & (1 << 62) - 1 for i in range(len(text) - passage_chains.K + 1)], np.uint64)
        places.append(np.flatnonzero(passage_chains.winnowed(grams, np.array([0, len(grams)]), 4)).astype(np.int32))
        seeds.append(grams[places[-1]])
    held = passage_chains.Held(*([x.tobytes() for x in column] for column in (seeds, places, texts)))
    mine, ref = (np.array(x) for x in zip(*itertools.combinations(range(24), 2), strict=True))
    want = set()
    for k, (a, b) in enumerate(zip(mine.tolist(), ref.tolist(), strict=True)):
        pair, pos, other = passage_chains.common_seeds(held, mine[k : k + 1], ref[k : k + 1])
        if not len(pos):
            continue
        assert all(seeds[a][places[a] == p] == seeds[b][places[b] == q] for p, q in zip(pos, other, strict=True))
        for members in passage_chains.chain(pos, other):
            p, shift = pos[members], (other - pos)[members]
            low, high = max(0, p[0] - passage_chains.REACH), min(len(texts[a]), p[-1] + passage_chains.K + passage_chains.REACH)
            agree = lambda x, y, by: np.array([0 <= i + by < len(texts[b]) and texts[a][i] == texts[b][i + by] for i in range(x, y)], dtype=bool)  # noqa: B023, E731
            same, begin = [], low
            for by, nxt, end in zip(shift[:-1], shift[1:], p[1:], strict=True):
                if by != nxt:
                    old, new = agree(begin, end, by), agree(begin, end, nxt)
                    cut = int(np.argmax([old[:c].sum() + new[c:].sum() for c in range(end - begin + 1)]))
                    same, begin = [*same, old[:cut], new[cut:]], end
            same = np.concatenate([*same, agree(begin, high, shift[-1])])
            want |= {(k, low + first, low + past, max(0, low + first + shift[0]), n) for first, past, n in passage_chains.stretches(same)}
    for portion, least in ((1 << 20, 1), (200, 1 << 20), (3000, 2)):
        monkeypatch.setattr(passage_chains, "SEEDS_AT_ONCE", portion)
        monkeypatch.setattr(passage_chains, "WORDS_AT_ONCE", portion)
        monkeypatch.setattr(passage_chains, "LEAST_TREES", least)
        got = [row for found in passage_chains.pair_passages(held, mine, ref) for row in zip(*(x.tolist() for x in found), strict=True)]
        assert set(got) == want and len(want) > 40


def test_runs_are_the_passages_of_a_document_together(spark, monkeypatch):
    """Changed copies of one text: every pair is compared, and a row for each run says with how many documents it is shared."""
    rng = random.Random(19)
    words = lambda n: [f"r{rng.randrange(10**9)}" for _ in range(n)]
    text, other, rows = words(150), words(70), []
    for k in range(30):
        changed = [f"x{rng.randrange(10**9)}" if 20 <= i < 130 and i % 29 == k % 29 else w for i, w in enumerate(text)]
        rows.append((k, [*changed, *words(90), *(other if k >= 28 else [])]))
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in rows] + [(40, None)], "doc_id long, text string")
    monkeypatch.setattr(passage_chains, "ROWS_PER_COPY", 4)
    got = {(r.doc_id, r.first_word, r.past_word, r.n_refs, r.ref_id) for r in passage_chains.repeated_runs(docs).collect()}
    assert got == {(k, 0, 150, k, 0) for k in range(1, 30)} | {(29, 240, 310, 1, 28)}


def test_pairs_of_a_group_are_not_listed(spark, tmp_path, monkeypatch):
    """Every pair of 60 changed copies is compared, and what is written on the way has no row for each pair."""
    rng = random.Random(23)
    text = [f"p{rng.randrange(10**9)}" for _ in range(120)]
    rows = [(k, " ".join(f"q{rng.randrange(10**9)}" if i % 23 == k % 23 else w for i, w in enumerate(text))) for k in range(60)]
    monkeypatch.setattr(passage_chains, "scratch_folder", lambda _: str(tmp_path))
    monkeypatch.setattr(passage_chains, "ROWS_PER_COPY", 7)
    got = {(r.doc_id, r.ref_id) for r in passage_chains.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got >= {(a, b) for a in range(60) for b in range(a) if a % 23 != b % 23}
    written = {f.name: spark.read.option("recursiveFileLookup", "true").parquet(str(f)).count() for f in tmp_path.iterdir() if f.name != "passages" and any(f.rglob("*.parquet"))}
    assert max(written.values()) < 600, written


def test_copied_blocks_give_the_same_passages(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    whole = Counter(map(tuple, passage_chains.repeated_passages(docs).collect()))
    monkeypatch.setattr(passage_chains, "ROWS_PER_COPY", 2)
    assert Counter(map(tuple, passage_chains.repeated_passages(docs, block_bytes=50_000).collect())) == whole and whole


def test_every_run_keeps_its_least_hash():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 50, size=60).astype(np.uint64)
    offs = np.array([0, 3, 3, 40, 60])
    kept = passage_chains.winnowed(h, offs, 8)
    for a, b in itertools.pairwise(offs):
        runs = [range(a, b)] if b - a < 8 else [range(i, i + 8) for i in range(a, b - 7)]
        want = {j for r in runs if len(r) for j in r if h[j] == min(h[list(r)])}
        assert set(np.flatnonzero(kept[a:b]) + a) == want


# ------------------------------------------------------------------ packing


def test_packing_is_whole_and_tight(spark):
    lengths = [(k, n) for k, n in enumerate([1, 511, 512, 513, 4096, 4097, 9000, 100, 100, 7] * 30)] + [(5, 100), (None, 3)]
    rows = bin_packing.pack(spark.createDataFrame(lengths, "doc_id long, n_tokens long"), shard_tokens=60_000).collect()
    assert sum(r.n_tokens for r in rows) == sum(n for _, n in lengths)
    bins = defaultdict(list)
    for r in rows:
        bins[r.shard, r.bin].append(r)
    for members in bins.values():
        used = sum(r.n_tokens for r in members)
        (capacity,) = {r.capacity for r in members}
        assert used <= capacity and not any(used <= c < capacity for c in bin_packing.CAPACITIES)
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.n_tokens
    assert sum(n for _, n in lengths) / sum(m[0].capacity for m in bins.values()) > 0.9
    pieces = defaultdict(list)
    for r in rows:
        if r.doc_id is not None and r.doc_id != 5:
            pieces[r.doc_id].append((r.start, r.n_tokens))
    for k, n in lengths:
        if k in pieces:
            assert [s for s, _ in sorted(pieces[k])] == list(range(0, n, 4096)) and sum(m for _, m in pieces[k]) == n
    assert bin_packing.pack(spark.createDataFrame([], "doc_id long, n_tokens long")).count() == 0


def test_best_fit_takes_the_least_room():
    sizes = np.array([9, 8, 5, 2, 1])
    bins, offsets, caps = bin_packing.best_fit(sizes, (10,))
    assert bins.tolist() == [0, 1, 2, 1, 0] and offsets.tolist() == [0, 0, 0, 8, 9] and caps.tolist() == [10, 10, 10]
    assert bin_packing.best_fit(np.array([3, 2]), (4, 8, 16))[2].tolist() == [8]


def test_tokens_of_odd_texts(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a  b\tc"), (None, "x\u00a0y z")], "doc_id long, text string")
    assert {r.doc_id: r.n_tokens for r in bin_packing.count_tokens(docs).collect()} == {1: 1, 2: 1, 3: 4, None: 3}
