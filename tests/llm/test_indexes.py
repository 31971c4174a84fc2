"""Suffix-array dedup, ranked search and the conversation trie against plain versions and SQL, and on odd rows."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import compare
import numpy as np
import pytest

from ledgerlake.llm import block_max, queries, suffix_repeats, turn_trie
from ledgerlake.llm.blocks import numbers, pack_block, planes, scratch_folder, unpack_block, write_blocks
from ledgerlake.llm.shared_keys import Layout, read_flags, shared_keys
from ledgerlake.llm.suffix_arrays import permuted_prefixes, suffix_array

SF = "/root/testdata/sf0.01"


@pytest.fixture(autouse=True)
def folder(spark):
    queries.shared_folder(spark)


@pytest.mark.parametrize("name", ["op11_suffix_dedup", "op12_lexical_search", "op13_conversation_trie"])
def test_matches_sql(spark, name):
    assert compare.differences(queries.QUERIES[name](spark, SF), compare.connect(SF), queries.SQL[name]) == []


def test_blocks_give_back_what_went_in():
    ids, texts = [1, None, -(1 << 62)], [b"", "é".encode() * 1000, b"x"]
    back, text, offs = unpack_block(pack_block(ids, texts))
    assert back == ids and [text[a:b] for a, b in zip(offs[:-1], offs[1:], strict=True)] == texts
    for values in ([], [0], [255, 256], [1 << 63, 5]):
        assert numbers(planes(np.array(values, np.uint64))).tolist() == values


# ------------------------------------------------------------------ suffix arrays


def plain_order(symbols):
    """Suffixes up to their text's end, ends counting by their number."""
    ends = {p: k for k, p in enumerate(i for i, s in enumerate(symbols) if s == 0)}
    keys = []
    for i in range(len(symbols)):
        j = i
        while symbols[j]:
            j += 1
        keys.append(([*(int(x) + len(symbols) for x in symbols[i:j]), ends[j]], i))
    return [i for _, i in sorted(keys)]


@pytest.mark.parametrize("letters", [1, 2, 4, 300, 70_000])
def test_suffix_arrays_and_common_prefixes(letters):
    rng = random.Random(letters)
    for _ in range(150):
        texts = [[rng.randint(1, letters) for _ in range(rng.randint(0, 14))] for _ in range(rng.randint(1, 9))]
        texts += rng.choice([[], texts, texts[:1] * 3])
        symbols = np.array([x for t in texts for x in [*t, 0]])
        order = suffix_array(symbols)
        assert order.tolist() == plain_order(symbols)
        common = permuted_prefixes(symbols, order)
        assert common[order[0]] == 0
        for a, b in zip(order[:-1], order[1:], strict=True):
            n = 0
            while symbols[a + n] and symbols[a + n] == symbols[b + n]:
                n += 1
            assert common[b] == n


# ------------------------------------------------------------------ suffix dedup


def plain_removed(rows, length):
    first = {}
    for d, t in rows:
        for i in range(len(t) - length + 1 if d is not None else 0):
            first[t[i : i + length]] = min(d, first.get(t[i : i + length], d))
    out = []
    for d, t in rows:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1 if d is not None else 0):
            if first[t[i : i + length]] < d:
                gone[i : i + length] = b"\1" * length
        edges = [i for i in range(len(t) + 1) if (i and gone[i - 1]) != (i < len(t) and gone[i])]
        out.append((d, len(t), tuple(zip(edges[::2], edges[1::2], strict=True)), bytes(c for c, g in zip(t, gone, strict=True) if not g)))
    return Counter(out)


def removed(docs, **options):
    rows = suffix_repeats.repeated_strings(docs, **options).collect()
    return Counter((r.doc_id, r.n_bytes, tuple((s.begin, s.past) for s in r.spans), bytes(r.kept)) for r in rows)


@pytest.mark.parametrize(("length", "block_bytes", "hot_blocks"), [(50, 1 << 20, 1000), (50, 3000, 1000), (50, 3000, 1), (25, 2000, 2), (80, 2000, 2)])
def test_bytes_that_smaller_ids_have_go(spark, length, block_bytes, hot_blocks):
    rng = random.Random(length + block_bytes)
    passage = ["".join(rng.choice("abé ") for _ in range(rng.randint(40, 130))) for _ in range(6)]
    texts = [(rng.randint(-5, 60), "".join(rng.choice(passage) if rng.random() < 0.5 else "".join(rng.choice("xyz\n") for _ in range(rng.randint(0, 60))) for _ in range(rng.randint(0, 6)))) for _ in range(60)]
    texts += [(7, passage[0]), (7, passage[0]), (None, passage[1] * 3), (1 << 40, passage[0] + passage[0]), (3, None), (4, ""), (5, "short"), (99, "ab" * 4000), (98, "ab" * 30), (2, "\x00" * 200), (9, "\x00" * 100)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "0 as block", "'x' as data", "1 as part", "2 as kept")
    want = plain_removed([(d, (t or "").encode()) for d, t in texts], length)
    assert removed(docs.repartition(3), length=length, block_bytes=block_bytes, hot_blocks=hot_blocks) == want


@pytest.mark.parametrize("length", [30, 50])
def test_anchors_with_many_texts_are_dealt_by_window(spark, monkeypatch, length):
    monkeypatch.setattr(suffix_repeats, "TEXTS_PER_BLOCK", 1)
    rng = random.Random(length)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    line = word(70)
    texts = [(k, word(rng.randint(0, 40)) + line[rng.randint(0, 20) :] + word(rng.randint(0, 40))) for k in range(50)] + [(60 + k, line) for k in range(9)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    want = plain_removed([(d, t.encode()) for d, t in texts], length)
    assert removed(docs.repartition(2), length=length, block_bytes=500, hot_blocks=3) == want


def test_a_line_in_every_block_is_not_hot_for_that(spark):
    """Flags of a key that 30 blocks have once, of one that they have in ten texts each, and of one in a single block."""
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(30)], "doc_id long, text string").repartition(30, "doc_id")
    folder = scratch_folder(spark)
    blocks = write_blocks(docs, f"{folder}/blocks", 1)
    layout = Layout(20, 4)

    def own(text, offs):
        row = int(text.split()[1])
        return np.array([3, 7, 100 + row], np.uint64), np.zeros(3, dtype=bool), np.array([1, 10, 70_000])

    flags = shared_keys(blocks, own, layout, folder, 100)
    for r in flags.collect():
        shared, hot = read_flags([r["data"]], np.array([0, 3]))
        assert shared.tolist() == [True, True, False] and hot.tolist() == [False, True, True]


def test_texts_of_an_anchor_are_counted():
    data = (b"x" * 10 + bytes(range(65, 125)) + b"y" * 10) * 3 + b"zz" + bytes(range(65, 125))
    found = suffix_repeats.block_segments(data, np.array([0, len(data)]), suffix_repeats.LENGTH)
    _, _, index = suffix_repeats.anchors(found, Layout(60, 4))
    counts = suffix_repeats.n_texts(found, index)
    texts = [data[a : b - 1 + suffix_repeats.LENGTH] for a, b in zip(found.first.tolist(), found.past.tolist(), strict=True)]
    assert counts.tolist() == [len({t for t, i in zip(texts, index.tolist(), strict=True) if i == k}) for k in range(len(counts))]
    assert max(np.bincount(index)) > 1


def test_segments_of_a_block_are_those_of_its_parts(monkeypatch):
    rng = random.Random(3)
    texts = [bytes(rng.choices(b"abc", k=rng.choice([0, 20, 49, 50, 51, 300]))) for _ in range(60)]
    offs = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    want = suffix_repeats.block_segments(b"".join(texts), offs, 50)
    monkeypatch.setattr(suffix_repeats, "HASHED_BYTES", 200)
    got = suffix_repeats.block_segments(b"".join(texts), offs, 50)
    assert all((getattr(got, c) == getattr(want, c)).all() for c in ("first", "past", "key", "doc", "text")) and len(want.first)


def test_rows_between_blocks_and_ranges_stay_few():
    """10 GB of text: what each block sends each range is a row."""
    blocks = 10_000_000_000 // suffix_repeats.BLOCK_BYTES
    layout = Layout.of(blocks, suffix_repeats.BLOCK_BYTES, suffix_repeats.BLOCKS_PER_RANGE)
    assert blocks << layout.range_bits < 2_000_000
    assert suffix_repeats.BLOCK_BYTES * blocks >> layout.range_bits <= 1 << 24  # and a range's part is bounded


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_repeats.repeated_strings(docs).count() == 0
    assert removed(spark.createDataFrame([(1, None)], "doc_id long, text string")) == Counter([(1, 0, (), b"")])
    with pytest.raises(ValueError, match="over"):
        suffix_repeats.repeated_strings(docs, length=24)


# ------------------------------------------------------------------ ranked search


def plain_terms(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if ord(c) >= 0x80 or c in "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ":
            word += c.lower() if ord(c) < 0x80 else c
        elif word:
            out.append(word)
            word = ""
    return out


def plain_search(docs, items, k):
    held = [(d, Counter(plain_terms(t))) for d, t in docs]
    n, total = sum(bool(c) for _, c in held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = defaultdict(set)
    for i, t in items:
        if i is not None:
            asked[i].update(plain_terms(t))
    out = []
    for i, words in asked.items():
        scores = []
        for d, c in held:
            m = 50 + 50 * sum(c.values()) * n // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (1_000_000_000 * c[w] // (1000 * c[w] + 20 * m)) for w in words if c[w])
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(i, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return Counter(out)


def found(spark, docs, items, k, shard_bytes):
    index = block_max.build_index(docs, scratch_folder(spark), shard_bytes)
    return Counter(map(tuple, block_max.search(index, items, k).select("item_id", "rank", "doc_id", "score").collect()))


@pytest.mark.parametrize(("k", "shard_bytes"), [(5, 1), (5, 4000), (50, 1 << 20)])
def test_best_documents(spark, monkeypatch, k, shard_bytes):
    monkeypatch.setattr(block_max, "BLOCK", 4)
    monkeypatch.setattr(block_max, "MOST_QUERY_BYTES", 200)
    rng = random.Random(k)
    words = [f"w{j}" for j in range(60)] + ["Zwölf", "É", "été", "naïve-ish", "x_y", "a1B2"]
    pick = lambda n: " ".join(words[min(int(rng.expovariate(0.08)), len(words) - 1)] for _ in range(n))
    texts = [(j, pick(rng.randint(0, 40))) for j in range(120)] + [(3, "w1 w2"), (3, "w1 w2"), (None, "w1 w2 w40"), (500, None), (501, ""), (502, "... !"), (503, "w5 " * 5000), (504, "\x00w1\x00")]
    items = [(j, pick(rng.randint(1, 12))) for j in range(25)] + [(30, None), (31, ""), (32, "unknown words"), (None, "w1"), (33, "w1"), (33, "w2 W40"), (34, "w5 w5 w5")]
    docs = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "0 as score", "1 as key", "'a' as lexicon")
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "0 as rank")
    assert found(spark, docs.repartition(2), bench, k, shard_bytes) == plain_search(texts, items, k)
    assert found(spark, docs.limit(0), bench, k, shard_bytes) == found(spark, docs, bench.limit(0), k, shard_bytes) == Counter()


def test_blocks_are_rejected_unread(spark, monkeypatch):
    """Once the best are known, most blocks of common terms are never unpacked."""
    unpacked = []
    monkeypatch.setattr(block_max.Postings, "unpacked", lambda self, which, old=block_max.Postings.unpacked: unpacked.append(len(which)) or old(self, which))
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["the", "of", "and", f"r{rng.randrange(300)}"]) for _ in range(rng.randint(5, 300))).encode() for _ in range(4000)]
    row = block_max.index_shard(list(range(4000)), texts).to_pylist()[0]
    df = Counter(w for t in texts for w in set(t.split()))
    weights = {w: math.floor(1000 * math.log(8002 / (2 * c + 1))) for w, c in df.items()}
    corpus = block_max.Corpus(4000, sum(len(t.split()) for t in texts), {w: x for w, x in weights.items() if x > 0})
    shard, query = block_max.Shard(row, corpus), [b"the", b"of", b"r1", b"r2"]
    doc, score = block_max.search_shard(shard, query, 10, 0)
    least = int(np.sort(score)[-10])
    total = sum(-(-df[w] // block_max.BLOCK) for w in query if w in corpus.weights)
    unpacked.clear()
    again, score = block_max.search_shard(shard, query, 10, least)
    assert len(again) >= 10 and set(again) <= set(doc) and sum(unpacked) < 0.6 * total


# ------------------------------------------------------------------ conversation trie


def plain_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs[c].append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [x[3:] for x in sorted(t)] for c, t in convs.items()}
    quotient = lambda c: c - int(math.fmod(c, 100))
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = own.get(quotient(c), [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return Counter(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(p)).encode()).hexdigest())
        for p, m in members.items()
    )


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
ROWS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("limit", [None, 1, 3, 40])
def test_trie_of_odd_conversations(spark, limit, monkeypatch):
    monkeypatch.setattr(turn_trie, "CHUNK", 5)
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "bot", None]), rng.choice(["", "hé", None, "long text", "x"])) for c in [*range(0, 260, 3), -100, -7, 100, 7_000_000_000] for t in rng.sample([None, *range(9)], rng.randint(1, 9))]
    rows += [(500 + c, t, "u", "same") for c in range(40) for t in range(3)]  # many copies
    rows += [(700, t, "u", f"turn {t % 3}") for t in range(400)] + [(701, t, "u", f"turn {t % 3}") for t in range(400)]
    rows += [(None, 1, "u", "x"), (800, 1, "a", "b"), (800, 1, "b", "a"), (800, 1, "a", "b"), (900, 5, "", ""), (901, 5, None, None)]
    rng.shuffle(rows)
    talk = spark.createDataFrame(rows, ROWS).selectExpr("*", "0 as depth", "'n' as node", "1 as nth")
    trie = turn_trie.conversation_trie(talk.repartition(3), limit)
    assert Counter(map(tuple, trie.select(COLUMNS).collect())) == plain_trie(rows)


def test_trie_without_rows_and_with_one(spark):
    nothing = spark.createDataFrame([], ROWS)
    assert turn_trie.conversation_trie(nothing).count() == 0
    one = [(5, None, None, None)]
    assert Counter(map(tuple, turn_trie.conversation_trie(spark.createDataFrame(one, ROWS)).select(COLUMNS).collect())) == plain_trie(one)


def test_slots_are_minimal_and_verified():
    rng = np.random.default_rng(2)
    digests = rng.integers(0, 1 << 63, size=(5000, 2)).astype(np.uint64)
    table = turn_trie.PerfectTable(digests)
    assert sorted(table.slots(digests).tolist()) == list(range(5000))
    others = digests ^ np.array([1, 0], np.uint64)
    assert (table.slots(others) == -1).all()
    assert table.slots(digests[:0]).tolist() == [] and turn_trie.PerfectTable(digests[:0]).slots(others[:2]).tolist() == [-1, -1]
    with pytest.raises(ValueError, match="equal digests"):
        turn_trie.PerfectTable(np.concatenate([digests[:3], digests[:1]]))
