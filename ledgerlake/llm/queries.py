"""Registered queries of the training-data operators: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import (
    additive_model,
    backoff_lm,
    bin_packing,
    block_max,
    boosted_rules,
    host_trust,
    line_templates,
    near_dup,
    passage_chains,
    semantic_leaks,
    suffix_repeats,
    toxic_spans,
    turn_trie,
)
from ledgerlake.llm.blocks import scratch_folder
from ledgerlake.llm.text import held_out


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> None:
    """Checkpoints go to the folder the session names; where none is set, as in tests, to one below the warehouse."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", f"{warehouse}/_checkpoints"))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    forest = boosted_rules.fit_quality_rules(docs, _table(spark, sf_dir, "labels"))
    return boosted_rules.apply_quality_rules(docs, forest).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared_folder(spark)
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"))


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document, before and after recurring ones were dropped."""
    shared_folder(spark)
    lines = F.size(F.split("text", "\n"))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", lines.alias("n_lines"), F.length("text").alias("n_chars"))
    kept = line_templates.drop_recurring_lines(docs)
    return kept.select("doc_id", "n_lines", (F.col("n_lines") - lines).alias("n_dropped"), (F.col("n_chars") - F.length("text")).alias("chars_dropped"))


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return semantic_leaks.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared_folder(spark)
    return backoff_lm.score_texts(_table(spark, sf_dir, "documents"))


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bin_packing.pack(bin_packing.count_tokens(_table(spark, sf_dir, "documents")))


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared_folder(spark)
    return passage_chains.repeated_runs(_table(spark, sf_dir, "documents"))


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared_folder(spark)
    return host_trust.filter_urls(_table(spark, sf_dir, "pages"))


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    field = toxic_spans.fit_toxic_spans(docs, _table(spark, sf_dir, "labels"))
    tagged = toxic_spans.tag_toxic(docs, field)
    return tagged.select(
        "doc_id", held_out(F.col("doc_id"), 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("spans").alias("n_spans")
    )


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = additive_model.fit_quality_model(docs, _table(spark, sf_dir, "labels"))
    scored = additive_model.score_quality(docs, model)
    return scored.select("doc_id", held_out(F.col("doc_id"), 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared_folder(spark)
    found = suffix_repeats.repeated_strings(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared_folder(spark)
    index = block_max.build_index(_table(spark, sf_dir, "documents"), scratch_folder(spark))
    return block_max.search(index, _table(spark, sf_dir, "benchmark"), 50)


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared_folder(spark)
    trie = turn_trie.conversation_trie(_table(spark, sf_dir, "conversations"))
    return trie.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": quality_rules,
    "op2_near_dedup": near_dedup,
    "op3_line_dedup": line_dedup,
    "op4_decontamination": decontamination,
    "op5_lm_scores": lm_scores,
    "op6_packing": packing,
    "op7_substring_dedup": substring_dedup,
    "op8_url_filter": url_filter,
    "op9_toxicity": toxicity,
    "op10_quality_classifier": quality_classifier,
    "op11_suffix_dedup": suffix_dedup,
    "op12_lexical_search": lexical_search,
    "op13_conversation_trie": conversation_trie,
}
#: Near duplicates by comparing all documents that share a shingle.
NEAR_DEDUP_SQL = """
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws
    FROM documents
),
sets AS (
    SELECT doc_id, CASE
        WHEN len(ws) >= 5 THEN list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')))
        WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS shingles
    FROM words
),
sizes AS (SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n FROM sets),
rows AS (SELECT doc_id, unnest(shingles) AS shingle FROM sets),
shared AS (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM rows a JOIN rows b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
    GROUP BY a.doc_id, b.doc_id
),
links AS (
    SELECT s.u, s.v FROM shared s JOIN sizes x ON s.u = x.doc_id JOIN sizes y ON s.v = y.doc_id
    WHERE 100 * s.c >= 85 * (x.n + y.n - s.c)
),
sides AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach AS (
    SELECT doc_id, doc_id AS other FROM sizes
    UNION
    SELECT r.doc_id, s.v AS other FROM reach r JOIN sides s ON r.other = s.u
),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT z.doc_id, z.n AS n_shingles, l.component_id, z.doc_id = l.component_id AS kept
FROM sizes z JOIN least l ON z.doc_id = l.doc_id
"""
#: All windows of 50 bytes, in hexadecimal digits.
SUFFIX_DEDUP_SQL = """
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
cuts AS (
    SELECT r, doc_id, 500 * c AS base, substr(h, 1000 * c + 1, 1098) AS part
    FROM (SELECT r, doc_id, h, unnest(range(0, len(h) // 1000 + 1)) AS c FROM texts)
),
windows AS (
    SELECT r, doc_id, base + i AS i, substr(part, 2 * i + 1, 100) AS s
    FROM (SELECT r, doc_id, base, part, unnest(range(0, len(part) // 2 - 49)) AS i FROM cuts WHERE len(part) >= 100)
),
firsts AS (SELECT s, min(doc_id) AS least FROM windows GROUP BY s),
covered AS (SELECT r, i FROM windows JOIN firsts USING (s) WHERE least < doc_id),
marked AS (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 50 THEN 0 ELSE 1 END AS opens FROM covered),
numbered AS (SELECT r, i, sum(opens) OVER (PARTITION BY r ORDER BY i ROWS UNBOUNDED PRECEDING) AS span FROM marked),
spans AS (SELECT r, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY r, span),
pieces AS (
    SELECT r, a, b, substr(h, 2 * before + 1, 2 * (a - before)) AS piece
    FROM (SELECT s.r, s.a, s.b, t.h, coalesce(lag(s.b) OVER (PARTITION BY s.r ORDER BY s.a), 0) AS before FROM spans s JOIN texts t ON s.r = t.r)
),
removed AS (SELECT r, sum(b - a) AS n, count(*) AS n_spans, max(b) AS past, string_agg(piece, '' ORDER BY a) AS head FROM pieces GROUP BY r)
SELECT t.doc_id, CAST(len(t.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(x.n, 0) AS BIGINT) AS n_removed, CAST(coalesce(x.n_spans, 0) AS BIGINT) AS n_spans,
    sha256(unhex(coalesce(x.head, '') || substr(t.h, 2 * coalesce(x.past, 0) + 1))) AS kept_sha256
FROM texts t LEFT JOIN removed x ON t.r = x.r
"""
#: Scores of all documents that share a term with an item.
LEXICAL_SEARCH_SQL = """
WITH terms AS (
    SELECT r, doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)
),
lengths AS (SELECT r, count(*) AS n FROM terms GROUP BY r),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM lengths),
postings AS (SELECT r, doc_id, term, count(*) AS tf FROM terms GROUP BY r, doc_id, term),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM postings, corpus GROUP BY term, docs
),
asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM benchmark WHERE item_id IS NOT NULL
),
scores AS (
    SELECT a.item_id, p.r, p.doc_id,
        CAST(sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 20 * (50 + (50 * l.n * c.docs) // c.words)))) AS BIGINT) AS score
    FROM asked a JOIN weights w ON a.term = w.term JOIN postings p ON a.term = p.term JOIN lengths l ON p.r = l.r, corpus c
    GROUP BY a.item_id, p.r, p.doc_id
),
ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank, doc_id, score FROM scores WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""
#: Prefixes as lists of turn digests; crc32 bit by bit.
CONVERSATION_TRIE_SQL = """
WITH turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, k) AS nth, k, size
    FROM (
        SELECT conv_id, turn, length(coalesce(text, '')) AS size, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k
        FROM conversations WHERE conv_id IS NOT NULL
    )
),
convs AS (
    SELECT conv_id, conv_id - conv_id % 100 AS family, xor(crc, 4294967295) % 6 AS h
    FROM (
        SELECT conv_id, list_reduce(
            list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
            lambda c, x: list_reduce(
                list_prepend(xor(c, x), list_transform(range(8), lambda i: CAST(i AS BIGINT))),
                lambda y, i: CASE WHEN y % 2 = 1 THEN xor(y // 2, CAST(3988292384 AS BIGINT)) ELSE y // 2 END)) AS crc
        FROM (SELECT DISTINCT conv_id FROM turns)
    )
),
rebuilt AS (
    SELECT c.conv_id, 0 AS part, t.nth, t.k, t.size FROM convs c JOIN turns t ON t.conv_id = c.family AND t.nth <= c.h
    UNION ALL
    SELECT c.conv_id, 1 AS part, t.nth, t.k, t.size FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.nth > c.h
),
paths AS (
    SELECT conv_id, row_number() OVER w AS depth, list(k) OVER w AS path, size
    FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, nth ROWS UNBOUNDED PRECEDING)
    UNION ALL
    SELECT conv_id, 0, CAST([] AS VARCHAR[]), 0 FROM convs
),
nodes AS (SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) AS size FROM paths GROUP BY path, depth),
kin AS (
    SELECT n.*, p.conv_id AS parent_conv_id, coalesce(c.n, 0) AS n_children
    FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = list_slice(n.path, 1, n.depth - 1)
    LEFT JOIN (SELECT list_slice(path, 1, depth - 1) AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1) c ON c.path = n.path
),
sums AS (
    SELECT up AS path, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
    FROM (SELECT n_children, (n_convs - 1) * size AS saved, unnest(list_transform(range(0, depth + 1), lambda d: list_slice(path, 1, d))) AS up FROM kin)
    GROUP BY up
),
longest AS (SELECT conv_id, max(depth) AS depth FROM paths GROUP BY conv_id),
ends AS (
    SELECT p.path, string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) AS ids
    FROM paths p JOIN longest l ON p.conv_id = l.conv_id AND p.depth = l.depth GROUP BY p.path
)
SELECT k.conv_id, CAST(k.depth AS BIGINT) AS depth, k.parent_conv_id, CAST(k.n_convs AS BIGINT) AS n_convs, CAST(k.n_children AS BIGINT) AS n_children,
    CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM kin k JOIN sums s ON k.path = s.path LEFT JOIN ends e ON k.path = e.path
"""
SQL: dict[str, str] = {
    "op2_near_dedup": NEAR_DEDUP_SQL,
    "op11_suffix_dedup": SUFFIX_DEDUP_SQL,
    "op12_lexical_search": LEXICAL_SEARCH_SQL,
    "op13_conversation_trie": CONVERSATION_TRIE_SQL,
}
