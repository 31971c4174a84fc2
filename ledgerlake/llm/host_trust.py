"""URL filter: explicit rules first, then trust and distrust spread over the graph of hosts.

Host edges come from the pages: links in their HTML that name another host, and each host's step to its parent domain
and back. Trust starts at hosts that an allow rule names and follows the edges (personalised PageRank); distrust starts
at hosts that a block rule names and follows them backwards, to the hosts that point there. A host is blocked if its
distrust, as a share of both, passes a threshold. All of it is DataFrame work: regular expressions, joins, sums.

Each iteration sums what arrives at a host by `groupBy` (combined before the shuffle, so a host that everything links to
is no hot key) and is cut off with `checkpoint()` every few steps. Edges and hosts are distinct rows, which repeated
pages don't multiply.

Defined results: a null url, or one without `://`, has the empty host and path, fits no rule, and is allowed, as is every
host that neither kind of seed reaches. Repeated pages get a row each. Only page_id, url and html are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (verdict, host, path) of the explicit rules
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
STEPS, DAMPING, THRESHOLD, CUT_EVERY = 12, 0.85, 0.5, 3
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    """What follows the first `://`; null without one."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    rest = _after_scheme(url)
    return F.coalesce(F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, null if none does; of two as long, the one listed first."""
    ranked = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    fits = [
        F.when(
            ((host == r_host) | host.endswith("." + r_host)) & path.startswith(r_path),
            F.struct(F.lit(r_host + r_path).alias("rule"), F.lit(verdict).alias("verdict")),
        )
        for verdict, r_host, r_path in ranked
    ]
    return F.coalesce(*fits)


def host_edges(pages: DataFrame) -> DataFrame:
    """Distinct (src, dst) of hosts: links between different hosts, and steps to the parent domain and back."""
    host = host_of(F.col("url")).alias("src")
    links = (
        pages.where(F.col("html").contains("://"))
        .select(host, F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(r"""(?i)href\s*=\s*["']?([a-z][a-z0-9+.-]*://[^"'\s>]*)"""), F.lit(1)))).alias("to"))
        .select("src", host_of(F.col("to")).alias("dst"))
        .distinct()
    )
    up = pages.select(host).distinct().select("src", F.regexp_extract("src", r"^[^.]*\.(.*\..*)$", 1).alias("dst"))
    both = up.unionByName(up.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return links.unionByName(both).where("src <> dst and src <> '' and dst <> ''").distinct()


def spread(edges: DataFrame, seeds: DataFrame, steps: int = STEPS, damping: float = DAMPING) -> DataFrame:
    """(kind, host, rank): personalised PageRank of several graphs at once. `edges` (kind, src, dst) are distinct; the
    `seeds` (kind, host) of a kind share its jump equally. What reaches a host without outgoing edges ends there."""
    degree = edges.groupBy("kind", "src").agg(F.count(F.lit(1)).alias("degree"))
    number = seeds.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    parts = edges.join(degree, ["kind", "src"]).select("kind", "src", "dst", (damping / F.col("degree")).alias("part")).checkpoint()
    start = seeds.join(number, "kind").select("kind", "host", (1 / F.col("n")).alias("rank")).checkpoint()
    jump, ranks = start.select("kind", "host", ((1 - damping) * F.col("rank")).alias("rank")), start
    for step in range(1, steps + 1):
        sent = parts.join(ranks.withColumnRenamed("host", "src"), ["kind", "src"])
        sent = sent.select("kind", F.col("dst").alias("host"), (F.col("part") * F.col("rank")).alias("rank"))
        ranks = sent.unionByName(jump).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if step % CUT_EVERY == 0 or step == steps:
            ranks = ranks.checkpoint()
    return ranks


def host_verdicts(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """(host, trust, distrust, blocked) of every host that trust or distrust reaches."""
    ruled = pages.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    ruled = ruled.select("host", fitting_rule(F.col("host"), F.col("path"), rules)["verdict"].alias("verdict"))
    # a host is a seed of the kind that most of its ruled pages have; ties are no seed
    tally = (
        ruled.where("host <> '' and verdict is not null")
        .groupBy("host")
        .agg(F.sum(F.when(F.col("verdict") == "allow", 1).otherwise(-1)).alias("balance"))
    )
    seeds = tally.where("balance <> 0").select(F.when(F.col("balance") > 0, "trust").otherwise("distrust").alias("kind"), "host")
    edges = host_edges(pages).checkpoint()
    back = edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"))
    ranks = spread(edges.select(F.lit("trust").alias("kind"), "src", "dst").unionByName(back), seeds)

    def of(kind: str):
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0.0)).alias(kind)

    both = ranks.groupBy("host").agg(of("trust"), of("distrust"))
    share = F.try_divide("distrust", F.col("trust") + F.col("distrust"))
    return both.withColumn("blocked", F.coalesce(share > threshold, F.lit(False)))


def filter_urls(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust of every page. Rules hold before the host's verdict."""
    hosts = host_verdicts(pages, rules, threshold)
    judged = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = judged.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules)).join(hosts, "host", "left")
    spread_verdict = F.when(F.col("blocked"), "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", spread_verdict).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )

