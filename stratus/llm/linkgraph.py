"""URL filter: rules by host and path, and link-graph propagation of trust and distrust for the rest.

The most specific rule (longest host + path) whose host is the url's host or a parent domain of it and
whose path starts the url's path decides. All other urls get the verdict of their host. A host is a trusted
seed as strong as the share of its pages that a rule allows, and a blocked seed as strong as the share
that a rule blocks. Personalised PageRank spreads trust from the trusted seeds along the links between
hosts; on the reversed links it spreads distrust from the blocked seeds, to the hosts that link to them.
Strengths are not divided by the number of seeds, so a score does not shrink as the corpus grows; a host
without outgoing edges hands nothing on. A host is blocked where its distrust is more than its trust and
at least ``least``, a third of what a wholly blocked host without neighbours has.

Links are the absolute and scheme-relative ``href`` targets of a page, once per page and host; a page on
the same host is no edge. Edges are counted in Spark and their number per host pair is their weight; each
round is one join on the source host and one sum by target, cut by a written table. A host with very
many links is a skewed join side, which AQE splits; the sums are partial before the shuffle.

Defined cases: a null url or one without ``://`` has empty host and path, no rule fits, verdict allow. Null
html has no links. Very long texts are searched whole. Repeated rows are judged each; repeated rules count once; of equally long rules block
wins. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.llm.tables import written

DAMPING, SETTLED, LEAST = 0.85, 1e-6, 0.05
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HREF = r"""(?i)<[a-z][^<>]*?\shref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)://([^/?#]*)", 1)
    return F.translate(rest, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^(?>.*?://)[^/?#]*(/[^?#]*)", 1)


def _fits(host: Column, path: Column, rule_host: str, rule_path: str) -> Column:
    return ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)


def with_rule(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (host + path of the longest rule that fits, else null) and
    ``ruled`` (its verdict). ``rules``: (verdict, host, path)."""
    pages = pages.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    ordered = sorted({(v, h.lower(), p) for v, h, p in rules}, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r[1] + r[2]))
    rule = verdict = F.lit(None).cast("string")
    for v, h, p in reversed(ordered):
        fits = _fits(F.col("host"), F.col("path"), h, p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return pages.withColumn("rule", rule).withColumn("ruled", verdict)


def host_edges(pages: DataFrame) -> DataFrame:
    """``src, dst, n``: on how many pages of host ``src`` a link to host ``dst`` stands."""
    found = F.array_distinct(F.transform(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(HREF), F.lit(1)),
                                         lambda h: F.translate(h, UPPER, LOWER)))
    return pages.where("host <> ''").select(F.col("host").alias("src"), F.explode(found).alias("dst")) \
        .where("src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, settled: float = SETTLED) -> DataFrame:
    """Personalised PageRank for each ``kind``: ``edges(kind, src, dst, n)``, ``seeds(kind, host, strength)`` ->
    ``kind, host, score``. Goes on until the scores move by no more than ``settled`` per seed in all. A round moves them by
    at most ``damping`` of what the round before did, so that takes log(settled) / log(damping) rounds at most; more would mean
    a fault, and raise."""
    total = edges.groupBy("kind", "src").agg(F.sum("n").alias("total"))
    edges = written(edges.join(total, ["kind", "src"]).select(
        "kind", F.col("src").alias("host"), "dst", (F.col("n") / F.col("total")).alias("share")), "host_edges")
    base = seeds.select("kind", "host", (F.lit(1.0 - damping) * F.col("strength")).alias("part"))
    n_seeds = max(1, seeds.count())
    scores = written(base.withColumnRenamed("part", "score"), "host_scores")
    if edges.isEmpty():
        return scores
    for _ in range(math.ceil(math.log(settled) / math.log(damping)) + 2):
        moved = scores.join(edges, ["kind", "host"]).select(
            "kind", F.col("dst").alias("host"), (damping * F.col("score") * F.col("share")).alias("part"))
        new = written(moved.union(base).groupBy("kind", "host").agg(F.sum("part").alias("score")), "host_scores")
        change = new.join(scores.withColumnRenamed("score", "old"), ["kind", "host"], "full") \
            .agg(F.sum(F.abs(F.coalesce("score", F.lit(0.0)) - F.coalesce("old", F.lit(0.0))))).first()[0] or 0.0
        scores = new
        if change <= settled * n_seeds:
            return scores
    raise RuntimeError(f"scores of the link graph did not settle: they still move by {change}")


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], least: float = LEAST) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` for every row of ``pages(page_id, url, html)``."""
    ruled = with_rule(pages.select("page_id", "url", "html"), rules)
    narrow = ruled.select("page_id", "host", "path", "rule", "ruled")
    shares = ruled.where("host <> ''").groupBy("host").agg(
        F.avg(F.coalesce(F.col("ruled") == "allow", F.lit(False)).cast("int")).alias("trust"),
        F.avg(F.coalesce(F.col("ruled") == "block", F.lit(False)).cast("int")).alias("distrust"))
    seeds = written(shares.selectExpr("host", "stack(2, 'trust', trust, 'distrust', distrust) AS (kind, strength)")
                    .where("strength > 0").select("kind", "host", "strength"), "seeds")
    links = written(host_edges(ruled), "links")
    edges = links.select(F.lit("trust").alias("kind"), "src", "dst", "n").union(
        links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n"))
    scores = propagate(edges, seeds)
    by_host = scores.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == "trust", F.col("score"))).alias("trust"),
        F.sum(F.when(F.col("kind") == "distrust", F.col("score"))).alias("distrust"))
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    blocked = (distrust >= least) & (distrust > trust)
    return narrow.join(by_host, "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(blocked, "block").otherwise("allow")).alias("verdict"),
        trust.alias("trust"), distrust.alias("distrust"))
