"""URL verdicts from rules and from trust and distrust spread over host links.

A rule decides the pages that it fits. The others take the verdict of their
host: personalised PageRank carries trust from hosts that rules mostly allow
along links, and distrust from hosts that rules mostly block against them; a host
with more distrust than trust is blocked. Rounds go on until ``ROUNDS`` of them
change the ranks by less than ``TOLERANCE`` in all.

Links are the absolute links in the pages, one edge per pair of hosts, and
subdomains are joined with the domains above them. A host that is linked and has no
pages takes part as well; rules judge it by the urls that link to it. Ranks, edges
and sums are DataFrames; a host that many link to is summed before the shuffle.

Edge cases: a null url, or one without ``://``, has an empty host and path, fits
no rule and is allowed; null html has no links; repeated rows get equal verdicts;
equal trust and distrust allow; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.storage import written

#: The rules as (verdict, host, path); the longest that fits decides.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
DAMPING = 0.85
#: Rounds between looks at the change of all ranks, which add up to 1 at most, and the change that ends them.
ROUNDS, TOLERANCE = 10, 1e-3
#: The share of a host's pages that rules must decide alike to make it a seed.
SEED_SHARE = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"(?i)\bhref\s*=\s*[\"']?\s*((?:https?:)?//[^\s\"'<>]+)"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rule_number(host: Column, path: Column) -> Column:
    """The number of the longest rule that fits, else null."""
    chosen = F.lit(None).cast("int")
    longest_last = sorted(range(len(RULES)), key=lambda i: len(RULES[i][1] + RULES[i][2]))
    for i in longest_last:
        _, own, start = RULES[i]
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        chosen = F.when(fits, F.lit(i)).otherwise(chosen)
    return chosen


def page_ranks(seeds: DataFrame, edges: DataFrame) -> DataFrame:
    """Personalised PageRank of ``seeds`` (kind, host) along ``edges`` (kind, src, dst): ``kind``, ``host``, ``rank``.

    Kinds are ranked side by side, each from seeds of equal shares.
    """
    share = seeds.groupBy("kind").agg((F.lit(1.0) / F.count("*")).alias("share"))
    base = written(seeds.join(F.broadcast(share), "kind"))  # a row per kind is broadcast
    degrees = edges.groupBy("kind", "src").agg(F.count("*").alias("degree"))
    weighted = written(edges.join(degrees, ["kind", "src"]).withColumnRenamed("src", "host"))
    ranks = written(base.withColumnRenamed("share", "rank"))
    change = 1.0
    while change >= TOLERANCE:
        before = ranks
        for _ in range(ROUNDS):
            passed = weighted.join(ranks, ["kind", "host"]).select(
                "kind", F.col("dst").alias("host"), (DAMPING * F.col("rank") / F.col("degree")).alias("rank")
            )
            given = base.select("kind", "host", ((1 - DAMPING) * F.col("share")).alias("rank"))
            ranks = passed.union(given).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        ranks = written(ranks)
        moved = ranks.union(before.select("kind", "host", -F.col("rank"))).groupBy("kind", "host")
        off = moved.agg(F.abs(F.sum("rank")).alias("off")).groupBy("kind").agg(F.sum("off").alias("off"))
        change = off.agg(F.max("off")).first()[0] or 0.0
    return ranks


def linked_urls(pages: DataFrame) -> DataFrame:
    """Absolute links of the pages by hosts and verdict: ``src``, ``dst``, ``verdict`` (null without a rule), ``n``."""
    link = F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(_LINK), F.lit(1)))
    target = F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), F.col("link"))).otherwise(F.col("link"))
    found = pages.select(F.col("host").alias("src"), link.alias("link")).select("src", target.alias("url"))
    judged = found.select("src", host_of(F.col("url")).alias("dst"), path_of(F.col("url")).alias("path"))
    verdicts = F.array(*[F.lit(verdict) for verdict, _, _ in RULES])
    verdict = F.get(verdicts, rule_number(F.col("dst"), F.col("path")))
    return judged.where("dst != ''").groupBy("src", "dst", verdict.alias("verdict")).agg(F.count("*").alias("n"))


def host_edges(links: DataFrame, hosts: DataFrame) -> DataFrame:
    """Distinct (src, dst) pairs of different hosts: links, and domains with their subdomains both ways."""
    labels = F.split("host", r"\.")
    above = F.explode(
        F.transform(
            F.when(F.size(labels) > 1, F.sequence(F.lit(2), F.size(labels))).otherwise(F.array().cast("array<int>")),
            lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
        )
    )
    over = hosts.select("host", above.alias("other")).join(
        hosts.select(F.col("host").alias("other")), "other", "left_semi"
    )
    family = over.select(F.col("host").alias("src"), F.col("other").alias("dst")).union(
        over.select(F.col("other").alias("src"), F.col("host").alias("dst"))
    )
    linked = links.where("src != dst and src != ''").select("src", "dst")
    return linked.union(family).distinct()


def url_verdicts(pages: DataFrame) -> DataFrame:
    """Per row ``page_id``, ``host``, ``path``, ``rule`` and ``verdict``, and the host's ``trust`` and ``distrust``."""
    url = F.col("url").cast("string")
    judged = pages.select(
        "page_id", host_of(url).alias("host"), path_of(url).alias("path"), F.col("html").cast("string").alias("html")
    ).withColumn("_rule", rule_number(F.col("host"), F.col("path")))
    names = F.array(*[F.lit(host + path) for _, host, path in RULES])
    verdicts = F.array(*[F.lit(verdict) for verdict, _, _ in RULES])
    at = (F.col("_rule") + 1).cast("int")
    judged = judged.withColumn("rule", F.when(at.isNotNull(), F.element_at(names, at))).withColumn(
        "_verdict", F.when(at.isNotNull(), F.element_at(verdicts, at))
    )
    counts = (
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("verdict") == "allow", F.col("n")).otherwise(0)).alias("allowed"),
        F.sum(F.when(F.col("verdict") == "block", F.col("n")).otherwise(0)).alias("blocked"),
    )
    links = written(linked_urls(judged))
    paged = judged.where("host != ''").groupBy("host", F.col("_verdict").alias("verdict")).agg(F.count("*").alias("n"))
    own = paged.groupBy("host").agg(*counts)
    others = links.select(F.col("dst").alias("host"), "verdict", "n").join(own.select("host"), "host", "left_anti")
    hosts = written(own.union(others.groupBy("host").agg(*counts)))
    edges = host_edges(links, hosts)
    both = [
        edges.select(F.lit("trust").alias("kind"), "src", "dst"),
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst")),
    ]
    seeds = [
        hosts.where(F.col(of) >= SEED_SHARE * F.col("n")).select(F.lit(kind).alias("kind"), "host")
        for kind, of in (("trust", "allowed"), ("distrust", "blocked"))
    ]
    ranks = page_ranks(seeds[0].union(seeds[1]), both[0].union(both[1]))
    rank = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0.0)).alias(kind)
    scores = written(ranks.groupBy("host").agg(rank("trust"), rank("distrust")))
    own = F.when(F.coalesce("distrust", F.lit(0.0)) > F.coalesce("trust", F.lit(0.0)), "block").otherwise("allow")
    return judged.join(scores, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("_verdict", own).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
