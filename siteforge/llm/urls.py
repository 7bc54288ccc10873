"""URL filter: suffix rules first, then personalised PageRank over the host link graph (DataFrame and SQL functions only).

Rules (host/path, block or allow) fit a host and its subdomains if the url's path starts with the rule's path; the longest
wins. For urls that no rule fits the method decides: trust flows along links from hosts with allowed pages, distrust flows
against links from hosts with blocked pages (who links to bad hosts is bad), both as personalised PageRank with damping. A host
is blocked if the distrust that reaches it over links is at least THRESHOLD of the mean seed's and exceeds its trust. What a seed
has of itself does not count: a blocked section says nothing of the host's other pages.

Nulls: a null url, or one without ://, has host '' and path '' and is allowed (no rule, no rank). Null html has no links. Links
without a host stay on their page's host and carry nothing. Repeated pages count again as seeds and links. Without seeds or
links nothing is blocked beyond the rules. Ties: rules of one length go to the first listed; distrust must exceed trust. An empty table
gives an empty result, very long urls and pages are read as a whole, and other columns are not read.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteforge.llm.common import ascii_lower, cut, read

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]
DAMPING, THRESHOLD = 0.85, 0.05
#: What is left unsettled of the ranks' mass; a round leaves DAMPING of what the one before left, which gives the rounds.
TOLERANCE = 1e-3
ROUNDS = math.ceil(math.log(TOLERANCE) / math.log(DAMPING))
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def fitting_rule(h: Column, p: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, nulls if none; ties go to the first listed."""
    ordered = sorted(rules, key=lambda r: -len(r[0]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, what in reversed(ordered):
        domain, _, rest = text.partition("/")
        fits = ((h == domain) | h.endswith("." + domain)) & p.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n) links between different hosts, combined before the exchange."""
    links = pages.select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(r"(?i)(?:href|src)\s*=\s*[\"']?((?:[a-z][a-z0-9+.-]*:)?//[^\s\"'>]+)"), F.lit(1))).alias("link"))
    dst = ascii_lower(F.regexp_extract("link", r"//([^/?#]*)", 1))
    return links.select("src", dst.alias("dst")).where("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """(kind, host, rank): personalised PageRank of each kind's seeds (kind, host, seed) over its edges (kind, src, dst, share).

    Rank that reaches a host without links ends there.
    """
    rank = seeds.select("kind", "host", F.col("seed").alias("rank"))
    if edges.isEmpty():
        return rank.withColumn("rank", F.col("rank") * (1 - damping))
    for n in range(rounds):
        sent = rank.join(edges.withColumnRenamed("src", "host"), ["kind", "host"]).select("kind", F.col("dst").alias("host"), (damping * F.col("rank") * F.col("share")).alias("m"))
        base = seeds.select("kind", "host", ((1 - damping) * F.col("seed")).alias("m"))
        rank = sent.unionByName(base).groupBy("kind", "host").agg(F.sum("m").alias("rank"))
        if n % 5 == 4:
            rank = cut(rank)
    return cut(rank)


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """pages (page_id, url, html) with host, path, rule, verdict, trust, distrust."""
    p = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), "html")
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    p = p.withColumns({"rule": rule, "by_rule": verdict})
    edges = cut(host_edges(p))
    seeds = p.where("by_rule is not null and host <> ''").groupBy(F.col("by_rule").alias("kind"), "host").agg(F.count(F.lit(1)).alias("n"))
    totals = seeds.groupBy("kind").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("hosts"))  # two rows
    seeds = cut(seeds.join(F.broadcast(totals), "kind").select("kind", "host", (F.col("n") / F.col("total")).alias("seed"), (1 / F.col("hosts")).alias("mean")))
    both = edges.select(F.lit("allow").alias("kind"), "src", "dst", "n").unionByName(edges.select(F.lit("block").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n"))
    out = both.groupBy("kind", "src").agg(F.sum("n").alias("out"))
    shares = cut(both.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("n") / F.col("out")).alias("share")))
    rank = propagate(shares, seeds)
    mean = seeds.where("kind = 'block'").agg(F.max("mean").alias("m"))  # one number
    own = seeds.where("kind = 'block'").select("kind", "host", (-(1 - DAMPING) * F.col("seed")).alias("rank"))
    hosts = rank.unionByName(own).groupBy("host").agg(
        F.sum(F.when(F.col("kind") == "allow", F.col("rank")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("kind") == "block", F.col("rank")).otherwise(0.0)).alias("distrust"),
    )
    limit = mean.first().m
    bad = F.lit(False) if limit is None else (F.col("distrust") >= THRESHOLD * (1 - DAMPING) * limit) & (F.col("distrust") > F.col("trust"))
    j = p.drop("html").join(hosts, "host", "left")
    verdict = F.coalesce("by_rule", F.when(bad, F.lit("block")).otherwise(F.lit("allow")))
    return j.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.round(F.coalesce("trust", F.lit(0.0)), 12).alias("trust"), F.round(F.coalesce("distrust", F.lit(0.0)), 12).alias("distrust"))


def op10_url_filter(spark, sf_dir):
    return judge(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
