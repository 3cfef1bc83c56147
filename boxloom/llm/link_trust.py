"""URL filter: rules by host and path, and trust and distrust spread over the links between hosts.

Hosts are nodes; a link from a page of one host to a url of another is an edge.  Trust starts at hosts whose
pages the rules allow and follows links; distrust starts at hosts whose pages the rules block and runs against
the links, to those who point there.  Both are personalised PageRank, found by repeated joins and sums.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom.llm.common import ascii_lower, stored

# Verdict, host and path of each rule.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?is)\shref\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """Host of a url: what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty if there is none."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct (verdict, rule), or null.  A rule fits its host and all
    subdomains where the path starts with the rule's."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(h + p).alias("rule"))).otherwise(out)
    return out


def host_edges(pages: DataFrame, host: str = "host", html: str = "html") -> DataFrame:
    """Links between different hosts: (source, target, links)."""
    found = pages.select(F.col(host).alias("source"), F.explode(F.regexp_extract_all(html, F.lit(LINK), 1)).alias("url"))
    target = host_of(F.when(F.col("url").startswith("//"), F.concat(F.lit("x:"), "url")).otherwise(F.col("url")))
    return (found.select("source", target.alias("target")).where("source <> '' and target <> '' and source <> target")
            .groupBy("source", "target").agg(F.count("*").alias("links")))


def spread(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, tolerance: float = 1e-4, rounds: int = 60) -> DataFrame:
    """Personalised PageRank of both kinds: (host, kind, score).

    ``seeds``: host, kind (trust or distrust), weight.  Weights are not scaled to one, so a score does not shrink
    as the graph grows.  Trust leaves a host in proportion to its links; distrust enters the hosts that link to
    a host in proportion to their links.  Both directions stand in one edge table, so a round is one join and one
    sum.  What reaches a host without links ends there.
    """
    there = edges.select(F.lit("trust").alias("kind"), F.col("source").alias("host"), F.col("target").alias("to"), "links")
    back = edges.select(F.lit("distrust").alias("kind"), F.col("target").alias("host"), F.col("source").alias("to"), "links")
    flow = there.union(back)
    total = flow.groupBy("kind", "host").agg(F.sum("links").alias("total"))
    flow = stored(flow.join(total, ["kind", "host"]).select("kind", "host", "to", (F.col("links") / F.col("total")).alias("share")))
    base = stored(seeds.groupBy("kind", "host").agg((F.sum("weight") * (1 - damping)).alias("base")).where("base > 0"))
    score = base.select("kind", "host", F.col("base").alias("score"))
    for _ in range(rounds):
        moved = score.join(flow, ["kind", "host"]).select("kind", F.col("to").alias("host"), (F.col("score") * F.col("share") * damping).alias("x"))
        new = moved.union(base.select("kind", "host", F.col("base").alias("x"))).groupBy("kind", "host").agg(F.sum("x").alias("score"))
        new = stored(new)
        old = score.select("kind", "host", F.col("score").alias("old"))
        change = new.join(old, ["kind", "host"], "left").agg(F.max(F.abs(F.col("score") - F.coalesce("old", F.lit(0.0))))).first()[0]
        score = new
        if (change or 0.0) < tolerance:
            break
    return score


def judge(pages: DataFrame, rules=RULES, floor: float = 0.1, damping: float = 0.85, key: str = "page_id") -> DataFrame:
    """Verdict for every page: (page_id, host, path, rule, verdict, trust, distrust).

    Where a rule fits, it decides.  Any other page goes by its host: blocked when the host's distrust is at least
    ``floor`` and above its trust, else allowed.  A seed's weight is the share of the host's pages that rules
    allow or block.  A null url, or one without ``://``, has an empty host and path, no rule, and is allowed; null
    html has no links; repeated rows are judged alike; an empty table gives no rows.
    """
    p = pages.select(F.col(key), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    p = p.withColumn("fit", rule_for(F.col("host"), F.col("path"), rules))
    edges = host_edges(p)
    shares = p.where("host <> ''").groupBy("host").agg(
        (F.count(F.when(F.col("fit.verdict") == "allow", 1)) / F.count("*")).alias("trust"),
        (F.count(F.when(F.col("fit.verdict") == "block", 1)) / F.count("*")).alias("distrust"))
    seeds = shares.select("host", F.explode(F.create_map(F.lit("trust"), "trust", F.lit("distrust"), "distrust")).alias("kind", "weight"))
    score = spread(edges, seeds, damping)
    by_host = score.groupBy("host").agg(*[F.coalesce(F.max(F.when(F.col("kind") == k, F.col("score"))), F.lit(0.0)).alias(k) for k in ("trust", "distrust")])
    small = p.select(key, "host", "path", "fit")
    out = small.join(by_host, "host", "left").fillna(0.0, ["trust", "distrust"])
    bad = (F.col("distrust") >= floor) & (F.col("distrust") > F.col("trust"))
    return out.select(key, "host", "path", F.col("fit.rule").alias("rule"),
                      F.coalesce(F.col("fit.verdict"), F.when(bad, "block").otherwise("allow")).alias("verdict"), "trust", "distrust")
