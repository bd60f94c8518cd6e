"""URL filter: rules for the pages they fit, trust spread over the link graph for the rest.

Hosts are nodes; a link on a page is an edge from the page's host to the link's. Hosts that
the rules mostly allow are trusted seeds, hosts that they mostly block are blocked seeds.
Personalised PageRank spreads trust from the trusted seeds along the edges, and distrust from
the blocked seeds against them: whoever links to a blocked host is suspect. Both vectors are
kept as Spark tables and updated by one join and aggregate a round. A host is blocked if its
distrust exceeds its trust and reaches ``threshold`` times the mean host's share.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from terrace.llm.common import materialize

# The rules as (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/"))
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
# Targets of absolute and scheme-relative links: what follows // up to the end of the host.
LINK = r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'\s<>]+)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path of a url; both empty for NULL or a url without ://."""
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER), F.regexp_extract(url, PARTS, 2)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else NULLs. A rule fits its host and all
    subdomains where the path starts with the rule's."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule, verdict = F.when(fits, rule_host + rule_path).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """Distinct (src, dst) host pairs that a page's links make; links within a host and
    relative ones make none."""
    links = pages.select(F.col("host").alias("src"), F.explode(F.array_distinct(F.transform(
        F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), 1),
        lambda h: F.translate(h, UPPER, LOWER)))).alias("dst"))
    return links.where((F.col("src") != F.col("dst")) & (F.col("src") != "")).distinct()


def propagate(hosts: DataFrame, edges: DataFrame, tolerance: float, damping: float = 0.85,
              most_rounds: int = 1000) -> DataFrame:
    """(host, trust, distrust) from ``hosts`` (host, good, bad: seed weights that sum to 1 or are
    all 0) and ``edges``. What a host without outgoing links holds goes back to the seeds.
    Rounds go on until the vectors are nearer than ``tolerance``, in all, to where they converge: a
    round leaves at most ``damping`` of the distance, so that is known from how far it moved them.
    Not converging in ``most_rounds`` is an error."""
    out = edges.groupBy(F.col("src").alias("host")).agg(F.count(F.lit(1)).alias("n_out"))
    into = edges.groupBy(F.col("dst").alias("host")).agg(F.count(F.lit(1)).alias("n_in"))
    nodes = materialize(hosts.join(out, "host", "left").join(into, "host", "left"), "nodes")
    rank = nodes.select("host", "good", "bad", "n_out", "n_in", F.col("good").alias("trust"), F.col("bad").alias("distrust"))
    held_t, held_d = rank.agg(F.sum(F.when(F.col("n_out").isNull(), F.col("trust"))),
                              F.sum(F.when(F.col("n_in").isNull(), F.col("distrust")))).first()
    for k in range(most_rounds):
        forward = (edges.join(rank.where("trust > 0").select(F.col("host").alias("src"), (F.col("trust") / F.col("n_out")).alias("t")), "src")
                   .select(F.col("dst").alias("host"), "t", F.lit(0.0).alias("d")))
        back = (edges.join(rank.where("distrust > 0").select(F.col("host").alias("dst"), (F.col("distrust") / F.col("n_in")).alias("d")), "dst")
                .select(F.col("src").alias("host"), F.lit(0.0).alias("t"), "d"))
        got = forward.unionByName(back).groupBy("host").agg(F.sum("t").alias("t"), F.sum("d").alias("d"))
        new = (rank.join(got, "host", "left").select(
            "host", "good", "bad", "n_out", "n_in", F.col("trust").alias("t0"), F.col("distrust").alias("d0"),
            ((1 - damping + damping * F.lit(float(held_t or 0))) * F.col("good") + damping * F.coalesce("t", F.lit(0.0))).alias("trust"),
            ((1 - damping + damping * F.lit(float(held_d or 0))) * F.col("bad") + damping * F.coalesce("d", F.lit(0.0))).alias("distrust")))
        # The write of a round observes how far it moved, and what the next has to hand back.
        seen = Observation(f"round_{k}_{uuid.uuid4().hex}")
        new = new.observe(seen, F.sum(F.abs(F.col("trust") - F.col("t0")) + F.abs(F.col("distrust") - F.col("d0"))).alias("moved"),
                          F.sum(F.when(F.col("n_out").isNull(), F.col("trust"))).alias("held_t"),
                          F.sum(F.when(F.col("n_in").isNull(), F.col("distrust"))).alias("held_d"))
        rank = materialize(new.drop("t0", "d0"), "ranks")
        held_t, held_d = seen.get["held_t"], seen.get["held_d"]
        if (seen.get["moved"] or 0) * damping / (1 - damping) < tolerance:
            break
    else:
        raise RuntimeError(f"link graph did not converge in {most_rounds} rounds")
    return rank.select("host", "trust", "distrust")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust for every row of ``pages``
    (page_id, url, html; other columns are ignored).

    A rule's verdict holds where one fits; other pages get their host's: ``block`` if its
    distrust exceeds its trust and ``threshold`` of a mean share, else ``allow``. A host is a
    seed if rules decide more than half of its pages alike. NULL urls and urls without ://
    have empty host and path, are no part of the graph and are allowed unless a rule fits.
    NULL html has no links. Repeated rows are judged each.
    """
    host, path = host_and_path(F.col("url"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    base = pages.select("page_id", host.alias("host"), path.alias("path"), "html")
    ruled = base.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("by_rule"))
    edges = materialize(host_edges(base), "edges")
    seen = ruled.where("host != ''").groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("by_rule") == "allow").alias("good"),
        F.count_if(F.col("by_rule") == "block").alias("bad"))
    linked = edges.select(F.explode(F.array("src", "dst")).alias("host")).distinct()
    hosts = seen.join(linked, "host", "full").select(
        "host", (F.coalesce(F.col("good") * 2 > F.col("n"), F.lit(False))).alias("good"),
        (F.coalesce(F.col("bad") * 2 > F.col("n"), F.lit(False))).alias("bad"))
    hosts = materialize(hosts, "hosts")
    n, good, bad = hosts.agg(F.count(F.lit(1)), F.count_if("good"), F.count_if("bad")).first()
    seeds = hosts.select("host", (F.col("good").cast("double") / max(good, 1)).alias("good"),
                         (F.col("bad").cast("double") / max(bad, 1)).alias("bad"))
    # A thousandth of the share that blocks: nearer to the limit no verdict is meaningful.
    ranks = propagate(seeds, edges, tolerance=threshold / max(n, 1) / 1000).withColumnRenamed("host", "of")
    blocked = (F.col("distrust") > F.col("trust")) & (F.col("distrust") * n >= threshold)
    return ruled.join(ranks, ruled["host"] == F.col("of"), "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("by_rule", F.when(F.coalesce(blocked, F.lit(False)), "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
