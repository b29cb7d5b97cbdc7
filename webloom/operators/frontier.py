"""Crawl planning as set operations on URL tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.functions import urls
from webloom.session import cut_lineage, stage_table

_BLANKS = " \t\r\f\u000b"


def robots_rules(bodies: DataFrame) -> DataFrame:
    """(site, kind, rule) of ``bodies(site, body)``: rules that hold for every agent.

    A body is cut at its User-agent lines; the first line of a section names the
    agent, and only sections for ``*`` count. Rules without a value are dropped.
    """
    strip = lambda c: F.btrim(c, F.lit(_BLANKS))
    sections = F.split(
        F.concat(F.lit("\n"), F.col("body")), r"\n[^\S\n]*(?i:user-agent)[^\S\n]*:", -1
    )
    lines = bodies.select(
        "site", F.explode(F.slice(sections, 2, F.size(sections))).alias("section")
    ).where(strip(F.substring_index("section", "\n", 1)) == "*")
    parsed = (
        lines.select("site", F.explode(F.split("section", "\n")).alias("line"))
        .select("site", strip(F.col("line")).alias("line"))
        .where(~F.col("line").startswith("#") & F.col("line").contains(":"))
        .select(
            "site",
            F.lower(strip(F.substring_index("line", ":", 1))).alias("kind"),
            strip(F.expr("substring(line, instr(line, ':') + 1)")).alias("value"),
        )
    )
    return parsed.where(F.col("kind").isin("allow", "disallow") & (F.col("value") != "")).select(
        "site", "kind", F.concat("site", "value").alias("rule")
    )


def allowed_urls(candidates: DataFrame, rules: DataFrame, match: str = "exact") -> DataFrame:
    """Candidate URLs without the disallowed ones.

    ``exact`` compares whole URLs, ``prefix`` beginnings within a site: a URL is cut to
    the rule lengths that its site uses, and the cuts are matched by equality, so no
    URL meets every rule of its site.
    """
    disallowed = rules.where(F.col("kind") == "disallow").select("site", "rule").distinct()
    candidates = candidates.distinct()
    if match == "exact":
        return candidates.join(
            disallowed.select(F.col("rule").alias("url")).distinct(), "url", "left_anti"
        )
    if match != "prefix":
        raise ValueError(f"unknown match {match!r}")
    site = F.concat(urls.scheme(F.col("url")), F.lit("://"), urls.domain(F.col("url")))
    # One array of distinct lengths per site; no longer than its longest rule.
    lengths = disallowed.groupBy("site").agg(F.collect_set(F.length("rule")).alias("lengths"))
    fitting = F.filter("lengths", lambda n: n <= F.length("url"))
    cuts = (
        candidates.withColumn("site", site)
        .join(lengths, "site")
        .select("url", "site", F.explode(fitting).alias("n"))
        .select("url", "site", F.col("url").substr(F.lit(1), F.col("n")).alias("rule"))
    )
    hit = cuts.join(disallowed, ["site", "rule"], "left_semi").select("url").distinct()
    return candidates.join(hit, "url", "left_anti")


def undiscovered_roots(links: DataFrame, crawl_log: DataFrame) -> DataFrame:
    """(url, domain): roots of linked sites whose domain was never crawled.

    Roots are made distinct before the join, so a site that everybody links to is
    one row by then. A link without a domain is skipped on its own.
    """
    roots = (
        links.select(
            urls.site_root(F.col("link")).alias("url"), urls.domain(F.col("link")).alias("domain")
        )
        .where(F.col("domain") != "")
        .distinct()
    )
    return roots.join(crawl_log.select("domain").distinct(), "domain", "left_anti").select("url", "domain")


def merge_frontier(queue: DataFrame, links: DataFrame, crawl_log: DataFrame) -> DataFrame:
    """The queue (url) plus newly found roots, without started domains."""
    queued = queue.select("url", urls.domain(F.col("url")).alias("domain"))
    found = links.select(
        urls.site_root(F.col("link")).alias("url"), urls.domain(F.col("link")).alias("domain")
    ).where(F.col("domain") != "")
    return (
        queued.unionByName(found)
        .distinct()
        .join(crawl_log.select("domain").distinct(), "domain", "left_anti")
        .select("url", "domain")
    )


def unvisited(links: DataFrame, visited: DataFrame) -> DataFrame:
    """Distinct internal URLs that were not processed yet."""
    return links.select("url").distinct().join(visited.select("url").distinct(), "url", "left_anti")


def recrawl_due(crawl_log: DataFrame, as_of: Column, expiry_hours: int = 24) -> DataFrame:
    """(domain, last_crawled) of domains whose last crawl is more than ``expiry_hours`` old."""
    return (
        crawl_log.groupBy("domain")
        .agg(F.max("crawled_at").alias("last_crawled"))
        .where(F.col("last_crawled") + F.make_interval(hours=F.lit(expiry_hours)) < as_of)
    )


def domain_reach(seeds: DataFrame, domain_edges: DataFrame) -> DataFrame:
    """(domain, depth): what ``seeds(domain, depth)`` reach and the depth left there.

    Each round follows the edges of the domains whose depth grew in the round
    before, so a domain is expanded again only when a better way to it turns up.
    The depth falls by one per hop, which ends the loop.
    """
    edges = stage_table(
        domain_edges.select("src", "dst").where(F.col("src") != F.col("dst")).distinct(),
        "domain-edges",
    )
    reached = cut_lineage(
        seeds.where(F.col("depth") >= 0)
        .groupBy("domain")
        .agg(F.max("depth").alias("depth"))
    )
    grown = reached
    while True:
        grown = grown.where(F.col("depth") > 0)
        if grown.isEmpty():
            return reached
        hops = (
            edges.join(grown.select(F.col("domain").alias("src"), "depth"), "src")
            .groupBy(F.col("dst").alias("domain"))
            .agg(F.max(F.col("depth") - 1).alias("found"))
        )
        merged = cut_lineage(
            reached.join(hops, "domain", "full").select(
                "domain",
                F.greatest("depth", "found").alias("depth"),
                (F.col("found") > F.coalesce("depth", F.lit(-1))).alias("grew"),
            )
        )
        reached = merged.select("domain", "depth")
        grown = merged.where("grew").select("domain", "depth")
