"""Queries that decide what to crawl next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.functions import html, urls
from webloom.operators import frontier
from webloom.plans import inputs
from webloom.plans import oracle_parts as o
from webloom.plans.registry import query
from webloom.sources import config_files


def _sql_site(u: str) -> str:
    return f"{o.scheme(u)} || '://' || {o.domain(u)}"


_BLANKS = "' ' || chr(9) || chr(11) || chr(12) || chr(13)"
ROBOTS = f"""bodies AS (SELECT {_sql_site('url')} AS site, 'User-agent: Foo' || chr(10) ||
  'Disallow: /foo' || page_id || chr(10) || 'USER-AGENT : *' || chr(13) || chr(10) ||
  'Allow: /pub' || (page_id % 3) || chr(13) || chr(10) || '  disallow:  ' ||
  CASE WHEN page_id % 2 = 0 THEN {o.raw_path('url')} ELSE '' END || ' ' || chr(10) ||
  '# note: x' || chr(10) || 'Disallow /bad' || chr(10) || 'Sitemap: https://x.example/s.xml' AS body,
  page_id FROM pages),
lines AS (SELECT page_id, site, unnest(string_split(body, chr(10))) AS line,
  generate_subscripts(string_split(body, chr(10)), 1) AS pos FROM bodies),
pairs AS (SELECT page_id, site, pos, lower(trim(split_part(line, ':', 1), {_BLANKS})) AS kind,
  trim(substring(line, instr(line, ':') + 1), {_BLANKS}) AS value
  FROM lines WHERE contains(line, ':') AND NOT starts_with(trim(line, {_BLANKS}), '#')),
under AS (SELECT *, last_value(CASE WHEN kind = 'user-agent' THEN value END IGNORE NULLS)
  OVER (PARTITION BY page_id ORDER BY pos) AS agent FROM pairs),
rules AS (SELECT site, kind, site || value AS rule FROM under
  WHERE agent = '*' AND kind IN ('allow', 'disallow') AND value <> '')"""


@query("robots_rules", f"WITH {ROBOTS} SELECT site, kind, rule FROM rules")
def robots_rules(spark: SparkSession, sf: str) -> DataFrame:
    return frontier.robots_rules(inputs.robots_bodies(spark, sf))


_CANDIDATES = f"""plain AS (SELECT {_sql_site('url')} || {o.raw_path('url')} AS url FROM pages),
cand AS (SELECT DISTINCT url FROM (SELECT url FROM plain UNION ALL SELECT url || '/more' FROM plain) x),
no AS (SELECT site, rule FROM rules WHERE kind = 'disallow')"""


@query(
    "frontier_robots",
    f"WITH {ROBOTS}, {_CANDIDATES} SELECT url FROM cand WHERE url NOT IN (SELECT rule FROM no)",
)
def frontier_robots(spark: SparkSession, sf: str) -> DataFrame:
    rules = frontier.robots_rules(inputs.robots_bodies(spark, sf))
    return frontier.allowed_urls(inputs.sited_paths(spark, sf), rules)


@query(
    "frontier_robots_prefix",
    f"""WITH {ROBOTS}, {_CANDIDATES} SELECT url FROM cand WHERE NOT EXISTS (
  SELECT 1 FROM no WHERE no.site = {_sql_site('cand.url')} AND starts_with(cand.url, no.rule))""",
)
def frontier_robots_prefix(spark: SparkSession, sf: str) -> DataFrame:
    rules = frontier.robots_rules(inputs.robots_bodies(spark, sf))
    return frontier.allowed_urls(inputs.sited_paths(spark, sf), rules, match="prefix")


_LINKS = f"{o.pages_ctes()}, {o.parsed_cte()}, ext AS (SELECT unnest(https || http) AS link FROM parsed)"
_LOG = f"log AS (SELECT {o.domain('url')} AS domain FROM pages WHERE page_id % 2 = 1)"
_ROOTS = f"""roots AS (SELECT DISTINCT CASE WHEN starts_with(link, 'https://') THEN 'https://'
  ELSE 'http://' END || {o.domain('link')} AS url, {o.domain('link')} AS domain FROM ext
  WHERE {o.domain('link')} <> '')"""


def _external(spark: SparkSession, sf: str) -> DataFrame:
    targets = html.link_targets(F.col("masked"))
    found = inputs.masked_pages(spark, sf).select(F.explode(targets).alias("link"))
    return found.where(html.link_class(F.col("link")).isin("https", "http"))


def _crawl_log(spark: SparkSession, sf: str) -> DataFrame:
    """Pages with an odd number count as crawled, the others as found only."""
    pages = inputs.table(spark, sf, "pages")
    return pages.where("page_id % 2 = 1").select(urls.domain(F.col("url")).alias("domain"))


@query(
    "frontier_new_roots",
    f"""WITH {_LINKS}, {_LOG}, {_ROOTS}
SELECT url, domain FROM roots WHERE domain NOT IN (SELECT domain FROM log)""",
)
def frontier_new_roots(spark: SparkSession, sf: str) -> DataFrame:
    return frontier.undiscovered_roots(_external(spark, sf), _crawl_log(spark, sf))


@query(
    "frontier_domains",
    f"""WITH {_LINKS}, {_LOG}, {_ROOTS},
queue AS (SELECT {_sql_site('url')} AS url, {o.domain('url')} AS domain FROM pages)
SELECT DISTINCT url, domain FROM (SELECT * FROM queue UNION SELECT * FROM roots) x
WHERE domain NOT IN (SELECT domain FROM log)""",
)
def frontier_domains(spark: SparkSession, sf: str) -> DataFrame:
    """Queue of all sites, merged with linked sites, without started domains."""
    u = F.col("url")
    queue = inputs.table(spark, sf, "pages").select(
        F.concat(urls.scheme(u), F.lit("://"), urls.domain(u)).alias("url")
    )
    return frontier.merge_frontier(queue, _external(spark, sf), _crawl_log(spark, sf))


@query(
    "frontier_internal",
    f"""WITH {o.pages_ctes()}, {o.parsed_cte()},
found AS (SELECT page_id, unnest({o.internal_urls('internal')}) AS url FROM parsed)
SELECT DISTINCT url FROM found WHERE url NOT IN (SELECT url FROM found WHERE page_id % 3 = 0)""",
)
def frontier_internal(spark: SparkSession, sf: str) -> DataFrame:
    """Internal links, with those of every third page counting as visited."""
    internal = html.links_of_class(html.link_targets(F.col("masked")), "internal")
    found = inputs.masked_pages(spark, sf).select(
        "page_id", F.explode(urls.resolve_internal(F.col("url"), internal)).alias("url")
    )
    return frontier.unvisited(found, found.where("page_id % 3 = 0"))


@query(
    "recrawl_due",
    """WITH l AS (SELECT 'u' || user_id AS domain, max(ts) AS last_crawled FROM events GROUP BY 1),
n AS (SELECT max(ts) AS as_of FROM events)
SELECT domain, strftime(last_crawled, '%Y-%m-%d %H:%M:%S') AS last_crawled FROM l, n
WHERE last_crawled + INTERVAL 24 HOUR < as_of""",
)
def recrawl_due(spark: SparkSession, sf: str) -> DataFrame:
    """Users as domains: whose last event is a day older than the newest event."""
    events = inputs.table(spark, sf, "events")
    log = events.select(
        F.concat(F.lit("u"), "user_id").alias("domain"), F.col("ts").alias("crawled_at")
    )
    as_of = events.agg(F.max("ts")).scalar()
    return frontier.recrawl_due(log, as_of).withColumn(
        "last_crawled", F.date_format("last_crawled", "yyyy-MM-dd HH:mm:ss")
    )


@query(
    "domain_reach",
    """WITH RECURSIVE edges AS (
  SELECT 'd' || o_custkey AS src, 'd' || (o_orderkey % 100003) AS dst FROM orders
  UNION SELECT 'd' || (o_orderkey % 100003), 'd' || o_custkey FROM orders
  UNION SELECT 'd' || (c_custkey % 3), 'd' || c_custkey FROM customer),
reach(domain, depth) AS (
  SELECT 'd' || c_custkey, (c_nationkey % 5 - 2)::int FROM customer WHERE c_nationkey % 5 >= 2
  UNION SELECT dst, depth - 1 FROM reach JOIN edges ON src = domain WHERE depth > 0)
SELECT domain, max(depth)::int AS depth FROM reach GROUP BY domain""",
)
def domain_reach(spark: SparkSession, sf: str) -> DataFrame:
    return frontier.domain_reach(inputs.domain_seeds(spark, sf), inputs.domain_edges(spark, sf))


@query(
    "seeds_explode",
    """SELECT c_nationkey, 'https://c' || c_custkey || '.example' AS url, c_nationkey % 4 AS depth
  FROM customer UNION ALL SELECT c_nationkey, 'https://n' || c_custkey || '.example', 0 FROM customer""",
)
def seeds_explode(spark: SparkSession, sf: str) -> DataFrame:
    """A seed list per customer, as JSON text."""
    entry = lambda letter, depth: F.create_map(
        F.concat(F.lit(f"https://{letter}"), "c_custkey", F.lit(".example")), depth
    )
    lists = F.array(entry("c", F.col("c_nationkey") % 4), entry("n", F.lit(0)))
    raw = inputs.table(spark, sf, "customer").select("c_nationkey", F.to_json(lists).alias("seeds"))
    return config_files.explode_seeds(raw)
