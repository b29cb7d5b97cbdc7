"""Queries on history and link graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.functions import html, urls
from webloom.operators import graph, snapshot
from webloom.operators.tagging import with_url
from webloom.plans import inputs
from webloom.plans import oracle_parts as o
from webloom.plans.registry import query
from webloom.session import stage_table

_EVENTS = """e AS (SELECT user_id, strftime(ts, '%Y-%m-%d') AS date, ts, event_id, event_type, value
  FROM events)"""


def _events(spark: SparkSession, sf: str) -> DataFrame:
    """Events as snapshots: the user is the page, the day of the event the crawl day."""
    return inputs.table(spark, sf, "events").select(
        "user_id", F.date_format("ts", "yyyy-MM-dd").alias("date"), "ts", "event_id",
        "event_type", "value",
    )


_NEWEST_FIRST = ((F.desc, "ts"), (F.desc, "event_id"))


def _order() -> list:
    return [f(c) for f, c in _NEWEST_FIRST]


@query(
    "daily_dedupe",
    f"""WITH {_EVENTS}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id, date
  ORDER BY ts DESC, event_id DESC) AS rn FROM e)
SELECT user_id, date, event_id, event_type, value FROM r WHERE rn = 1""",
)
def daily_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    return snapshot.daily_dedupe(_events(spark, sf), "user_id", "date", _order()).drop("ts")


@query(
    "latest_snapshot",
    f"""WITH {_EVENTS}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id
  ORDER BY date DESC, ts DESC, event_id DESC) AS rn FROM e)
SELECT user_id, date, event_id, event_type, value FROM r WHERE rn = 1""",
)
def latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    return snapshot.latest_snapshot(_events(spark, sf), "user_id", "date", _order()).drop("ts")


# Part and supplier graph.
LINKS = """items AS (SELECT 's' || l_suppkey AS s, 'p' || l_partkey AS p,
  l_returnflag = 'R' OR (l_returnflag = 'N' AND l_linenumber % 2 = 1) AS forward FROM lineitem),
links AS (SELECT CASE WHEN forward THEN s ELSE p END AS src,
  CASE WHEN forward THEN p ELSE s END AS link FROM items)"""
GRAPH = f"""{LINKS},
nodes AS (SELECT DISTINCT 's' || s_suppkey AS url FROM supplier
  UNION SELECT DISTINCT 'p' || p_partkey FROM part),
edges AS (SELECT DISTINCT src, link AS dst FROM links WHERE link IN (SELECT url FROM nodes)),
degrees AS (SELECT src, count(*) AS out_degree FROM edges GROUP BY src),
trans AS (SELECT src, dst, 1.0::double / out_degree AS weight FROM edges JOIN degrees USING (src))"""


def _links(spark: SparkSession, sf: str) -> DataFrame:
    return inputs.part_supplier_links(spark, sf)


def _nodes(spark: SparkSession, sf: str) -> DataFrame:
    return graph.vertices(inputs.part_supplier_nodes(spark, sf))


def _edges(spark: SparkSession, sf: str) -> DataFrame:
    return graph.edges(_links(spark, sf), _nodes(spark, sf))


@query(
    "external_refs",
    f"WITH {LINKS} SELECT link, count(*) AS external_refs FROM links GROUP BY link",
)
def external_refs(spark: SparkSession, sf: str) -> DataFrame:
    return graph.external_refs(_links(spark, sf))


@query("graph_vertices", f"WITH {GRAPH} SELECT url FROM nodes")
def graph_vertices(spark: SparkSession, sf: str) -> DataFrame:
    return _nodes(spark, sf)


@query("graph_edges", f"WITH {GRAPH} SELECT src, dst FROM edges")
def graph_edges(spark: SparkSession, sf: str) -> DataFrame:
    return _edges(spark, sf)


@query("out_degree", f"WITH {GRAPH} SELECT src, out_degree FROM degrees")
def out_degree(spark: SparkSession, sf: str) -> DataFrame:
    return graph.out_degree(_edges(spark, sf))


@query("transitions", f"WITH {GRAPH} SELECT src, dst, round(weight, 6) AS weight FROM trans")
def transitions(spark: SparkSession, sf: str) -> DataFrame:
    return graph.transitions(_edges(spark, sf)).withColumn("weight", F.round("weight", 6))


def rank_ctes(nodes: str = "nodes", trans: str = "trans") -> str:
    """r0 … r10: one CTE per round."""
    ctes = [f"r0 AS MATERIALIZED (SELECT url, 1.0::double AS rank FROM {nodes})"]
    for i in range(graph.ITERATIONS):
        ctes.append(
            f"""r{i + 1} AS MATERIALIZED (SELECT n.url, 0.15::double + 0.85 * coalesce(c.s, 0) AS rank
  FROM {nodes} n LEFT JOIN (SELECT t.dst, sum(r.rank * t.weight) AS s FROM r{i} r
    JOIN {trans} t ON t.src = r.url GROUP BY t.dst) c ON c.dst = n.url)"""
        )
    return ",\n".join(ctes)


@query(
    "pagerank",
    f"WITH {GRAPH}, {rank_ctes()} SELECT url, round(rank, 4) AS pagerank FROM r10",
)
def pagerank(spark: SparkSession, sf: str) -> DataFrame:
    ranks = graph.pagerank(_nodes(spark, sf), _edges(spark, sf))
    return ranks.withColumn("pagerank", F.round("pagerank", 4))


# Two days of pages: on the older day each page still lacks its parent link.
HISTORY = f"""{o.NUMBERED_PAGES}, {o.marked_cte(pages='numbered')}, {o.masked_cte()}, {o.parsed_cte()},
{o.marked_cte('marked0', "'#old'", 'numbered')}, {o.masked_cte('marked0', 'masked0')},
{o.parsed_cte('masked0', 'parsed0')},
raw AS (SELECT page_id, {o.canonical('url')} AS url, '{inputs.DAY}' AS date, https || http AS ext FROM parsed
  UNION ALL SELECT page_id, {o.canonical('url')}, '{inputs.DAY_BEFORE}', https || http FROM parsed0),
history AS (SELECT url, date, ext FROM (SELECT *, row_number() OVER (PARTITION BY url, date
  ORDER BY page_id) AS rn FROM raw) x WHERE rn = 1),
latest AS (SELECT url, ext FROM (SELECT *, row_number() OVER (PARTITION BY url
  ORDER BY date DESC) AS rn FROM history) x WHERE rn = 1),
links AS (SELECT url AS src, unnest(ext) AS link FROM latest),
refs AS (SELECT link, count(*) AS external_refs FROM links GROUP BY link),
nodes AS (SELECT url FROM latest),
edges AS (SELECT DISTINCT src, link AS dst FROM links WHERE link IN (SELECT url FROM nodes)),
degrees AS (SELECT src, count(*) AS out_degree FROM edges GROUP BY src),
trans AS (SELECT src, dst, 1.0::double / out_degree AS weight FROM edges JOIN degrees USING (src)),
{rank_ctes()},
scored AS (SELECT h.url, h.date, coalesce(external_refs, 0) AS external_refs,
  coalesce(rank, 0.15) AS pagerank, h.date = max(h.date) OVER (PARTITION BY h.url) AS is_latest
  FROM history h LEFT JOIN refs ON refs.link = h.url LEFT JOIN r10 ON r10.url = h.url)"""


@query(
    "link_rows",
    f"""WITH {o.pages_ctes()}, {o.parsed_cte()}
SELECT {o.canonical('url')} AS src, unnest(https || http) AS link FROM parsed""",
)
def link_rows(spark: SparkSession, sf: str) -> DataFrame:
    """External links of all pages, repeated ones too."""
    u = F.col("url")
    parsed = html.parse_pages(inputs.marked_pages(spark, sf))
    pages = parsed.select(
        urls.canonical_url(urls.domain(u), urls.path(u)).alias("url"), "content"
    )
    return graph.link_rows(pages)


@query(
    "pages_scored",
    f"""WITH {HISTORY}
SELECT url, date, external_refs, round(pagerank, 4) AS pagerank, is_latest FROM scored""",
)
def pages_scored(spark: SparkSession, sf: str) -> DataFrame:
    """History of two days with duplicates, scored by the links of the newest versions."""
    from webloom.plans.rebuild import process_lake

    raw = stage_table(inputs.history_rows(spark, sf), "landed")
    return process_lake(raw).select(
        "url", "date", "external_refs", F.round("pagerank", 4).alias("pagerank"), "is_latest"
    )


@query(
    "page_history",
    f"WITH {HISTORY} SELECT url, date, array_to_string(ext, ' ') AS links FROM history",
)
def page_history(spark: SparkSession, sf: str) -> DataFrame:
    """Daily dedupe of whole page rows."""
    pages = with_url(inputs.history_rows(spark, sf))
    return snapshot.daily_dedupe(pages).select(
        "url",
        "date",
        F.array_join(urls.external_links(F.col("content.links")), " ").alias("links"),
    )
