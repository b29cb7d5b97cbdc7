import datetime as dt

from pyspark.sql import functions as F

from webloom.operators import frontier

BODY = """User-agent: Foo
Disallow: /foo
User-agent: *
Allow: /pub
disallow: /adm
Disallow:
# note
Disallow /bad
"""


def rules(spark, *bodies):
    df = spark.createDataFrame([("https://h.es", b) for b in bodies], "site string, body string")
    return sorted((r.kind, r.rule) for r in frontier.robots_rules(df).collect())


def test_robots(spark):
    assert rules(spark, BODY) == [("allow", "https://h.es/pub"), ("disallow", "https://h.es/adm")]
    assert rules(spark, "Disallow: /early\n\n USER-AGENT :*\r\nDisallow: /a:b\r\nUser-agent: x\nDisallow: /c") == [
        ("disallow", "https://h.es/a:b")
    ]
    assert rules(spark, "# User-agent: *\nDisallow: /x", "") == []


def test_allowed(spark):
    df = spark.createDataFrame([("https://h.es", BODY)], "site string, body string")
    urls = spark.createDataFrame(
        [("https://h.es/adm",), ("https://h.es/adm/1",), ("https://h.es/",), ("https://k.es/adm",)],
        "url string",
    )
    r = frontier.robots_rules(df)
    exact = sorted(x.url for x in frontier.allowed_urls(urls, r).collect())
    assert exact == ["https://h.es/", "https://h.es/adm/1", "https://k.es/adm"]
    prefix = sorted(x.url for x in frontier.allowed_urls(urls, r, "prefix").collect())
    assert prefix == ["https://h.es/", "https://k.es/adm"]


def test_new_roots_and_queue(spark):
    links = spark.createDataFrame(
        [("https://a.es/q",), ("http://n.es/r",), ("https://n.es/s",), ("https://n.es/t",), ("https://",)],
        "link string",
    )
    log = spark.createDataFrame([("a.es",), ("a.es",), ("s.es",)], "domain string")
    roots = sorted(r.url for r in frontier.undiscovered_roots(links, log).collect())
    assert roots == ["http://n.es", "https://n.es"]
    queue = spark.createDataFrame([("https://s.es",), ("https://n.es",), ("https://o.es",)], "url string")
    merged = sorted(r.url for r in frontier.merge_frontier(queue, links, log).collect())
    assert merged == ["http://n.es", "https://n.es", "https://o.es"]


def test_unvisited(spark):
    found = spark.createDataFrame([("u",), ("v",), ("v",)], "url string")
    seen = spark.createDataFrame([("u",)], "url string")
    assert [r.url for r in frontier.unvisited(found, seen).collect()] == ["v"]


def test_recrawl(spark):
    log = spark.createDataFrame(
        [("a", dt.datetime(2025, 1, 1)), ("b", dt.datetime(2025, 1, 2, 12)),
         ("c", dt.datetime(2024, 1, 1)), ("c", dt.datetime(2025, 1, 2, 23))],
        "domain string, crawled_at timestamp",
    )
    due = frontier.recrawl_due(log, F.lit(dt.datetime(2025, 1, 3)))
    assert [r.domain for r in due.collect()] == ["a"]


def test_reach(spark):
    seeds = spark.createDataFrame([("a", 1), ("b", 0), ("z", -1)], "domain string, depth int")
    edges = spark.createDataFrame([("a", "c"), ("c", "d"), ("b", "e")], "src string, dst string")
    got = {r.domain: r.depth for r in frontier.domain_reach(seeds, edges).collect()}
    assert got == {"a": 1, "b": 0, "c": 0}


def test_reach_takes_the_better_way(spark):
    seeds = spark.createDataFrame([("a", 1), ("s", 5)], "domain string, depth int")
    edges = spark.createDataFrame(
        [("a", "c"), ("s", "t"), ("t", "c"), ("c", "d"), ("d", "s"), ("d", "e"), ("s", "s")],
        "src string, dst string",
    )
    got = {r.domain: r.depth for r in frontier.domain_reach(seeds, edges).collect()}
    assert got == {"a": 1, "s": 5, "t": 4, "c": 3, "d": 2, "e": 1}
