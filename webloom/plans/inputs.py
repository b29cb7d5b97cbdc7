"""Inputs of the registered queries, derived by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.functions import html, urls
from webloom.operators.tagging import to_page_rows
from webloom.session import deal_out, stage_table

# Tables with long texts, whose work is per row and heavy on the processor.
TEXT_TABLES = ("pages", "documents")

DAY, DAY_BEFORE = "2024-01-02", "2024-01-01"

# Markup put into every page, so that each element and link class occurs on it.
# {id}, {id3} … stand for page_id and its remainders, {hub} and {parent} for
# the addresses of other pages.
HEAD_BLOCK = (
    '<meta name="description" content="d{id}"><meta name="keywords" content="k &amp; {id7}">'
    "<meta name='keywords' content='a&lt;b'><meta property=\"og:x\" content=\"n\">"
    '<link rel="stylesheet" href="/s{id5}.css"><link rel=icon href=/f.ico>'
    '<link rel="x" href="/y.svg"><script src="https://cdn.example/x{id5}.js"></script>'
    '<script src="/l.js">var t="<a href=\'https://no.example\'>";</script></head>'
)
BODY_BLOCK = (
    '<body><!-- <a href="https://no.example/2">x</a> --><h2>S &amp; T &eacute;&#241; {id}</h2>'
    "<p>We offer cloud{id3} systems and data tools, y soporte {id}<p>P{id}</p>"
    "<p>don&apos;t &copy 2024 &#0000000065; &#150;&#x1f600;&#99999999; &notit; &amp{id} &nope; &#x;</p>"
    '<a href="/q{id3}?a=1&copy=2&para;m&notit=3&lt&#38;x">r</a>'
    '<img src="https://img.example/{id7}.png"><img src="/2.png">'
    '<a href="{hub}">h</a><a href=\'{parent}\' title="a > b">p</a>'
    '<a href="http://z{id3}.example/q">z</a><a href="/d{id}.pdf">d</a>'
    '<a href="#top">t</a><a>e</a><A HREF = "mailto:a{id5}@x.example">m</A>'
    '<noscript><a href="https://no.example/3">n</a></noscript>'
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return deal_out(rows) if name in TEXT_TABLES else rows


def _filled(block: str) -> Column:
    page_id = F.col("page_id")
    values = {
        "{id}": page_id.cast("string"),
        **{f"{{id{n}}}": (page_id % n).cast("string") for n in (3, 5, 7)},
        "{hub}": F.col("hub"),
        "{parent}": F.col("parent"),
    }
    out = F.lit(block)
    for mark, value in values.items():
        if mark in block:
            out = F.replace(out, F.lit(mark), F.coalesce(value, F.lit("#none")))
    return out


def marked_pages(
    spark: SparkSession, sf_dir: str, drop_parent: bool = False, distinct: bool = False
) -> DataFrame:
    """(page_id, url, html): every page with the blocks above in head and body.

    ``distinct`` puts the page number into the path, so that no two pages share
    their address.

    Each page links to a hub (its number modulo ten) and to a parent (half its
    number), so a few pages get a large part of all links.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    if distinct:
        numbered = F.concat(F.lit("$1/"), F.col("page_id"))
        pages = pages.withColumn("url", F.regexp_replace("url", "^([^?#]*)", numbered))
    address = urls.canonical_url(urls.domain(F.col("url")), urls.path(F.col("url")))
    known = pages.select("page_id", address.alias("address"))
    # Ten rows, whatever the size of the table.
    hubs = known.where(F.col("page_id").between(0, 9)).select(
        F.col("page_id").alias("hub_id"), F.col("address").alias("hub")
    )
    linked = pages.withColumn("hub_id", F.col("page_id") % 10).join(
        F.broadcast(hubs), "hub_id", "left"
    )
    if drop_parent:
        linked = linked.withColumn("parent", F.lit("#old"))
    else:
        # Numbers and addresses find each other first, then the pages move once.
        parents = (
            known.select("page_id", F.floor(F.col("page_id") / 2).alias("parent_id"))
            .join(
                known.select(
                    F.col("page_id").alias("parent_id"), F.col("address").alias("parent")
                ),
                "parent_id",
                "left",
            )
            .select("page_id", "parent")
        )
        linked = linked.join(parents, "page_id", "left")
    head = F.replace(F.col("html"), F.lit("</head>"), _filled(HEAD_BLOCK))
    return linked.select(
        "page_id", "url", F.replace(head, F.lit("<body>"), _filled(BODY_BLOCK)).alias("html")
    )


def masked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, url, masked) of the marked pages."""
    return marked_pages(spark, sf_dir).select(
        "page_id", "url", html.mask_inert(F.col("html")).alias("masked")
    )


def page_rows(
    spark: SparkSession,
    sf_dir: str,
    date: str = DAY,
    drop_parent: bool = False,
    distinct: bool = False,
) -> DataFrame:
    parsed = html.parse_pages(marked_pages(spark, sf_dir, drop_parent, distinct))
    return to_page_rows(parsed, F.lit(date))


def history_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lake rows of two days; on the later one every row is there twice."""
    new = stage_table(page_rows(spark, sf_dir, distinct=True), "pages-new")
    old = page_rows(spark, sf_dir, DAY_BEFORE, drop_parent=True, distinct=True)
    return new.unionByName(new).unionByName(old)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_key, text) of the documents table."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc_key"), "text")


def _document_rank() -> Column:
    return F.lit(0.15) + (F.col("n_chars") % 13) / F.lit(8.0)


def ranked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_key, text, pagerank) of the documents table."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("doc_key"), "text", _document_rank().alias("pagerank")
    )


def document_mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses and scores for documents, made up from their columns."""
    n = F.col("n_chars")
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("doc_key"),
        F.concat(
            F.lit("https://"), "source", F.lit(".example/"), "lang", F.lit("/"), "doc_id"
        ).alias("url"),
        F.substring_index("text", "\n", 1).alias("title"),
        (n % 7).alias("external_refs"),
        _document_rank().alias("pagerank"),
    )


def part_supplier_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, link): suppliers point to returned parts, parts to suppliers of accepted ones.

    Of the items that are neither, every other one points either way.
    """
    rows = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("s"), F.col("l_suppkey")).alias("s"),
        F.concat(F.lit("p"), F.col("l_partkey")).alias("p"),
        "l_returnflag",
        "l_linenumber",
    )
    either = (F.col("l_returnflag") == "N") & (F.col("l_linenumber") % 2 == 1)
    forward = (F.col("l_returnflag") == "R") | either
    return rows.select(
        F.when(forward, F.col("s")).otherwise(F.col("p")).alias("src"),
        F.when(forward, F.col("p")).otherwise(F.col("s")).alias("link"),
    )


def part_supplier_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("url"))
    p = table(spark, sf_dir, "part").select(F.concat(F.lit("p"), "p_partkey").alias("url"))
    return s.unionByName(p)


def robots_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(site, body): one robots file per page, which disallows the page's own path."""
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        F.concat(urls.scheme(url), F.lit("://"), urls.domain(url)).alias("site"),
        F.concat(
            F.lit("User-agent: Foo\nDisallow: /foo"),
            F.col("page_id"),
            F.lit("\nUSER-AGENT : *\r\nAllow: /pub"),
            F.col("page_id") % 3,
            F.lit("\r\n  disallow:  "),
            F.when(F.col("page_id") % 2 == 0, urls.raw_path(url)).otherwise(F.lit("")),
            F.lit(" \n# note: x\nDisallow /bad\nSitemap: https://x.example/s.xml"),
        ).alias("body"),
    )


def sited_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(url): pages and everything below them, as scheme, domain and path."""
    url = F.col("url")
    plain = F.concat(urls.scheme(url), F.lit("://"), urls.domain(url), urls.raw_path(url))
    return table(spark, sf_dir, "pages").select(
        F.explode(F.array(plain, F.concat(plain, F.lit("/more")))).alias("url")
    )


def domain_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("d"), "c_custkey").alias("domain"),
        (F.col("c_nationkey") % 5 - 2).cast("int").alias("depth"),
    )


def domain_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers point to the numbers of their orders, the first customers to all customers.

    The orders of a customer's number point back, so there are cycles, and the first
    customers have very many targets.
    """
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer").select("c_custkey")
    name = lambda c: F.concat(F.lit("d"), c)
    own = orders.select(
        name(F.col("o_custkey")).alias("src"), name(F.col("o_orderkey") % 100_003).alias("dst")
    )
    back = orders.select(
        name(F.col("o_orderkey") % 100_003).alias("src"), name(F.col("o_custkey")).alias("dst")
    )
    hot = customer.select(
        name(F.col("c_custkey") % 3).alias("src"), name(F.col("c_custkey")).alias("dst")
    )
    return own.unionByName(back).unionByName(hot)


def crawl_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(domain, kind, at): users as domains; purchases and errors are fetches, the rest links."""
    kind = F.when(F.col("event_type").isin("purchase", "error"), "crawled").otherwise("link")
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("u"), "user_id", F.lit("-"), F.col("event_id") % 7).alias("domain"),
        kind.alias("kind"),
        F.date_trunc("second", "ts").alias("at"),
    )


def delivered_events(spark: SparkSession, sf_dir: str, turn: int) -> DataFrame:
    """(value, arrived): page events as a broker hands them over, in two turns.

    The first turn has every page, each third one twice; the second turn, an hour
    later, has each fifth one again. Each eleventh page arrives three days late.
    """
    n = F.col("page_id")
    pages = html.parse_pages(marked_pages(spark, sf_dir))
    noon = F.lit(f"{DAY} 10:00:00").cast("timestamp")
    moment = F.timestamp_seconds(F.unix_timestamp(noon) + n % 3600)
    late_days = F.when(n % 11 == 0, 3).otherwise(0)
    arrived = moment + F.make_dt_interval(days=late_days, hours=F.lit(turn))
    event = F.struct("url", moment.alias("timestamp"), "content")
    times = F.when(n % 3 == 0, 2).otherwise(1) if turn == 0 else F.when(n % 5 == 0, 1).otherwise(0)
    return pages.select(
        F.to_json(event).alias("value"),
        arrived.alias("arrived"),
        F.explode(F.array_repeat(F.lit(0), times)).alias("copy"),
    ).drop("copy")
