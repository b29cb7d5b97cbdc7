"""Batch rebuild: landed pages to a published set of scored pages, index and IDF."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom import schema as S
from webloom.operators import graph, index, search, snapshot
from webloom.operators.tagging import with_url
from webloom.session import scratch_scope, stage_table
from webloom.sources import lake

LAKE_PAGE = T.StructType(S.SCORED_PAGE.fields + [T.StructField("is_latest", T.BooleanType())])


class Tables(NamedTuple):
    """One published version; all tables belong together."""

    pages: DataFrame
    postings: DataFrame
    mappings: DataFrame
    idf: DataFrame
    domain_buckets: int | None = None


def process_lake(raw: DataFrame) -> DataFrame:
    """Daily history of the landed pages with in-link counts, ranks and ``is_latest``.

    Narrow passes over the landed files read only the links, for graph and ranks,
    and only the addresses and days. One wide pass carries the content through a
    single shuffle, the dedupe, to the write.
    """
    # A missing day is a day of its own, as it is for the dedupe.
    pages = with_url(raw).withColumn("_day", F.coalesce("date", F.lit("")))
    newest = snapshot.latest_links(pages)
    newest = stage_table(newest, "latest-links")
    links = graph.link_rows(newest, "links")
    refs = stage_table(graph.external_refs(links), "refs")
    nodes = newest.select("url")
    ranks = graph.pagerank(nodes, graph.edges(links, nodes))
    history = snapshot.daily_dedupe(pages, date="_day")
    days = pages.select("url", "_day").distinct()
    return graph.attach_scores(history, days, refs, ranks, "_day").drop("_day")


def write_index(
    pages: DataFrame, target: str, hash_of: Callable[[Column], Column] = index.doc_key
) -> None:
    """Postings sorted by token, mappings and IDF of the newest page versions.

    Texts are dealt out by document, so that postings are counted in place and move
    once, to their sorted files.
    """
    spark = pages.sparkSession
    latest = index.with_doc_keys(pages.where("is_latest"), hash_of)
    docs = index.page_documents(latest).repartition("doc_key")
    index.write_sorted(index.postings(index.tokens(docs)), f"{target}/postings")
    index.doc_mappings(latest).write.mode("errorifexists").parquet(f"{target}/mappings")
    stored = spark.read.schema(S.POSTING).parquet(f"{target}/postings")
    corpus = spark.read.schema(S.MAPPING).parquet(f"{target}/mappings")
    idf = index.idf(index.doc_freq_of(stored), corpus)
    index.write_sorted(idf, f"{target}/idf", ("token",))


def rebuild(
    spark: SparkSession,
    landing: str,
    base: str,
    domain_buckets: int | None = None,
    hash_of: Callable[[Column], Column] = index.doc_key,
) -> int:
    """Run all steps and publish the result as the next version of ``base``.

    A failed run leaves the current version as it is and can simply be repeated.
    Intermediate tables are removed at the end, also after an error.
    """
    with scratch_scope(spark):
        version, folder = lake.new_version(spark, base)
        target = f"{base}/{folder}"
        raw = lake.scan(spark, landing)
        lake.write_partitioned(process_lake(raw), f"{target}/pages", domain_buckets)
        pages = lake.read_partitioned(spark, f"{target}/pages", LAKE_PAGE)
        write_index(pages, target, hash_of)
        lake.commit_version(spark, base, version, folder, domain_buckets)
    return version


def open_tables(spark: SparkSession, base: str) -> Tables:
    """The current version; empty tables before the first rebuild."""
    line = lake.current(spark, base)
    if line is None:
        return Tables(
            *[
                spark.createDataFrame([], s)
                for s in (LAKE_PAGE, S.POSTING, S.MAPPING, S.IDF)
            ]
        )
    target = f"{base}/{line['folder']}"
    return Tables(
        lake.read_partitioned(spark, f"{target}/pages", LAKE_PAGE),
        spark.read.schema(S.POSTING).parquet(f"{target}/postings"),
        spark.read.schema(S.MAPPING).parquet(f"{target}/mappings"),
        spark.read.schema(S.IDF).parquet(f"{target}/idf"),
        line["domain_buckets"],
    )


def search_text(
    spark: SparkSession, base: str, text: str, k: int = search.TOP_K, normalise: bool = False
) -> DataFrame:
    """Ranked hits of one query on the published index."""
    t = open_tables(spark, base)
    return search.search(t.postings, t.idf, t.mappings, text, k, normalise)


def all_hits(spark: SparkSession, base: str, text: str) -> DataFrame:
    """Every hit of one query on the published index, unordered."""
    t = open_tables(spark, base)
    return search.all_hits(t.postings, t.idf, t.mappings, text)


def lookup(spark: SparkSession, base: str, address: str) -> DataFrame:
    """All stored versions of an address in the published lake."""
    t = open_tables(spark, base)
    return search.page_lookup(t.pages, address, t.domain_buckets)


def sample(spark: SparkSession, base: str, token: str | None = None, limit: int = 20) -> DataFrame:
    """Rows of the published index, for inspection."""
    return index.index_sample(open_tables(spark, base).postings, token, limit)
