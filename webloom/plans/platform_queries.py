"""Queries that go through files, streams and whole rebuilds, and load-test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.functions import html, tags, urls
from webloom.operators import bench_tables, search, snapshot
from webloom.operators.tagging import with_url
from webloom.plans import inputs, rebuild
from webloom.plans import oracle_parts as o
from webloom.plans.graph_queries import HISTORY
from webloom.plans.page_queries import (
    PAGE_ROWS_SQL,
    TAGGED_CTES,
    TAGGED_FROM_PARSED,
    flat_page_rows,
)
from webloom.plans.registry import query
from webloom.plans.text_queries import DOC_TEXT
from webloom.session import scratch_path, stage_table
from webloom.sources import bench_files, config_files, crawl_events, lake
from webloom.sources.snapshots import SnapshotTable
from webloom.streaming import crawl_queue, ingest, redelivery

_ROWS = f"""{TAGGED_CTES},
page AS (SELECT domain, real_path, {o.sanitized('real_path')} AS path, tags, p FROM tagged)"""


@query(
    "lake_scan_union",
    f"""WITH {_ROWS}
SELECT domain, count(*) AS pages, sum(len(tags))::bigint AS tags, sum(len(p))::bigint AS paragraphs
FROM page GROUP BY domain""",
)
def lake_scan_union(spark: SparkSession, sf: str) -> DataFrame:
    """Pages landed in two formats and folders, read as one table."""
    rows = stage_table(inputs.page_rows(spark, sf), "page-rows")
    base = scratch_path(spark, "landing")
    odd = F.pmod(F.xxhash64("domain", "real_path"), F.lit(2)) == 1
    rows.where(odd).write.parquet(f"{base}/a/b")
    rows.where(~odd).write.json(f"{base}/c")
    return (
        lake.scan(spark, base)
        .groupBy("domain")
        .agg(
            F.count(F.lit(1)).alias("pages"),
            F.sum(F.size("tags")).alias("tags"),
            F.sum(F.size("content.texts.p")).alias("paragraphs"),
        )
    )


@query(
    "lake_scan_empty",
    f"""WITH {_ROWS}
SELECT domain, count(*) AS pages FROM page GROUP BY domain""",
)
def lake_scan_empty(spark: SparkSession, sf: str) -> DataFrame:
    """A missing folder is an empty table that goes together with a real one."""
    base = scratch_path(spark, "landing")
    inputs.page_rows(spark, sf).write.parquet(f"{base}/there")
    both = lake.scan(spark, f"{base}/there").unionByName(lake.scan(spark, f"{base}/missing"))
    return both.groupBy("domain").agg(F.count(F.lit(1)).alias("pages"))


@query("event_files", PAGE_ROWS_SQL)
def event_files(spark: SparkSession, sf: str) -> DataFrame:
    """Parsed pages published as event files by a stream, read back and tagged."""
    base = scratch_path(spark, "published-events")
    pages = html.parse_pages(inputs.marked_pages(spark, sf))
    pages.write.parquet(f"{base}/pages")
    stream = spark.readStream.schema(pages.schema).parquet(f"{base}/pages")
    ingest.event_file_sink(
        stream, F.lit(f"{inputs.DAY}T10:00:00Z"), f"{base}/events", f"{base}/state", available_now=True
    ).awaitTermination()
    source = ingest.file_source(spark, f"{base}/events")
    ingest.to_lake(source, f"{base}/lake", f"{base}/lake-state", available_now=True).awaitTermination()
    return flat_page_rows(lake.scan(spark, f"{base}/lake"))


@query(
    "lake_partition_counts",
    f"""WITH {HISTORY}
SELECT {o.domain('url')} AS domain_p, date AS date_p, count(*) AS pages FROM history GROUP BY ALL""",
)
def lake_partition_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Publish a history twice, read the current version by its folders."""
    base = scratch_path(spark, "lake")
    rows = stage_table(inputs.history_rows(spark, sf), "history")
    lake.publish(rows.where(F.col("date") == inputs.DAY_BEFORE), base)
    lake.publish(snapshot.daily_dedupe(with_url(rows)), base)
    return (
        lake.open_current(spark, base)
        .groupBy("domain_p", "date_p")
        .agg(F.count(F.lit(1)).alias("pages"))
    )


@query("lake_compact", PAGE_ROWS_SQL)
def lake_compact(spark: SparkSession, sf: str) -> DataFrame:
    """Crawl events in small batches, compacted before the stream goes on; the files of
    compacted batches are expired before the rows are read."""
    landing, base = scratch_path(spark, "events"), scratch_path(spark, "snapshots")
    # Each turn parses its own pages: the condition on the address goes below the parser.
    pages = html.parse_pages(inputs.marked_pages(spark, sf))
    when = F.lit(f"{inputs.DAY}T10:00:00Z")
    table = SnapshotTable(spark, f"{base}/table", domain_buckets=16)
    late = F.pmod(F.xxhash64("url"), F.lit(2)) == 1
    for turn in (~late, late):
        events = crawl_events.encode(pages.where(turn), when)
        events.write.mode("append").option("compression", "gzip").text(landing)
        files = len(spark.read.text(landing).inputFiles())
        source = ingest.file_source(spark, landing, -(-files // table.fanout) or 1)
        ingest.to_snapshots(
            source, table, f"{base}/state", "crawl", available_now=True
        ).awaitTermination()
        while table.compact():
            pass
    table.expire(0)
    return flat_page_rows(table.read())


def _broken_lines(spark: SparkSession, sf: str) -> DataFrame:
    """(value): every whole page as one line, which is no event."""
    return inputs.table(spark, sf, "pages").select(
        F.regexp_replace("html", "[\\r\\n]+", " ").alias("value")
    )


@query("stream_ingest", PAGE_ROWS_SQL)
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Crawl events as JSON lines, some of them broken, through the stream into the lake."""
    landing, target = scratch_path(spark, "events"), scratch_path(spark, "lake")
    pages = html.parse_pages(inputs.marked_pages(spark, sf))
    when = F.lit(f"{inputs.DAY}T10:00:00Z")
    good = crawl_events.encode(pages, when)
    good.unionByName(_broken_lines(spark, sf)).write.text(landing)
    source = ingest.file_source(spark, landing)
    ingest.to_lake(source, f"{target}/pages", f"{target}/state", available_now=True).awaitTermination()
    return flat_page_rows(lake.scan(spark, f"{target}/pages"))


@query(
    "stream_rejects",
    """SELECT count(*) AS lines, sum(length(regexp_replace(html, '[\\r\\n]+', ' ', 'g')))::bigint AS chars
FROM pages""",
)
def stream_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Broken lines of an event stream land in a side folder."""
    landing, target = scratch_path(spark, "events"), scratch_path(spark, "rejects")
    pages = inputs.table(spark, sf, "pages")
    empty = F.struct(F.col("url")).alias("e")
    lines = pages.select(F.to_json(empty).alias("value")).unionByName(_broken_lines(spark, sf))
    lines.write.text(landing)
    source = ingest.file_source(spark, landing)
    ingest.rejects_to_files(
        source, f"{target}/lines", f"{target}/state", available_now=True
    ).awaitTermination()
    return spark.read.text(f"{target}/lines").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.length("value")).alias("chars")
    )


@query(
    "stream_dedupe",
    f"""WITH place AS (SELECT {o.domain('url')} AS domain, {o.path('url')} AS real_path,
  page_id % 11 = 0 AS late FROM pages)
SELECT domain, real_path, late, count(*) AS records FROM place GROUP BY ALL""",
)
def stream_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """Redelivered and late page events; the streams are stopped and go on between the turns."""
    landing, base = scratch_path(spark, "deliveries"), scratch_path(spark, "delivered")
    for turn in (0, 1):
        inputs.delivered_events(spark, sf, turn).write.mode("append").parquet(landing)
        source = spark.readStream.schema("value string, arrived timestamp").parquet(landing)
        running = (
            redelivery.to_lake(source, f"{base}/lake", f"{base}/lake-state", available_now=True),
            redelivery.late_to_files(source, f"{base}/late", f"{base}/late-state", available_now=True),
        )
        for stream in running:
            stream.awaitTermination()
    timely = lake.scan(spark, f"{base}/lake").select("domain", "real_path", F.lit(False).alias("late"))
    url = F.col("url")
    late = spark.read.parquet(f"{base}/late").select(
        urls.domain(url).alias("domain"), urls.path(url).alias("real_path"), F.lit(True).alias("late")
    )
    return (
        timely.unionByName(late)
        .groupBy("domain", "real_path", "late")
        .agg(F.count(F.lit(1)).alias("records"))
    )


_EXPIRY_HOURS = 24
_TURNS = ("2024-01-11", "2024-01-21", "2100-01-01")


@query(
    "stream_crawl_queue",
    f"""WITH moment AS (SELECT 'u' || user_id || '-' || (event_id % 7) AS domain,
  event_type IN ('purchase', 'error') AS fetched, date_trunc('second', ts) AS t FROM events),
until AS (SELECT max(t) - INTERVAL 1 HOUR AS mark FROM moment),
fetches AS (SELECT domain, t, lead(t) OVER (PARTITION BY domain ORDER BY t) AS later
  FROM (SELECT DISTINCT domain, t FROM moment WHERE fetched) x),
firsts AS (SELECT domain, min(t) FILTER (NOT fetched) AS link, min(t) FILTER (fetched) AS got
  FROM moment GROUP BY domain),
queued AS (
  SELECT domain, link AS queued_at FROM firsts WHERE link <= got OR (link IS NOT NULL AND got IS NULL)
  UNION ALL SELECT domain, t + INTERVAL {_EXPIRY_HOURS} HOUR FROM fetches
  WHERE later IS NULL OR later > t + INTERVAL {_EXPIRY_HOURS} HOUR)
SELECT domain, queued_at FROM queued, until WHERE queued_at < mark""",
)
def stream_crawl_queue(spark: SparkSession, sf: str) -> DataFrame:
    """Links and fetches as a stream in three turns; the query goes on from its checkpoint."""
    landing, base = scratch_path(spark, "crawl-moments"), scratch_path(spark, "crawl-queue")
    after = None
    for until in _TURNS:
        moments = inputs.crawl_moments(spark, sf).where(F.col("at") < until)
        if after:
            moments = moments.where(F.col("at") >= after)
        moments.write.mode("append").parquet(landing)
        source = spark.readStream.schema("domain string, kind string, at timestamp").parquet(landing)
        crawl_queue.queue_to_files(
            source, f"{base}/queued", f"{base}/state", _EXPIRY_HOURS, available_now=True
        ).awaitTermination()
        after = until
    return spark.read.schema("domain string, queued_at timestamp").parquet(f"{base}/queued")


_REBUILT = f"""{HISTORY}, {TAGGED_FROM_PARSED},
docs AS (SELECT {o.canonical('url')} AS url, coalesce(h1[1], h2[1], domain) AS title,
  {DOC_TEXT} AS text FROM tagged), {o.index_ctes('docs', 'url')}"""


def _rebuilt(spark: SparkSession, sf: str) -> str:
    landing, base = scratch_path(spark, "landing"), scratch_path(spark, "published")
    inputs.history_rows(spark, sf).write.parquet(landing)
    rebuild.rebuild(spark, landing, base)
    return base


@query(
    "rebuild_counts",
    f"""WITH {_REBUILT}
SELECT (SELECT count(*) FROM history) AS pages, (SELECT count(*) FROM latest) AS newest,
  (SELECT count(*) FROM docs) AS documents, (SELECT count(*) FROM tf) AS postings,
  (SELECT sum(tf)::bigint FROM tf) AS occurrences, (SELECT count(*) FROM idf) AS tokens,
  (SELECT max(doc_freq) FROM idf) AS max_doc_freq, (SELECT round(sum(idf), 2) FROM idf) AS idf_sum""",
)
def rebuild_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes of all tables of a full rebuild."""
    t = rebuild.open_tables(spark, _rebuilt(spark, sf))
    one = lambda df, agg: df.agg(agg).scalar()
    n = F.count(F.lit(1))
    return spark.range(1).select(
        one(t.pages, n).alias("pages"),
        one(t.pages.where("is_latest"), n).alias("newest"),
        one(t.mappings, n).alias("documents"),
        one(t.postings, n).alias("postings"),
        one(t.postings, F.sum("tf")).alias("occurrences"),
        one(t.idf, n).alias("tokens"),
        one(t.idf, F.max("doc_freq")).alias("max_doc_freq"),
        F.round(one(t.idf, F.sum("idf")), 2).alias("idf_sum"),
    )


REBUILT_TEXT = "soporte Clou the"
_REBUILT_FILTER = " OR ".join(
    f"starts_with(token, '{t}')" for t in search.terms_of(REBUILT_TEXT)
)


@query(
    "rebuild_search",
    f"""WITH {_REBUILT},
scores AS (SELECT doc_key AS url, sum(tf * idf) AS content_score, count(*) AS matches
  FROM tf JOIN idf USING (token) WHERE {_REBUILT_FILTER} GROUP BY doc_key)
SELECT url, title, round(content_score, 2) AS score, matches, external_refs AS popularity,
  round(pagerank, 4) AS pagerank FROM scores JOIN docs USING (url)
  JOIN (SELECT * FROM scored WHERE is_latest) s USING (url)""",
)
def rebuild_search(spark: SparkSession, sf: str) -> DataFrame:
    """All hits of one query on a rebuilt index."""
    hits = rebuild.all_hits(spark, _rebuilt(spark, sf), REBUILT_TEXT)
    return hits.withColumn("pagerank", F.round("pagerank", 4))


@query(
    "dictionary_rows",
    """SELECT 'keyword' AS kind, p_brand AS tag, p_type AS entry FROM part
UNION ALL SELECT 'keyword', p_brand, p_name FROM part
UNION ALL SELECT 'pattern', '', p_name || ' ([a-z]+)' FROM part""",
)
def dictionary_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Dictionary files, one record per part, written and read as JSON."""
    path = scratch_path(spark, "dictionary")
    inputs.table(spark, sf, "part").select(
        F.create_map("p_brand", F.array("p_type", "p_name")).alias("keywords"),
        F.array(F.concat("p_name", F.lit(" ([a-z]+)"))).alias("patterns"),
    ).write.json(path)
    records = spark.read.schema(config_files.DICTIONARY_SCHEMA).json(path)
    words = config_files.keyword_rows(records).select(
        F.lit("keyword").alias("kind"), "tag", F.col("word").alias("entry")
    )
    patterns = config_files.pattern_rows(records).select(
        F.lit("pattern").alias("kind"), F.lit("").alias("tag"), F.col("pattern").alias("entry")
    )
    return words.unionByName(patterns)


# Words and phrases of the dictionary file that tagging is asked to use.
_WORDS = {"marked": ["systems", "zz"], "unused": [], "never": ["qqqqq"]}
_PATTERNS = ["we offer ([a-z0-9\\s]+)", "data tools"]


@query(
    "dictionary_tags",
    f"""WITH {o.pages_ctes()}, {o.parsed_cte()},
seg AS (SELECT page_id, h1 || h2 || p AS segs FROM parsed),
words AS (SELECT page_id, 'marked' AS tag FROM seg
  WHERE regexp_matches(lower(array_to_string(segs, ' ')), 'systems|zz')),
pieces AS (SELECT page_id, unnest(regexp_extract_all(lower(s), 'we offer ([a-z0-9\\s]+)', 1)) AS phrase
  FROM (SELECT page_id, unnest(segs) AS s FROM seg) x),
cut AS (SELECT page_id, trim(unnest(string_split_regex(trim(phrase, ' ' || chr(9) || chr(10) || chr(11) ||
  chr(12) || chr(13)), '\\s*(?:,|y|and)\\s*')), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS tag
  FROM pieces)
SELECT page_id, tag FROM words UNION SELECT page_id, tag FROM cut
WHERE strlen(tag) > 2 AND len(string_split_regex(tag, '\\s+')) <= 4""",
)
def dictionary_tags(spark: SparkSession, sf: str) -> DataFrame:
    """A dictionary file is written, loaded and used to tag the pages."""
    path = scratch_path(spark, "dictionary")
    words = F.create_map(
        *[c for tag, w in _WORDS.items() for c in (F.lit(tag), F.array(*map(F.lit, w)).cast("array<string>"))]
    )
    spark.range(1).select(
        words.alias("keywords"), F.array(*map(F.lit, _PATTERNS)).alias("patterns")
    ).write.json(path)
    dictionary = config_files.load_dictionary(spark, path)
    parsed = html.parse_pages(inputs.marked_pages(spark, sf))
    segments = tags.text_segments(F.col("content.texts"))
    found = parsed.select(
        "page_id",
        tags.keyword_tags(segments, dictionary.keywords).alias("words"),
        tags.phrase_tags(segments, dictionary.patterns).alias("phrases"),
    )
    return found.select(
        "page_id", F.explode(F.array_distinct(F.concat("words", "phrases"))).alias("tag")
    )


# ---------------------------------------------------------- load-test tables


@query(
    "bench_throughput",
    """SELECT l_quantity::int AS "File_Size_MB", l_returnflag || '_' || l_linestatus AS config,
  round(avg(l_quantity / greatest(l_discount, 0.01::double)), 4) AS mean_mb_s FROM lineitem GROUP BY 1, 2""",
)
def bench_throughput(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as transfers: quantity is the size, discount the duration."""
    storage = inputs.table(spark, sf, "lineitem").select(
        F.col("l_quantity").cast("int").alias("File_Size_MB"),
        F.concat_ws("_", "l_returnflag", "l_linestatus").alias("config"),
        bench_tables.throughput(F.col("l_quantity"), F.col("l_discount")).alias("Throughput_MB_s"),
    )
    return bench_tables.mean_throughput(storage).withColumn("mean_mb_s", F.round("mean_mb_s", 4))


@query(
    "bench_iterations",
    """SELECT (25 * (o_custkey % 12))::int AS "Iterations", o_orderstatus AS config,
  round(avg(floor(o_totalprice)::int), 4) AS mean_sec FROM orders GROUP BY 1, 2""",
)
def bench_iterations(spark: SparkSession, sf: str) -> DataFrame:
    compute = inputs.table(spark, sf, "orders").select(
        (25 * (F.col("o_custkey") % 12)).cast("int").alias("Iterations"),
        F.col("o_orderstatus").alias("config"),
        F.floor("o_totalprice").cast("int").alias("Real_Execution_Time_sec"),
    )
    return bench_tables.mean_time(compute).withColumn("mean_sec", F.round("mean_sec", 4))


@query(
    "bench_load",
    """SELECT event_type AS "Load_Level", 'c' || (user_id % 3) AS config,
  round(avg(value), 4) AS mean_records_per_sec, round(avg(value * 2), 4) AS mean_latency_ms
FROM events GROUP BY 1, 2""",
)
def bench_load(spark: SparkSession, sf: str) -> DataFrame:
    broker = inputs.table(spark, sf, "events").select(
        F.col("event_type").alias("Load_Level"),
        F.concat(F.lit("c"), F.col("user_id") % 3).alias("config"),
        F.col("value").alias("Records_Per_Sec"),
        (F.col("value") * 2).alias("Avg_Latency_ms"),
    )
    means = bench_tables.mean_load(broker)
    return means.select(
        "Load_Level",
        "config",
        F.round("mean_records_per_sec", 4).alias("mean_records_per_sec"),
        F.round("mean_latency_ms", 4).alias("mean_latency_ms"),
    )


@query(
    "bench_csv_union",
    """SELECT o_orderstatus AS "Load_Level", count(*) AS rows, sum(o_custkey)::bigint AS iterations,
  sum(floor(o_totalprice)::int)::bigint AS seconds FROM orders GROUP BY 1""",
)
def bench_csv_union(spark: SparkSession, sf: str) -> DataFrame:
    """Result files with headers in several folders, read by one pattern."""
    base = scratch_path(spark, "results")
    (
        inputs.table(spark, sf, "orders")
        .select(
            F.date_format("o_orderdate", "HH:mm:ss").alias("Timestamp"),
            F.col("o_orderstatus").alias("Load_Level"),
            F.col("o_custkey").alias("Iterations"),
            F.floor("o_totalprice").alias("Real_Execution_Time_sec"),
            F.col("o_orderpriority").alias("folder"),
        )
        .write.partitionBy("folder")
        .csv(base, header=True)
    )
    rows = bench_files.read_results(spark, f"{base}/*/*.csv", bench_files.COMPUTE)
    return rows.groupBy("Load_Level").agg(
        F.count("config").alias("rows"),
        F.sum("Iterations").alias("iterations"),
        F.sum("Real_Execution_Time_sec").alias("seconds"),
    )


@query(
    "bench_labels",
    """SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN 'results'
  ELSE o_custkey || '_' || lower(o_orderstatus) END AS config FROM orders""",
)
def bench_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Configuration labels out of result file names."""
    name = F.when(F.col("o_custkey") % 3 == 0, "results").otherwise(
        F.concat(
            F.lit("M2_spark_2025-01-01_"), "o_custkey", F.lit("_"), F.lower("o_orderstatus")
        )
    )
    path = F.concat(F.lit("file:///data/run_1/"), name, F.lit(".csv"))
    return inputs.table(spark, sf, "orders").select(
        "o_orderkey", bench_files.config_label(path).alias("config")
    )


@query(
    "perf_log_parse",
    """SELECT event_id, event_id AS records, value AS records_per_sec, value * 2 AS mb_per_sec,
  value AS avg_latency_ms, value AS max_latency_ms, (user_id % 50)::double AS p50_latency_ms FROM events""",
)
def perf_log_parse(spark: SparkSession, sf: str) -> DataFrame:
    """Summary lines of a broker test, among other lines."""
    v = F.col("value")
    line = F.concat(
        F.col("event_id"), F.lit(" records sent, "), v, F.lit(" records/sec ("),
        v * 2, F.lit(" MB/sec), "), v, F.lit(" ms avg latency, "), v,
        F.lit(" ms max latency, "), F.col("user_id") % 50, F.lit(" ms 50th, 9 ms 95th."),
    )
    lines = inputs.table(spark, sf, "events").select(
        "event_id", F.explode(F.array(line, F.lit("[WARN] no such topic"))).alias("value")
    )
    return bench_files.parse_perf_lines(lines)
