"""Link graph: in-link counts, edges, transitions, PageRank, scored pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webloom.functions import urls
from webloom.session import cut_lineage, dealt_by, stage_table

DAMPING = 0.85
ITERATIONS = 10
ROUNDS_PER_CUT = 5
# Edges of one source that lie together.
EDGES_PER_PIECE = 1_000_000


def link_rows(latest: DataFrame, links: str = "content.links") -> DataFrame:
    """(src, link): every https and http link of every page, duplicates kept."""
    return latest.select(
        F.col("url").alias("src"),
        F.explode(urls.external_links(F.col(links))).alias("link"),
    )


def external_refs(links: DataFrame) -> DataFrame:
    """Occurrences per target; repeated links and self-links count."""
    return links.groupBy("link").agg(F.count(F.lit(1)).alias("external_refs"))


def vertices(latest: DataFrame) -> DataFrame:
    return latest.select("url").distinct()


def edges(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """Distinct (src, dst) with a known page as dst; self-loops stay.

    Links are not sorted to meet the pages, of which there are far fewer, and are dealt to
    as many tasks as their number needs before repeated ones are dropped.
    """
    pages = nodes.select(F.col("url").alias("dst")).hint("shuffle_hash")
    known = links.select("src", F.col("link").alias("dst")).join(pages, "dst", "left_semi")
    return dealt_by(known.select("src", "dst"), "src", "dst", rows=links.count()).distinct()


def out_degree(edge_rows: DataFrame) -> DataFrame:
    return edge_rows.groupBy("src").agg(F.count(F.lit(1)).alias("out_degree"))


def transitions(edge_rows: DataFrame, degrees: DataFrame | None = None) -> DataFrame:
    """(src, dst, weight) with weight 1 / out-degree."""
    degrees = out_degree(edge_rows) if degrees is None else degrees
    return edge_rows.join(degrees.hint("shuffle_hash"), "src").select(
        "src", "dst", (F.lit(1.0) / F.col("out_degree")).alias("weight")
    )


def node_key(url: str) -> Column:
    """128-bit key of a URL, shorter than it and without a clash at any crawl's size."""
    return F.unhex(F.md5(F.col(url)))


def _pieces(degree: Column, edges_per_piece: int) -> Column:
    return F.ceil(degree / F.lit(edges_per_piece)).cast("int")


def short_key(url: str) -> Column:
    """64-bit key of a URL, null for null; two URLs of a very large crawl may share one."""
    return F.when(F.col(url).isNotNull(), F.xxhash64(url))


def pagerank(
    nodes: DataFrame,
    edge_rows: DataFrame,
    iterations: int = ITERATIONS,
    damping: float = DAMPING,
    rounds_per_cut: int = ROUNDS_PER_CUT,
    edges_per_piece: int = EDGES_PER_PIECE,
    short: Callable[[str], Column] = short_key,
) -> DataFrame:
    """(url, pagerank): every rank starts at 1; mass of pages without out-links is lost.

    ``nodes`` are distinct URLs and ``edge_rows`` distinct pairs of them. Rounds
    work on keys instead of URLs: ``short`` ones, which Spark sums several times faster,
    unless two nodes share one, else 128-bit ones. The out-degree rides on the rank side
    as a share (rank / out-degree), so an edge is only a pair of keys.

    The targets of a source are filed as lists of about ``edges_per_piece``, numbered
    per source, and a rank row is repeated for each of its source's lists; nearly always
    that is one. So no source, however many links it has, fills a task, and a round joins
    lists and not edges. They are partitioned and sorted once. A round shuffles the shares
    to the pieces and the contributions, summed inside each task first, to the
    targets; a cut of the lineage adds no shuffle to that.
    """
    base = 1.0 - damping
    spark = edge_rows.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    nodes = stage_table(nodes.select("url"), "pagerank-nodes")
    known = nodes.where(F.col("url").isNotNull())
    clash = known.select(short("url")).distinct().count() < known.distinct().count()
    key = node_key if clash else short
    pairs = edge_rows.select(key("src").alias("src"), key("dst").alias("dst"))
    pairs = stage_table(pairs, "pagerank-edges")
    degrees = stage_table(out_degree(pairs), "pagerank-degrees")

    # Cached on top of staged files: a lost executor costs a short rebuild.
    node_rows = (
        nodes.withColumn("id", key("url"))
        .join(degrees.withColumnRenamed("src", "id"), "id", "left")
        .repartition(partitions, "id")
        .sortWithinPartitions("id")
        .persist()
    )
    wide = degrees.where(F.col("out_degree") > edges_per_piece)
    piece = F.pmod(
        F.xxhash64("dst"), F.coalesce(_pieces(F.col("out_degree"), edges_per_piece), F.lit(1))
    ).cast("int")
    filed = (
        pairs.join(wide, "src", "left")
        .select("src", piece.alias("piece"), "dst")
        .repartition(partitions, "src", "piece")
        .groupBy("src", "piece")
        .agg(F.collect_list("dst").alias("targets"))
        .sortWithinPartitions("src", "piece")
        .persist()
    )

    ranks = node_rows.withColumn("rank", F.lit(1.0))
    for i in range(1, iterations + 1):
        count = _pieces(F.col("out_degree"), edges_per_piece)
        shares = ranks.where(F.col("out_degree").isNotNull()).select(
            F.col("id").alias("src"),
            (F.col("rank") / F.col("out_degree")).alias("share"),
            F.explode(F.sequence(F.lit(0), count - 1)).alias("piece"),
        )
        lists = shares.join(filed, ["src", "piece"])
        sent = lists.select(F.explode("targets").alias("dst"), "share")
        received = sent.groupBy("dst").agg(F.sum("share").alias("received"))
        ranks = node_rows.join(received, node_rows["id"] == received["dst"], "left").select(
            "id",
            "url",
            "out_degree",
            (F.lit(base) + F.lit(damping) * F.coalesce("received", F.lit(0.0))).alias("rank"),
        )
        if i % rounds_per_cut == 0 or i == iterations:
            ranks = cut_lineage(ranks)
    for cached in (node_rows, filed):
        cached.unpersist()
    return ranks.select("url", F.col("rank").alias("pagerank"))


def attach_scores(
    history: DataFrame,
    days: DataFrame,
    refs: DataFrame,
    ranks: DataFrame,
    day: str = "date",
    damping: float = DAMPING,
) -> DataFrame:
    """In-link count, rank and ``is_latest`` on every row of a deduped history.

    Unknown pages get 0 and 1 - damping. ``days`` are the distinct (url, day) of
    the history, read on their own because they are narrow: the scores are spread
    over them, and the wide history, which the dedupe left partitioned by the same
    keys, joins where it is and is not shuffled again. A URL has one row per day,
    which bounds the rows per URL.
    """
    history = history.drop("external_refs", "pagerank", "is_latest")
    newest = F.max(day).over(Window.partitionBy("url"))
    scored_days = (
        days.select("url", day, (F.col(day) == newest).alias("is_latest"))
        .join(ranks, "url", "left")
        .join(refs.withColumnRenamed("link", "url"), "url", "left")
        .select(
            "url",
            day,
            F.coalesce("external_refs", F.lit(0)).alias("external_refs"),
            F.coalesce("pagerank", F.lit(1.0 - damping)).alias("pagerank"),
            "is_latest",
        )
    )
    return history.join(scored_days, ["url", day], "left").select(
        *history.columns, "external_refs", "pagerank", "is_latest"
    )
