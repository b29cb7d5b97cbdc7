"""Inverted index: postings, mappings, document frequencies, IDF."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.functions import text as txt
from webloom.session import dealt_by, stage_table

DEFAULT_RANK = 0.15
# A posting comes from at least so many bytes of text, on average.
BYTES_PER_POSTING = 8
# Documents per block of the nested index: the most entries one array can get.
BLOCK_DOCS = 4096


def doc_key(url: Column) -> Column:
    return F.xxhash64(url)


def clashing_keys(urls: DataFrame, hash_of: Callable[[Column], Column] = doc_key) -> DataFrame:
    """(url, doc_key) of the URLs whose hash another one has, too.

    Of the URLs (distinct, in ``url``) with one hash the smallest keeps it. Each other
    one gets the first of its later hashes (of the URL with a number behind it)
    that nobody has. The result is tiny: 64-bit hashes begin to clash at some
    thousand million URLs, a pair at a time.
    """
    hashed = urls.select("url", hash_of(F.col("url")).alias("doc_key"))
    first = hashed.groupBy("doc_key").agg(
        F.min("url").alias("first"), F.count(F.lit(1)).alias("n")
    ).where("n > 1")
    open_urls = stage_table(
        hashed.join(first, "doc_key").where("url != first").select("url"), "clashing-urls"
    )
    given = None
    turn = 0
    while not open_urls.isEmpty():
        turn += 1
        numbered = F.xxhash64(F.lit(turn), F.col("url"))
        tried = open_urls.select("url", numbered.alias("doc_key"))
        taken = hashed.select("doc_key") if given is None else hashed.select("doc_key").unionByName(
            given.select("doc_key")
        )
        lowest = tried.groupBy("doc_key").agg(F.min("url").alias("url"))
        won = stage_table(lowest.join(taken, "doc_key", "left_anti").select("url", "doc_key"), "keys")
        given = won if given is None else given.unionByName(won)
        open_urls = stage_table(open_urls.join(won, "url", "left_anti"), "clashing-urls")
    return open_urls.select("url", F.lit(0).cast("bigint").alias("doc_key")) if given is None else given


def with_doc_keys(
    pages: DataFrame, hash_of: Callable[[Column], Column] = doc_key
) -> DataFrame:
    """``pages`` (url, …) with a ``doc_key`` that no two URLs share."""
    clashing = clashing_keys(pages.select("url").distinct(), hash_of)
    return pages.join(clashing, "url", "left").withColumn(
        "doc_key", F.coalesce("doc_key", hash_of(F.col("url")))
    )


def with_score_columns(pages: DataFrame) -> DataFrame:
    """In-link count and rank with their defaults where the lake has none yet."""
    for name, default in (("external_refs", F.lit(0).cast("bigint")), ("pagerank", F.lit(DEFAULT_RANK))):
        known = F.coalesce(F.col(name), default) if name in pages.columns else default
        pages = pages.withColumn(name, known)
    return pages


def _keyed(latest: DataFrame) -> DataFrame:
    """Pages with a document key: their own, or the plain hash."""
    if "doc_key" in latest.columns:
        return latest
    return latest.withColumn("doc_key", doc_key(F.col("url")))


def page_documents(latest: DataFrame) -> DataFrame:
    """(doc_key, text, pagerank) of the newest version of each page."""
    return with_score_columns(_keyed(latest)).select(
        "doc_key",
        txt.document_text(
            F.col("domain"),
            F.col("real_path"),
            F.col("url"),
            F.col("tags"),
            F.col("content.texts"),
        ).alias("text"),
        "pagerank",
    )


def doc_mappings(latest: DataFrame) -> DataFrame:
    """What a hit shows: title is the first h1, else the first h2, else the domain.

    One row per page of ``latest``, which has one row per URL.
    """
    return with_score_columns(_keyed(latest)).select(
        "doc_key",
        "url",
        F.coalesce(
            F.get("content.texts.h1", F.lit(0)),
            F.get("content.texts.h2", F.lit(0)),
            F.col("domain"),
        ).alias("title"),
        "external_refs",
        "pagerank",
    )


def tokens(docs: DataFrame, token_chars: str = txt.TOKEN_CHARS) -> DataFrame:
    """One row per occurrence: token, and the documents' columns but the text."""
    others = [c for c in docs.columns if c != "text"]
    return docs.select(
        *others, F.explode(txt.token_array(F.col("text"), token_chars)).alias("token")
    )


def postings(token_rows: DataFrame) -> DataFrame:
    """(token, doc_key, tf), with the document's ``pagerank`` if the rows have it.

    Counts are summed within a task before the shuffle; rows that are dealt out by
    ``doc_key`` are counted where they lie.
    """
    rank = [F.first("pagerank").alias("pagerank")] if "pagerank" in token_rows.columns else []
    return token_rows.groupBy("token", "doc_key").agg(F.count(F.lit(1)).alias("tf"), *rank)


def document_postings(docs: DataFrame, token_chars: str = txt.TOKEN_CHARS) -> DataFrame:
    """``postings`` of ``docs(doc_key, text, …)``, counted inside each row without a shuffle.

    Only if a key occurs in several rows, which a look at the keys alone tells, are
    their counts added up by one.
    """
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(*others, F.lower("text").alias("_text"))
    rest = [c for c in others if c != "doc_key"]
    found = txt.count_words(rows, "_text", f"[{token_chars}]+").select("token", "doc_key", "tf", *rest)
    keys = docs.groupBy("doc_key").agg(F.count(F.lit(1)).alias("n"))
    if keys.where("n > 1").isEmpty():
        return found
    rank = [F.first("pagerank").alias("pagerank")] if "pagerank" in others else []
    return found.groupBy("token", "doc_key").agg(F.sum("tf").alias("tf"), *rank)


def doc_freq(docs: DataFrame, token_chars: str = txt.TOKEN_CHARS) -> DataFrame:
    """Documents per token straight from the texts, with a single shuffle by token.

    A document is one row, so its distinct tokens need no shuffle of their own.
    """
    distinct = F.array_distinct(txt.token_array(F.col("text"), token_chars))
    return doc_freq_of(docs.select(F.explode(distinct).alias("token")))


def doc_freq_of(index: DataFrame) -> DataFrame:
    """Documents per token from rows of distinct (token, document)."""
    return index.groupBy("token").agg(F.count(F.lit(1)).alias("doc_freq"))


def idf(freqs: DataFrame, corpus: DataFrame) -> DataFrame:
    """ln((N + 1) / (doc_freq + 1)); N is the row count of ``corpus``.

    N is a scalar subquery: Spark counts it inside the same query.
    """
    n = corpus.agg(F.count(F.lit(1))).scalar()
    return freqs.withColumn("idf", F.log((n + 1) / (F.col("doc_freq") + 1)))


def nested_index(
    index: DataFrame,
    block: Column | None = None,
    extra: tuple[str, ...] = (),
    rows: int | None = None,
) -> DataFrame:
    """(token, block, docs): the postings of a token as arrays, one per document block.

    A block holds at most ``BLOCK_DOCS`` documents, so no array outgrows it even
    for a token that occurs everywhere. The default block suits dense integer
    keys; hashed keys need ``hash_block``. ``rows``: about how many postings there are; they are
    then dealt to as many tasks as that needs.
    """
    block = F.floor(F.col("doc_key") / BLOCK_DOCS) if block is None else block
    entry = F.struct("doc_key", "tf", *extra)
    flat = index.select("token", block.cast("bigint").alias("block"), entry.alias("entry"))
    if rows is not None:
        flat = dealt_by(flat, "token", "block", rows=rows)
    return flat.groupBy("token", "block").agg(F.array_sort(F.collect_list("entry")).alias("docs"))


def hash_block(mappings: DataFrame) -> Column:
    """Block of a hashed key: as many blocks as the corpus needs."""
    n = mappings.agg(F.count(F.lit(1))).scalar()
    return F.pmod(F.col("doc_key"), F.ceil(n / BLOCK_DOCS * 2) + 1)


def index_sample(index: DataFrame, token: str | None = None, limit: int = 20) -> DataFrame:
    """A look into the index: all of it or one exact token, first ``limit`` rows."""
    if token is not None:
        index = index.where(F.col("token") == token)
    return index.orderBy(*[c for c in ("token", "block", "doc_key") if c in index.columns]).limit(limit)


def write_sorted(index: DataFrame, path: str, keys: tuple[str, ...] = ("token", "doc_key")) -> None:
    """Write sorted by token so that a prefix filter skips files and row groups.

    The document key takes part in the range split, so a token that fills many
    partitions' worth of rows gets many partitions.
    """
    (
        index.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .write.mode("overwrite")
        .parquet(path)
    )
