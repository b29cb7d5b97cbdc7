"""Postings in blocks of documents, with what a block can contribute at most.

A block holds about ``BLOCK_DOCS`` documents of about the same length, because a token's
frequency grows with it: documents of one size class are dealt to its blocks by hash, so
neither a sort nor a shuffle of the texts is needed. ``block_bounds`` has the greatest
frequency per token and block, so a search knows what a block is worth without opening it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.functions import text as txt

BLOCK_DOCS = 128
# Size classes per doubling of the size.
CLASSES = 4
FORWARD = "seq bigint, doc_key bigint, block bigint, length bigint, tokens array<string>"
POSTING = "token string, seq bigint, block bigint, doc_key bigint, tf bigint"


def with_blocks(docs: DataFrame, size: Column) -> DataFrame:
    """``docs`` (doc_key, …) with their ``block``. The driver sees one count per size class."""
    size_class = F.floor(F.log2(F.coalesce(size, F.lit(0)) + F.lit(1.0)) * CLASSES)
    counts = docs.groupBy(size_class.alias("_class")).agg(F.count(F.lit(1)).alias("n")).collect()
    buckets = docs.sparkSession.createDataFrame(
        [(r["_class"], -(-r["n"] // BLOCK_DOCS)) for r in counts], "_class bigint, _buckets bigint"
    )
    within = F.pmod(F.xxhash64("doc_key"), F.col("_buckets"))
    # A few hundred rows.
    return (
        docs.withColumn("_class", size_class)
        .join(F.broadcast(buckets), "_class")
        .withColumn("block", F.shiftleft("_class", 40) + within)
        .drop("_class", "_buckets")
    )


def forward_rows(docs: DataFrame, seq: int, token_chars: str = txt.TOKEN_CHARS) -> DataFrame:
    """``docs`` (doc_key, text, block, …) with ``seq``, the sorted ``tokens`` of the text and their
    number ``length``; equal tokens lie together, which files store well."""
    others = [c for c in docs.columns if c != "text"]
    tokens = F.coalesce(txt.token_array(F.col("text"), token_chars), F.array().cast("array<string>"))
    return docs.select(
        *others, F.lit(seq).cast("bigint").alias("seq"), F.sort_array(tokens).alias("tokens")
    ).withColumn("length", F.size("tokens").cast("bigint"))


def postings_of(forward: DataFrame) -> DataFrame:
    """(token, seq, block, doc_key, tf), counted inside each row."""
    words = F.array_join("tokens", "\0").alias("_words")
    found = txt.count_words(forward.select("seq", "block", "doc_key", words), "_words", "[^\\0]+")
    return found.select("token", "seq", "block", "doc_key", "tf")


def block_bounds(postings: DataFrame) -> DataFrame:
    """(token, seq, block, n, max_tf) of stored postings."""
    return postings.groupBy("token", "seq", "block").agg(
        F.count(F.lit(1)).alias("n"), F.max("tf").alias("max_tf")
    )
