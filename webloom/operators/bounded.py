"""Batch search that opens only posting blocks which can matter.

What a block can add to a score is at most the sum, over a query's tokens, of IDF times the
block's greatest frequency. No document has all of these at once: with L tokens in its longest
document, a block gives at most t * L plus the same sum with IDF lessened by t, for any t
(``LEVELS``), since a document's frequencies add up to L at most. And no document gives more than the weight
of all its tokens, whose maximum per block is kept with the IDF (``block_weights``). Blocks with the greatest bounds are opened first; the k-th best
score in them is a score to beat, and of all other blocks only those are opened whose bound
reaches it. Bounds are per block, so no pair of a query and a document is formed for what
stays closed for all queries. Documents whose address is the query come before all scores; their blocks
are opened in any case. The hits are those of ``search.search_batch``, row for row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webloom.operators import scoring, search
from webloom.session import dealt_by, stage_table

BLOCK = ["seq", "block"]
# Values of t for the bound.
LEVELS = (0.0, 0.5, 1.0, 1.5, 2.0, 3.0, 4.0, 5.0, 6.0, 8.0)
# The blocks opened first hold so many times k documents: the more, the higher the score to beat.
FIRST = 6
# A score that is rounded up may exceed its bound by that much.
_SLACK = search.SCORE_SLACK


@dataclass
class Found:
    """``hits``; ``bounds``: every (query_id, block) with a match; ``first`` and ``second``: those
    that were opened."""

    hits: DataFrame
    bounds: DataFrame
    first: DataFrame
    second: DataFrame


def block_weights(index: DataFrame, idf: DataFrame) -> DataFrame:
    """(seq, block, weight): greatest sum of tf * idf of a document; as long-lived as the IDF."""
    weighed = index.join(idf.select("token", "idf"), "token")
    per_doc = weighed.groupBy(*BLOCK, "doc_key").agg(
        F.sum(F.col("tf") * F.col("idf")).alias("weight")
    )
    return per_doc.groupBy(*BLOCK).agg(F.max("weight").alias("weight"))


def _bounds(
    block_table: DataFrame, matches: DataFrame, asked: scoring.Wanted, limits: DataFrame
) -> DataFrame:
    """(query_id, seq, block, bound, least): ``least`` is a number of documents that match at least.

    Rows move narrow, to their block; all sums are taken there, per longest term first.
    """
    spark = block_table.sparkSession
    parts = F.broadcast(spark.createDataFrame(scoring.beginnings(asked.terms), "term int, part int"))
    of_query = F.broadcast(spark.createDataFrame(asked.pairs, "query_id bigint, part int"))
    over = lambda t: F.col("max_tf") * F.greatest(F.col("idf") - t, F.lit(0.0))
    met = block_table.join(matches.hint("shuffle_hash"), "token").select(*BLOCK, "term", "max_tf", "idf", "n")
    added = [F.sum(f"over{k}").alias(f"over{k}") for k in range(len(LEVELS))]
    whole = (
        dealt_by(met, *BLOCK, rows=block_table.count())
        .groupBy(*BLOCK, "term")
        .agg(*[F.sum(over(t)).alias(f"over{k}") for k, t in enumerate(LEVELS)], F.max("n").alias("least"))
        .join(parts, "term")
        .groupBy(*BLOCK, "part")
        .agg(*added, F.max("least").alias("least"))
        .join(of_query, "part")
        .groupBy("query_id", *BLOCK)
        .agg(*added, F.max("least").alias("least"))
    )
    each = [F.col(f"over{k}") + F.lit(t) * F.col("length") for k, t in enumerate(LEVELS)]
    bound = F.least("weight", *each)
    return whole.join(limits, BLOCK).select("query_id", *BLOCK, bound.alias("bound"), "least")


def _first_blocks(bounds: DataFrame, k: int) -> DataFrame:
    """Blocks with the greatest bounds that together have ``k`` matching documents.

    Each has one at least, so ``k`` blocks of a query are enough.
    """
    w = Window.partitionBy("query_id").orderBy(F.desc("bound"), *BLOCK)
    best = bounds.withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= k)
    before = F.coalesce(F.sum("least").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return best.withColumn("before", before).where(F.col("before") < k).select("query_id", *BLOCK)


def search_batch(
    index: DataFrame,
    block_table: DataFrame,
    places: DataFrame,
    weights: DataFrame | None,
    idf: DataFrame,
    mappings: DataFrame,
    queries: DataFrame,
    k: int = search.TOP_K,
    counting=lambda opened: opened,
) -> Found:
    """First ``k`` hits for every query of ``queries(query_id, text)``.

    ``index``: stored postings; ``block_table``: their ``blocks.block_bounds``, stored; ``places``: (doc_key, seq, block, length) of the documents;
    ``weights``: ``block_weights`` of this index and IDF, stored, or None where they would cost
    more than they save, as for an index that is searched once;
    ``counting`` drops opened postings (doc_key, seq, …) of documents that no longer count.
    """
    per_text = search.texts_of(queries)
    texts = per_text.select(F.col("text_id").alias("query_id"), "text")
    asked = scoring.wanted(search.query_term_rows(texts))
    matches = stage_table(scoring.longest_terms(idf.select("token", "idf"), asked.terms), "term-tokens")
    n_postings = index.count()
    limits = places.groupBy(*BLOCK).agg(F.max("length").alias("length"))
    if weights is None:
        limits = limits.withColumn("weight", F.lit(None).cast("double"))
    else:
        limits = limits.join(weights, BLOCK)
    bounds = stage_table(_bounds(block_table, matches, asked, limits), "block-bounds")
    exact = search.exact_pairs(texts, asked, mappings)

    def opened(chosen: DataFrame) -> DataFrame:
        """Contenders of all queries in the chosen blocks."""
        rows = counting(index.join(chosen, BLOCK, "left_semi"))
        sums = scoring.document_sums(rows, matches, n_postings)
        return stage_table(search.contending(sums, mappings, exact, asked, k), "contenders")

    forced = exact.join(places, "doc_key").select("query_id", *BLOCK)
    forced = forced.join(bounds.select("query_id", *BLOCK), ["query_id", *BLOCK], "left_semi")
    first = stage_table(_first_blocks(bounds, FIRST * k).unionByName(forced).distinct(), "first-blocks")
    first_blocks = stage_table(first.select(*BLOCK).distinct(), "opened-blocks")
    seen = opened(first_blocks)
    score = F.round("content_score", search.SCORE_DIGITS)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"))
    kth = (
        seen.select("query_id", score.alias("score"))
        .withColumn("nth", F.row_number().over(w))
        .where(F.col("nth") == k)
        .select("query_id", F.col("score").alias("kth"))
    )
    second = stage_table(
        bounds.join(first, ["query_id", *BLOCK], "left_anti")
        .join(kth, "query_id", "left")
        .where(F.col("kth").isNull() | (F.col("bound") + _SLACK >= F.col("kth")))
        .select("query_id", *BLOCK),
        "second-blocks",
    )
    # What the first blocks hold is known for all queries.
    others = second.select(*BLOCK).distinct().join(first_blocks, BLOCK, "left_anti")
    found = seen.unionByName(opened(stage_table(others, "opened-blocks")))
    return Found(search.best_hits(found, mappings, texts, per_text, queries, k), bounds, first, second)
