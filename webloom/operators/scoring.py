"""Scores of documents for a table of queries, without a row per pair that cannot matter.

The terms that a token starts with are all beginnings of the longest of them. So a token
counts for one term only, its longest, and a document is the sums of its tokens per
longest term: one row, whatever the number of queries. Tasks add these sums up per
query with numpy and send on what reaches the k-th best score they have met.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.session import dealt_by, stage_table

SUMS = "array<struct<term:int,weight:double,n:bigint>>"
# Pairs of a document and a query, or of a sum and a query, that are in memory at once.
_CELLS = 2_000_000


@dataclass
class Wanted:
    """The queries' terms, some bytes per query, as they are sent to all tasks.

    ``pairs``: (query_id, number of its term). Queries with term ``t`` or a beginning of it are
    ``ids[members[offsets[t]:offsets[t + 1]]]``.
    """

    terms: list[str]
    pairs: list[tuple[int, int]]
    offsets: np.ndarray
    members: np.ndarray
    ids: np.ndarray


def wanted(term_rows: DataFrame) -> Wanted:
    """``term_rows(query_id, term)``: of one query no term is the beginning of another."""
    asked: dict[str, list[int]] = {}
    numbers: dict[int, int] = {}
    for row in term_rows.collect():
        number = numbers.setdefault(row["query_id"], len(numbers))
        asked.setdefault(row["term"], []).append(number)
    terms = sorted(asked)
    ids = list(numbers)
    lists = [[q for n in range(1, len(t) + 1) for q in asked.get(t[:n], ())] for t in terms]
    return Wanted(
        terms,
        [(q, at) for at, t in enumerate(terms) for q in (ids[n] for n in asked[t])],
        np.cumsum([0, *map(len, lists)]).astype(np.int64),
        np.array([q for one in lists for q in sorted(one)], np.int64),
        np.array(ids, np.int64),
    )


def beginnings(terms: list[str]) -> list[tuple[int, int]]:
    """(term, part): numbers of terms and of the terms that are their beginnings, themselves included."""
    number = {t: at for at, t in enumerate(terms)}
    return [(at, number[t[:n]]) for t, at in number.items() for n in range(1, len(t) + 1) if t[:n] in number]


def longest_terms(vocabulary: DataFrame, terms: list[str]) -> DataFrame:
    """(token, term, idf) of ``vocabulary(token, idf)``: the number of the longest term."""
    numbered = vocabulary.sparkSession.createDataFrame(list(enumerate(terms)), "term int, word string")
    lengths = F.array(*[F.lit(n) for n in sorted({len(t) for t in terms})]).cast("array<int>")
    cuts = vocabulary.select(
        "token", "idf", F.explode(F.filter(lengths, lambda n: n <= F.length("token"))).alias("_n")
    )
    found = cuts.withColumn("word", F.col("token").substr(F.lit(1), F.col("_n"))).join(F.broadcast(numbered), "word")
    longest = F.max(F.struct("_n", "term"))["term"]
    return found.groupBy("token").agg(longest.alias("term"), F.first("idf").alias("idf"))


def document_sums(index: DataFrame, matches: DataFrame, rows: int) -> DataFrame:
    """(doc_key, sums): tf * idf and matched tokens of each document per longest term.

    ``index``: at most ``rows`` postings (token, doc_key, tf). A posting moves to its token's frequency
    and to its document, whatever the number of queries. The frequencies are the smaller
    side by far and need no sort; frequent tokens are on the left, where they are split.
    """
    weighted = index.select("token", "doc_key", "tf").join(matches.hint("shuffle_hash"), "token")
    moved = weighted.select("doc_key", "term", (F.col("tf") * F.col("idf")).alias("weight"))
    per_term = dealt_by(moved, "doc_key", rows=rows).groupBy("doc_key", "term").agg(
        F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("n")
    )
    return per_term.groupBy("doc_key").agg(
        F.array_sort(F.collect_list(F.struct("term", "weight", "n"))).alias("sums")
    )


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges that begin at ``starts``."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _pieces(per_doc: np.ndarray, n_queries: int) -> Iterator[tuple[int, int]]:
    """Ranges of documents with few enough pairs; one document at least."""
    cost = np.cumsum(np.maximum(per_doc, n_queries))
    first, used = 0, 0
    while first < len(cost):
        last = max(int(np.searchsorted(cost, used + _CELLS, "right")), first + 1)
        yield first, last
        first, used = last, cost[last - 1]


def _contending(batches: Iterator[pa.RecordBatch], asked: Wanted, k: int, slack: float):
    n_queries = len(asked.ids)
    number = {int(q): at for at, q in enumerate(asked.ids)}
    best = np.full((k, n_queries), -np.inf)
    for batch in batches:
        sums, exact = batch["sums"], batch["exact"]
        bounds = sums.offsets.to_numpy().astype(np.int64)
        inner = sums.values
        term, weight, n = (inner.field(f).to_numpy(zero_copy_only=False) for f in ("term", "weight", "n"))
        sizes = (asked.offsets[1:] - asked.offsets[:-1])[term]
        before = np.concatenate([[0], np.cumsum(sizes)])
        for first, last in _pieces(before[bounds[1:]] - before[bounds[:-1]], n_queries):
            part = slice(bounds[first], bounds[last])
            n_docs, size = last - first, sizes[part]
            doc = np.repeat(np.arange(n_docs), np.diff(bounds[first : last + 1]))
            cell = np.repeat(doc, size) * n_queries + asked.members[_ranges(asked.offsets[term[part]], size)]
            table = lambda x: np.bincount(cell, np.repeat(x, size), n_docs * n_queries)
            score = table(weight[part]).reshape(n_docs, n_queries)
            matches = table(n[part]).reshape(n_docs, n_queries)
            met = matches > 0
            both = np.concatenate([best, np.where(met, score, -np.inf)])
            best = -np.partition(-both, k - 1, axis=0)[:k]
            keep = met & (score >= best[k - 1] - slack)
            for at in np.flatnonzero(exact[first:last].is_valid().to_numpy(zero_copy_only=False)):
                for query in exact[first + int(at)].as_py():
                    keep[at, number[query]] = met[at, number[query]]
            row, query = np.nonzero(keep)
            if len(row):
                kept = batch.slice(first, n_docs).take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(asked.ids[query]), pa.array(score[row, query]),
                     pa.array(matches[row, query].astype(np.int64)),
                     *[kept[c] for c in batch.schema.names if c not in ("sums", "exact")]],
                    ["query_id", "content_score", "matches",
                     *[c for c in batch.schema.names if c not in ("sums", "exact")]],
                )


def contenders(
    documents: DataFrame, exact: DataFrame, asked: Wanted, k: int, slack: float
) -> DataFrame:
    """(query_id, content_score, matches, …) of the pairs that may be among a query's first ``k``.

    ``documents(doc_key, sums, …)``; ``exact(query_id, doc_key)``: pairs that come before any
    score. What a task sends on has the k-th best score of the task so far, or misses it
    by ``slack``, or is exact.
    """
    marked = exact.groupBy("doc_key").agg(F.collect_set("query_id").alias("exact"))
    rows = documents.join(marked, "doc_key", "left")
    others = [f"{f.name} {f.dataType.simpleString()}" for f in documents.schema if f.name != "sums"]
    schema = ", ".join(["query_id bigint, content_score double, matches bigint", *others])
    if not len(asked.ids):
        return documents.sparkSession.createDataFrame([], schema)
    return rows.mapInArrow(lambda batches: _contending(batches, asked, k, slack), schema)
