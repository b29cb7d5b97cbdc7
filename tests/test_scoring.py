"""Scoring of many queries: one row per document, ties, counting inside rows."""

from pyspark.sql import functions as F

from webloom.operators import blocks, index, scoring, search


def test_a_document_is_one_row_whatever_the_queries(spark):
    docs = spark.createDataFrame([(1, "abc ab abd x"), (2, "ab ab"), (3, "zz")], "doc_key long, text string")
    posts = index.document_postings(docs)
    vocabulary = posts.groupBy("token").agg(F.lit(2.0).alias("idf"))
    texts = ["a", "ab", "abc x", "ab x", "a ab abc", "a"] * 20
    queries = spark.createDataFrame(list(enumerate(texts)), "query_id long, text string")
    asked = scoring.wanted(search.query_term_rows(queries))
    assert asked.terms == ["a", "ab", "abc", "x"]
    matches = scoring.longest_terms(vocabulary, asked.terms)
    assert {r.token: asked.terms[r.term] for r in matches.collect()} == {
        "abc": "abc", "ab": "ab", "abd": "ab", "x": "x"
    }
    got = {r.doc_key: [tuple(s) for s in r.sums] for r in scoring.document_sums(posts, matches, 6).collect()}
    assert got == {1: [(1, 4.0, 2), (2, 2.0, 1), (3, 2.0, 1)], 2: [(1, 4.0, 1)]}


def test_ties_and_small_pieces(spark, monkeypatch):
    """Equal documents in many small pieces are told apart by the later levels of the order."""
    monkeypatch.setattr(scoring, "_CELLS", 3)
    docs = spark.range(50).selectExpr("id as doc_key", "'the word' as text")
    mappings = docs.selectExpr(
        "doc_key", "concat('https://s/', doc_key) as url", "'t' as title", "doc_key % 7 as external_refs",
        "cast(doc_key % 3 as double) as pagerank",
    )
    posts = index.document_postings(docs)
    idf = posts.groupBy("token").agg(F.lit(1.5).alias("idf"))
    queries = spark.createDataFrame([(1, "the"), (2, "th w"), (3, "s/4"), (4, None)], "query_id long, text string")
    got = search.search_batch(posts, idf, mappings, queries, k=4).collect()
    order = sorted(range(50), key=lambda d: (-(d % 3), -(d % 7), d))[:4]
    want = [(q, n + 1, f"https://s/{d}") for q in (1, 2) for n, d in enumerate(order)]
    assert sorted((r.query_id, r["rank"], r.url) for r in got) == want


def test_postings_without_a_shuffle(spark):
    docs = spark.createDataFrame([(1, "b a b é"), (2, None), (3, ""), (4, "x")], "doc_key long, text string")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    found = index.document_postings(docs)
    assert sorted(map(tuple, found.collect())) == [("a", 1, 1), ("b", 1, 2), ("x", 4, 1), ("é", 1, 1)]
    assert "Exchange" not in plan(found)
    forward = blocks.forward_rows(docs.withColumn("block", F.lit(0).cast("long")), 1)
    assert "Exchange" not in plan(blocks.postings_of(forward))
    twice = docs.unionByName(docs.where("doc_key = 1"))
    assert ("b", 1, 4) in map(tuple, index.document_postings(twice).collect())
