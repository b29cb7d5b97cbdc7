"""Tasks get a bounded number of rows, however many there are."""

from pyspark.sql import functions as F

from webloom import session
from webloom.functions import text as txt
from webloom.operators import blocks, graph, index


def test_edges_are_dealt_to_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    links = spark.range(4_000).selectExpr("concat('a', id % 2000) as src", "concat('b', id % 40) as link")
    nodes = spark.range(30).selectExpr("concat('b', id) as url")
    found = graph.edges(links, nodes)
    assert found.rdd.getNumPartitions() == 40
    want = {(f"a{n % 2000}", f"b{n % 40}") for n in range(4_000) if n % 40 < 30}
    assert sorted(map(tuple, found.collect())) == sorted(want)
    assert "SortMergeJoin" not in graph.transitions(found)._jdf.queryExecution().executedPlan().toString()
    weights = {r.weight for r in graph.transitions(found).collect()}
    assert weights == {1.0 / len({d for s, d in want if s == "a0"})}


def test_postings_of_the_nested_index_are_dealt_to_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    posts = spark.range(3_000).selectExpr("concat('t', id % 50) as token", "id as doc_key", "1L as tf")
    nested = index.nested_index(posts, rows=3_000)
    assert nested.rdd.getNumPartitions() == 30
    assert nested.agg(F.sum(F.size("docs"))).first()[0] == 3_000


def test_words_are_counted_without_functions_interpreted_word_by_word(spark, monkeypatch):
    monkeypatch.setattr(txt, "ROWS_AT_ONCE", 7)
    text = "case when id % 5 = 0 then null when id % 5 = 1 then ' .,' else repeat('Á b-b c ', int(id)) end as text"
    docs = spark.range(40).selectExpr("id as doc_key", "id / 2 as pagerank", text)
    want = {
        (token, n, times * n, n / 2)
        for n in range(40)
        if n % 5 > 1
        for token, times in (("á", 1), ("b", 2), ("c", 1))
    }
    found = index.document_postings(docs)
    assert found.columns == ["token", "doc_key", "tf", "pagerank"]
    assert sorted(map(tuple, found.collect())) == sorted(want)
    stored = blocks.postings_of(blocks.forward_rows(docs.withColumn("block", F.lit(3).cast("long")), 1))
    assert sorted((r.token, r.doc_key, r.tf, r.doc_key / 2) for r in stored.collect()) == sorted(want)
    assert {(r.seq, r.block) for r in stored.collect()} == {(1, 3)}
    for rows in (found, stored):
        assert "lambda" not in rows._jdf.queryExecution().executedPlan().toString()
