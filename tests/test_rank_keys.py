"""PageRank on short keys, and on long ones where two nodes share a short key."""

from pyspark.sql import functions as F

from webloom.operators import graph

PAIRS = [("a", "b"), ("b", "c"), ("c", "a"), ("a", "c"), ("d", "a"), ("d", "d"), ("e", "a")]


def ranks_of(spark, **options):
    nodes = spark.createDataFrame([(n,) for n in "abcdef"], "url string")
    edges = spark.createDataFrame(PAIRS, "src string, dst string")
    return {r.url: round(r.pagerank, 9) for r in graph.pagerank(nodes, edges, **options).collect()}


def plain_ranks():
    ranks = dict.fromkeys("abcdef", 1.0)
    degree = {s: sum(s == x for x, _ in PAIRS) for s in ranks}
    for _ in range(graph.ITERATIONS):
        got = dict.fromkeys(ranks, 0.0)
        for s, d in PAIRS:
            got[d] += ranks[s] / degree[s]
        ranks = {n: 0.15 + 0.85 * got[n] for n in ranks}
    return {n: round(r, 9) for n, r in ranks.items()}


def test_nodes_that_share_a_short_key_stay_apart(spark):
    shared = lambda url: F.ascii(F.col(url)).cast("bigint") % 2
    assert ranks_of(spark, short=shared) == plain_ranks()


def test_lists_of_any_size(spark):
    for size in (1, 2, 1_000_000):
        assert ranks_of(spark, edges_per_piece=size) == plain_ranks()


def test_short_key_of_nothing(spark):
    df = spark.createDataFrame([("a",), (None,)], "u string").select(graph.short_key("u").alias("k"))
    assert [r.k is None for r in df.collect()] == [False, True]
