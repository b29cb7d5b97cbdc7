"""Segments, bounded batch search and dictionary join against plain versions."""

import math
import os
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from webloom.functions import text as txt
from webloom.operators import blocks, bounded, dictionary, index, search, segments
from webloom.session import stage_table

DOCS = "doc_key long, text string, title string"
TOKEN = re.compile(f"[{txt.TOKEN_CHARS}]+")


def prose(rng, n, vocabulary=60):
    return " ".join(f"w{min(rng.randrange(vocabulary), rng.randrange(vocabulary))}" for _ in range(n))


def state_of(store):
    got = {(r.token, r.doc_key): r.tf for r in store.postings().collect()}
    freqs = {r.token: r.doc_freq for r in store.doc_freq().collect()}
    return got, freqs, store.n_docs()


def full(docs):
    """What a rebuild from {key: text} gives."""
    counts = {k: Counter(TOKEN.findall((t or "").lower())) for k, t in docs.items()}
    postings = {(w, k): n for k, c in counts.items() for w, n in c.items()}
    return postings, dict(Counter(w for w, _ in postings)), len(docs)


def files_below(folder):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(folder)
        for f in names
        if "_SUCCESS" not in f
    }


def test_batches_equal_a_rebuild_and_leave_old_files(spark, tmp_path):
    rng, base = random.Random(1), str(tmp_path / "index")
    store = segments.Segments(spark, base, (("title", "string"),), fanout=3)
    docs: dict = {}
    tiers = []
    for turn in range(7):
        keys = rng.sample(range(60), 14)
        changed = {k: rng.choice([None, "", prose(rng, rng.randrange(1, 90))]) for k in keys[:9]}
        removed = [*keys[9:], 10_000, None, keys[0]]  # unknown, null, brought by the same batch
        before = files_below(base)
        rows = [(k, t, f"t{turn}") for k, t in changed.items()] + [(None, "lost", "x")]
        store.apply(
            spark.createDataFrame(rows, DOCS), spark.createDataFrame([(k,) for k in removed], "doc_key long")
        )
        after = files_below(base)
        assert all(after.get(f) == t for f, t in before.items())
        docs = {k: t for k, t in docs.items() if k not in removed} | changed
        assert state_of(store) == full(docs)
        assert {r.doc_key for r in store.mappings().collect()} == set(docs)
        tiers.append([s["tier"] for s in store.live()])
    assert tiers[1] == [0, 0] and tiers[2] == [1] and tiers[6] == [1, 1, 0]
    store.merge_all()
    assert len(store.live()) == 1 and state_of(store) == full(docs)
    idf = {r.token: r.idf for r in store.idf().collect()}
    _, freqs, n = full(docs)
    assert all(abs(idf[w] - math.log((n + 1) / (f + 1))) < 1e-9 for w, f in freqs.items())


def test_a_batch_reads_no_old_postings(spark, tmp_path, monkeypatch):
    store = segments.from_documents(
        spark, str(tmp_path / "index"), spark.createDataFrame([(1, "a b", "x"), (2, "b c", "y")], DOCS)
    )
    read = []
    plain = segments.Segments._read
    monkeypatch.setattr(
        segments.Segments, "_read", lambda self, part, *a: read.append(part) or plain(self, part, *a)
    )
    store.apply(spark.createDataFrame([(1, "c", "z")], DOCS))
    assert "docs" in read and "postings" not in read
    assert state_of(store) == full({1: "c", 2: "b c"})


def test_bad_batches_publish_nothing(spark, tmp_path):
    base = str(tmp_path / "index")
    store = segments.Segments(spark, base)
    assert store.live() == [] and store.n_docs() == 0 and store.postings().count() == 0
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "doc_key long, text string")
    with pytest.raises(ValueError):
        store.apply(twice)
    assert store.manifest() is None
    store.apply(twice.where("text = 'a'"))
    stale = store.manifest()
    store.apply(twice.where("text = 'b'"))
    # A writer that still knows the older version loses against the one that has published.
    lost = 0
    for _ in range(8):
        try:
            store._publish(stale, [s.asDict() for s in stale["segments"]], 1)
        except segments.Overtaken:
            lost += 1
    assert lost >= 1 and store.manifest()["version"] == 2
    empty = twice.limit(0)
    store.apply(empty)
    assert store.manifest()["version"] == 3


def built(spark, docs):
    placed = blocks.with_blocks(docs, F.octet_length("text"))
    forward = stage_table(blocks.forward_rows(placed, 1), "forward")
    stored = stage_table(blocks.postings_of(forward), "postings")
    freqs = stored.groupBy("token").agg(F.count(F.lit(1)).alias("doc_freq"))
    idf = stage_table(index.idf(freqs, docs), "idf")
    return forward.select("doc_key", "seq", "block", "length"), stored, idf


def test_bounded_search_opens_few_blocks(spark):
    rng = random.Random(4)
    rows = [(k, prose(rng, int(3 + 400 * rng.random() ** 6))) for k in range(4_000)]
    rows += [(k, rows[k - 4_000][1]) for k in range(4_000, 4_100)]  # ties
    docs = stage_table(spark.createDataFrame(rows, "doc_key long, text string"), "docs")
    places, stored, idf = built(spark, docs)
    mappings = docs.select(
        "doc_key",
        F.concat(F.lit("https://s.example/"), "doc_key").alias("url"),
        F.lit("t").alias("title"),
        (F.col("doc_key") % 5).alias("external_refs"),
        (F.col("doc_key") % 3 / 10).alias("pagerank"),
    )
    texts = ["w1", "w2 w3", "w0 w5 w7", "w1", "w59", "", "nothing", "w", "s.example/77", "https://s.example/9 "]
    queries = spark.createDataFrame(list(enumerate(texts)), "query_id long, text string")
    weights = stage_table(bounded.block_weights(stored, idf), "weights")
    table = blocks.block_bounds(stored)
    found = bounded.search_batch(stored, table, places, weights, idf, mappings, queries, k=10)
    plain = search.search_batch(stored, idf, mappings, queries, k=10)
    want = sorted(map(tuple, plain.collect()))
    assert sorted(map(tuple, found.hits.collect())) == want and len(want) > 50
    common = F.col("query_id").isin(0, 1, 2)
    all_blocks = found.bounds.where(common).count()
    opened = found.first.where(common).count() + found.second.where(common).count()
    assert all_blocks > 90 and opened < all_blocks / 2


def test_bounded_search_on_segments(spark, tmp_path):
    rng = random.Random(6)
    first = {k: prose(rng, rng.randrange(1, 60)) for k in range(300)}
    schema = "doc_key long, text string, url string, title string, external_refs long, pagerank double"
    row = lambda k, t: (k, t, f"https://x.example/{k}", f"t{k}", k % 4, 0.15)
    store = segments.from_documents(
        spark, str(tmp_path / "index"), spark.createDataFrame([row(k, t) for k, t in first.items()], schema)
    )
    changed = {k: prose(rng, 40) for k in range(0, 300, 9)}
    gone = spark.createDataFrame([(k,) for k in range(0, 300, 7)], "doc_key long")
    store.apply(spark.createDataFrame([row(k, t) for k, t in changed.items()], schema), gone)
    idf = stage_table(store.idf(), "idf")
    queries = spark.createDataFrame([(1, "w1 w2"), (2, "w3"), (3, "x.example/9")], "query_id long, text string")
    stored = store.stored_postings()
    weights = stage_table(bounded.block_weights(stored, idf), "weights")
    found = bounded.search_batch(
        stored, blocks.block_bounds(stored), store.places(), weights, idf, store.mappings(), queries,
        k=15, counting=store.counting,
    )
    plain = search.search_batch(store.postings(), idf, store.mappings(), queries, k=15)
    assert sorted(map(tuple, found.hits.collect())) == sorted(map(tuple, plain.collect()))


def test_dictionary_join(spark):
    rng = random.Random(2)
    letters = "abcdeé \n"
    word = lambda n: "".join(rng.choice(letters) for _ in range(n))
    words = [word(rng.randrange(1, 9)) for _ in range(400)] + ["", None, "zz", "a.b", "(", "\\d", "ab", "ab"]
    texts = [word(rng.randrange(0, 200)) for _ in range(150)] + [None, "", "x(a.b\\d", "zz" * 50]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(0, "zz")], "doc_key long, text string")
    table = spark.createDataFrame([(w,) for w in words], "word string")
    pairs = [*enumerate(texts), (0, "zz")]
    want = {(k, w) for k, t in pairs for w in words if w and t is not None and w in t}
    for q in (2, 4):
        found = dictionary.dictionary_join(docs, table, q)
        assert sorted(map(tuple, found.collect())) == sorted(want)
    tags = spark.createDataFrame([("t1", "zz"), ("t1", "ab"), ("t2", "nowhere")], "tag string, word string")
    tagged = dictionary.tags_of(dictionary.dictionary_join(docs, tags), tags)
    assert {(r.doc_key, r.tag) for r in tagged.collect()} == {(k, "t1") for k, w in want if w in ("zz", "ab")}
    assert dictionary.dictionary_join(docs, table.limit(0)).count() == 0
    assert dictionary.dictionary_join(docs.limit(0), table).count() == 0


def test_dictionary_plan_does_not_grow(spark):
    docs = spark.createDataFrame([(1, "abc def")], "doc_key long, text string")

    def size(n):
        words = spark.range(n).select(F.concat(F.lit("word"), "id").alias("word"))
        return len(dictionary.dictionary_join(docs, words)._jdf.queryExecution().optimizedPlan().toString())

    assert size(5_000) < size(5) * 1.1
