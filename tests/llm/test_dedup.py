"""Exact dedup, n-gram join and substring dedup against brute force."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import check
from tests.llm import helpers as H
from webloom.llm import block_exchange, exact_dedup, near_dups, queries, repeats
from webloom.llm import words as W
from webloom.llm.components import components
from webloom.plans import registry

np.seterr(over="ignore")


def docs_of(spark, rows):
    return spark.createDataFrame(rows, H.DOC_SCHEMA)


def unique_ids(rows):
    """Odd rows with distinct, given ids."""
    seen = {}
    for r in rows:
        if r[0] is not None:
            seen.setdefault(r[0], r)
    return list(seen.values())


def test_words_are_those_of_the_pattern():
    texts = ["", "a", " a\tb\x0b\x0cc ", "é x  y", "A a"] + [
        H.prose(random.Random(k), k) for k in range(40)
    ]
    import pyarrow as pa

    for block in (1, 64, 1 << 20):
        got = []
        for _, part in W.blocks(W.texts_of(pa.array(texts)), block):
            w = W.words_of(part)
            for a, b in zip(w.first, w.first[1:]):
                got.append([part.data[s:e].tobytes() for s, e in zip(w.starts[a:b], w.ends[a:b])])
        assert got == [H.WORD.findall(t.encode()) for t in texts]
    w = W.words_of(W.texts_of(pa.array(["ab ab ba", "AB ab"])), lower=True)
    assert len({*w.hashes.tolist()}) == 2 and w.hashes[0] == w.hashes[3] == w.hashes[4]


def exact_brute(rows):
    groups = {}
    for i, t, *_ in rows:
        groups.setdefault((t or "").encode().translate(H.LOWER), []).append(i)
    best = {k: max((i for i in v if i is not None), default=None) for k, v in groups.items()}
    return groups, best


def test_exact_dedup_odd_rows(spark):
    rows = H.odd_documents()
    docs = docs_of(spark, rows).withColumn("key", F.lit(1)).withColumn("kept", F.lit("x"))
    groups, best = exact_brute(rows)
    got = exact_dedup.lookup(exact_dedup.build_index(docs, bucket_rows=3, max_depth=6)).collect()
    want = sorted(
        (str(i), str(best[k]), len(v), i == best[k])
        for k, v in groups.items()
        for i in v
    )
    assert sorted((str(r.id), str(r.keep_id), r.group_size, r.kept) for r in got) == want
    left = exact_dedup.distinct_rows(docs)
    assert left.columns == docs.columns
    texts = [(r.text or "").encode().translate(H.LOWER) for r in left.where("doc_id is not null").collect()]
    assert sorted(texts) == sorted(k for k in groups if best[k] is not None)


def test_directory_splits_until_buckets_fit(spark):
    entries = spark.range(5_000).select(F.xxhash64("id").alias("key")).unionByName(
        spark.range(300).select(F.lit(7).cast("long").alias("key"))
    )
    slots = exact_dedup.directory(entries, bucket_rows=100, max_depth=10)
    filled = (
        entries.withColumn("slot", exact_dedup.slot_of(F.col("key"), 10))
        .join(slots, "slot")
        .groupBy("bucket", "depth")
        .count()
        .collect()
    )
    assert sum(r["count"] for r in filled) == 5_300
    over = [r for r in filled if r["count"] > 100]
    assert [r.depth for r in over] == [10]  # one key only, a chain
    assert min(r.depth for r in filled) == 6


def test_texts_that_share_a_key_are_chained(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "key_of", lambda norm: F.length(norm).cast("long"))
    rows = [(k, f"t{k % 4}", None, None, 2) for k in range(20)]
    index = exact_dedup.build_index(docs_of(spark, rows))
    assert sorted(r.chain for r in index.leaves.collect()) == [1, 2, 3, 4]
    got = {r.id: (r.keep_id, r.group_size) for r in exact_dedup.lookup(index).collect()}
    assert got == {k: (16 + k % 4, 5) for k in range(20)}


def test_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(40, 80)] + [(100, k) for k in range(101, 130)]
    links += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(150)]
    parent = {x: x for pair in links for x in pair}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.id: r.component for r in got} == {x: find(x) for x in parent}


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_random(spark, seed):
    rows = H.near_groups(seed, groups=30)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: (r.n_shingles, r.component_id) for r in near_dups.near_duplicates(docs).collect()}
    assert got == H.brute_near(rows)


def test_near_duplicates_odd_rows(spark):
    rows = [r for r in H.odd_documents() if r[0] is not None and r[0] != 19]
    docs = docs_of(spark, rows).withColumn("tokens", F.lit(1))
    got = near_dups.near_duplicates(docs).collect()
    want = H.brute_near([(r[0], r[1]) for r in unique_ids(rows)])
    assert len(got) == len(rows)
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == want
    whole = docs_of(spark, H.odd_documents())
    left = near_dups.one_of_each(whole)
    assert left.columns == whole.columns
    assert {r.doc_id for r in left.collect()} >= {i for i, (_, c) in want.items() if i == c}


def test_near_duplicates_with_repeated_and_missing_ids(spark):
    """Every text is compared, whatever its id, and dropped by id and text."""
    rng = random.Random(12)

    def family(n):
        words = H.prose(rng, n, 5_000).split()
        return [" ".join(words[:k] + ["new"] + words[k + 1 :]) for k in range(0, n, n // 4)]

    a, b, c, d, e, f = (family(n) for n in (200, 120, 150, 180, 90, 60))
    rows = [
        (19, a[0]), (19, b[0]), (25, b[1]), (7, a[1]),  # the shorter text has a copy, too
        (30, c[0]), (30, d[0]), (31, d[0]), (40, d[1]),  # a class whose smallest id is taken
        (50, e[0]), (50, e[1]), (None, e[2]),  # near copies under one id
        (None, f[0]), (None, f[1]), (None, f[2]),  # no id at all
        (None, ""), (60, ""), (None, "alone here"), (60, "clean text of its own words"),
    ]
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, n int")
    got = sorted((r.id or 0, r.component_id or 0) for r in near_dups.near_duplicates(docs).collect())
    want = [7, 19, 19, 7, 30, 30, 30, 30, 50, 50, 50, 0, 0, 0, 0, 60, 0, 60]
    assert got == sorted((r[0] or 0, w) for r, w in zip(rows, want))
    left = sorted(r.n for r in near_dups.one_of_each(docs).collect())
    ones = [n for n in left if n in (8, 9)], [n for n in left if n in (11, 12, 13)]
    assert [len(x) for x in ones] == [1, 1]
    assert left == sorted([1, 3, 4, 5, 14, 15, 16, 17] + ones[0] + ones[1])


@pytest.mark.parametrize("rare, frequent", [(0, 0), (0, 9), (2, 4), (9, 9)])
def test_linked_sets_share_a_signature(monkeypatch, rare, frequent):
    """Whatever the classes, two sets that link have a key in common."""
    monkeypatch.setattr(near_dups, "RARE", rare)
    monkeypatch.setattr(near_dups, "FREQUENT", frequent)
    rng = np.random.default_rng(rare * 10 + frequent)
    classes_of = {}
    for _ in range(300):
        n = int(rng.integers(1, 300))
        base = rng.integers(1, 1 << 63, n, dtype=np.uint64)
        a, b = base[rng.random(n) > 0.1], base[rng.random(n) > 0.1]
        b = np.concatenate([b, rng.integers(1, 1 << 63, int(n * 0.05), dtype=np.uint64)])
        a, b = np.unique(a), np.unique(b)
        common = len(np.intersect1d(a, b))
        if not len(a) or not len(b) or 100 * common < 80 * (len(a) + len(b) - common):
            continue
        found = []
        for s in (a, b):
            # Tokens outside the pair's intersection may be of one document only.
            lone = ~np.isin(s, np.intersect1d(a, b)) & (rng.random(len(s)) < 0.5)
            for t in s.tolist():
                classes_of.setdefault(t, int(rng.integers(2, 12)))
            shared = s[~lone]
            classes = np.array([classes_of[t] for t in shared.tolist()], np.uint8)
            found.append(near_dups.signatures(len(s), shared, classes, 80))
        assert len(np.intersect1d(*found))


def test_pairs_of_large_keys_go_by_pivots(spark, monkeypatch):
    """Many documents under one key: first pivots, then growing small keys."""
    monkeypatch.setattr(near_dups, "SMALL_KEY", 2)
    rng = random.Random(9)
    base = H.prose(rng, 200, 3_000).split()
    rows = []
    for k in range(24):
        words = list(base)
        for _ in range(3):
            words[rng.randrange(200)] = f"n{k}"
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: (r.n_shingles, r.component_id) for r in near_dups.near_duplicates(docs).collect()}
    assert got == H.brute_near(rows)


def test_symbols_of_a_repeated_window_agree():
    """The core of a window is parsed alike wherever the window stands."""
    rng = np.random.default_rng(8)
    for turn in range(200):
        kind = [2, 3, 8, 1000][turn % 4]
        middle = rng.integers(0, kind, repeats.WINDOW).astype(np.uint64)
        if turn % 5 == 0:
            middle[:] = middle[0]
        parsed = []
        for _ in range(2):
            left, right = (rng.integers(0, kind, int(rng.integers(0, 40))) for _ in range(2))
            words = W.mix(np.concatenate([left, middle, right]).astype(np.uint64))
            names, length = repeats.parse(words, np.zeros(len(words), np.int64))
            assert length.sum() == len(words) and length.max() <= repeats.CORE
            start = np.cumsum(length) - length - len(left)
            low, high = repeats.MARGIN, repeats.MARGIN + repeats.CORE
            inside = (start + length > low) & (start < high)
            parsed.append(list(zip(start[inside], length[inside], names[inside])))
        assert parsed[0] == parsed[1]


def cut(spark, docs):
    return {
        r.id: (r.n_words, r.n_removed, r.sha)
        for r in repeats.cut_repeats(docs).withColumn("sha", F.sha2("kept_text", 256)).collect()
    }


def test_repeats_random(spark, monkeypatch):
    rng = random.Random(12)
    shared = [H.prose(rng, rng.choice([49, 50, 51, 70, 200]), 60).split() for _ in range(6)]
    shared += [["x"] * 60, ["p", "q"] * 40, ["u", "v", "w"] * 30]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randrange(1, 5)):
            words += H.prose(rng, rng.randrange(0, 60), 50).split()
            part = rng.choice(shared)
            at = rng.randrange(0, 10)
            words += part[at:] if rng.random() < 0.3 else part
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = H.brute_repeats(rows)
    assert sum(v[1] for v in want.values()) > 1_000
    assert cut(spark, docs) == want
    # Many blocks and buckets.
    monkeypatch.setattr(block_exchange, "plan_for", lambda *a: block_exchange.Plan(40, 5))
    assert cut(spark, docs) == want


def test_repeats_odd_rows(spark):
    rows = [r for r in H.odd_documents() if r[0] is not None and r[0] != 19]
    docs = docs_of(spark, rows).withColumn("kept_text", F.lit(1))
    assert cut(spark, docs) == H.brute_repeats([(r[0], r[1]) for r in unique_ids(rows)])
    spans = {r.id: r for r in repeats.cut_repeats(docs_of(spark, H.odd_documents())).collect()}
    assert [tuple(s) for s in spans[9].removed] == [(0, 30_000)] and spans[9].kept_text == "tail"
    assert spans[1].removed == []


@pytest.mark.parametrize("name", ["op2_near_dups", "op3_exact_dedup", "op8_repeats"])
def test_empty_table(spark, tmp_path, name):
    empty = spark.createDataFrame([], H.DOC_SCHEMA)
    folder = H.write_tables(spark, str(tmp_path), documents=empty)
    assert registry.QUERIES[name](spark, folder).collect() == []


def test_exact_query_on_odd_rows(spark, tmp_path):
    rows = [r for r in H.odd_documents() if r[0] is not None]
    folder = H.write_tables(spark, str(tmp_path), documents=docs_of(spark, rows))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    ok, note = check.compare(
        spark, con, queries.op3_exact_dedup, queries.OP3_SQL, folder
    )
    assert ok, note


def test_queries_on_given_tables(spark):
    folder = "/root/testdata/sf0.001"
    rows = queries.table(spark, folder, "documents").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in queries.op2_near_dups(spark, folder).collect()}
    assert got == H.brute_near(rows)
    got = {r.doc_id: tuple(r)[1:] for r in queries.op8_repeats(spark, folder).collect()}
    assert got == H.brute_repeats(rows)
