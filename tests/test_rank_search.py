"""The hand-checked page lake: dedupe, graph, index and search."""

import math
import os
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from webloom import schema as S
from webloom.operators import graph, index, search, snapshot
from webloom.operators.tagging import with_url
from webloom.plans import rebuild
from webloom.session import shared_dir
from webloom.sources import lake


def row(domain, real_path, date, tags, h1, h2, p, https, http):
    return {
        "domain": domain, "path": "x", "date": date, "real_path": real_path, "tags": tags,
        "content": {
            "links": {"http": http, "https": https, "files": None, "internal": None},
            "metadata": {
                "charset": None, "logo": None, "scripts": None, "styles": None, "title": None,
                "other": {"k": ["v"]},
            },
            "imgs": {"imgs": None},
            "texts": {"h1": h1, "h2": h2, "p": p},
        },
    }


SECOND = row(
    "a.es", "/", "2025-01-02", ["empresa"], ["Becas USAL"], [], ["Becas y ayudas"],
    ["https://b.es/", "https://b.es/", "https://c.es/x"], [],
)
ROWS = [
    row("a.es", "/", "2025-01-01", [], ["Inicio viejo"], [], ["texto"], ["https://b.es/"], []),
    SECOND,
    SECOND,
    row("b.es", "/", "2025-01-02", [], [], ["Portada B"], ["becas becas máster"],
        ["https://a.es/"], ["http://z.com/"]),
    row("c.es", "/x", "2025-01-02", [], None, None, ["nada"], None, None),
    row("d.es", "/", "2025-01-01", [], ["D"], [], ["co coche"],
        ["https://a.es/", "https://d.es/"], []),
]
RANKS = {"https://a.es/": 0.614832, "https://b.es/": 0.416451, "https://c.es/x": 0.416451,
         "https://d.es/": 0.261012}


@pytest.fixture(scope="module")
def pages(spark):
    return with_url(spark.createDataFrame(ROWS, S.PAGE)).persist()


@pytest.fixture(scope="module")
def latest(pages):
    return snapshot.latest_snapshot(snapshot.daily_dedupe(pages)).persist()


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    spark.createDataFrame(ROWS[3:], S.PAGE).write.json(f"{base}/landing/two")
    spark.createDataFrame(ROWS[:3], S.PAGE).write.mode("overwrite").parquet(f"{base}/landing/one")
    rebuild.rebuild(spark, f"{base}/landing", f"{base}/out")
    return str(base)


def test_snapshots(pages, latest):
    deduped = snapshot.daily_dedupe(pages)
    assert deduped.count() == 5
    assert snapshot.daily_dedupe(deduped).count() == 5
    assert sorted((r.url, r.date) for r in latest.collect()) == [
        ("https://a.es/", "2025-01-02"), ("https://b.es/", "2025-01-02"),
        ("https://c.es/x", "2025-01-02"), ("https://d.es/", "2025-01-01"),
    ]


def test_narrow_pass_sees_the_links_of_the_kept_rows(spark):
    rows = [dict(ROWS[1]), dict(ROWS[0], date="2025-01-02"), dict(ROWS[3], domain="a.es")]
    both = with_url(spark.createDataFrame(rows, S.PAGE))
    wide = snapshot.latest_snapshot(snapshot.daily_dedupe(both)).select("content.links").first()
    assert snapshot.latest_links(both).first().links == wide.links


def test_graph(latest):
    links = graph.link_rows(latest)
    refs = graph.external_refs(links)
    assert {r.link: r.external_refs for r in refs.collect()} == {
        "https://a.es/": 2, "https://b.es/": 2, "https://c.es/x": 1, "https://d.es/": 1,
        "http://z.com/": 1,
    }
    nodes = graph.vertices(latest)
    edges = graph.edges(links, nodes)
    assert sorted((r.src[8], r.dst[8]) for r in edges.collect()) == [
        ("a", "b"), ("a", "c"), ("b", "a"), ("d", "a"), ("d", "d"),
    ]
    weights = graph.transitions(edges).groupBy("src").agg(F.sum("weight").alias("w")).collect()
    assert all(math.isclose(r.w, 1.0) for r in weights)
    ranks = {r.url: r.pagerank for r in graph.pagerank(nodes, edges).collect()}
    assert {k: round(v, 6) for k, v in ranks.items()} == RANKS
    assert all(v >= 0.15 for v in ranks.values())


def test_index(latest):
    docs = index.page_documents(latest)
    posts = index.postings(index.tokens(docs))
    names = {r.doc_key: r.url for r in index.doc_mappings(latest).collect()}
    got = {}
    for r in posts.collect():
        got.setdefault(names[r.doc_key], {})[r.token] = r.tf
    assert got == {
        "https://a.es/": dict(a=2, ayudas=1, becas=2, empresa=1, es=2, https=1, usal=1, y=1),
        "https://b.es/": dict(b=3, becas=2, es=2, https=1, máster=1, portada=1),
        "https://c.es/x": dict(c=2, es=2, https=1, nada=1, x=2),
        "https://d.es/": dict(co=1, coche=1, d=3, es=2, https=1),
    }
    freqs = index.doc_freq_of(posts)
    assert sorted(map(tuple, freqs.collect())) == sorted(map(tuple, index.doc_freq(docs).collect()))
    idf = {r.token: r.idf for r in index.idf(freqs, docs).collect()}
    assert len(idf) == 17
    assert idf["es"] == idf["https"] == 0.0
    assert math.isclose(idf["becas"], 0.5108256237659907)
    assert all(math.isclose(v, 0.9162907318741551) for k, v in idf.items()
               if k not in ("es", "https", "becas"))
    titles = {r.url: r.title for r in index.doc_mappings(latest).collect()}
    assert titles == {"https://a.es/": "Becas USAL", "https://b.es/": "Portada B",
                      "https://c.es/x": "c.es", "https://d.es/": "D"}
    assert index.clashing_keys(latest.select("url")).isEmpty()


def test_nested_blocks_hold_every_posting_once(spark):
    posts = spark.range(10_000).selectExpr("'t' as token", "id as doc_key", "id % 3 + 1 as tf")
    blocks = index.nested_index(posts).collect()
    assert max(len(b.docs) for b in blocks) <= index.BLOCK_DOCS
    assert sorted(d.doc_key for b in blocks for d in b.docs) == list(range(10_000))
    hashed = posts.withColumn("doc_key", F.xxhash64("doc_key"))
    blocks = index.nested_index(hashed, index.hash_block(hashed)).collect()
    assert max(len(b.docs) for b in blocks) <= index.BLOCK_DOCS
    assert sum(len(b.docs) for b in blocks) == 10_000


SEARCHES = [
    ("becas", [("https://a.es/", 1.021651, 1), ("https://b.es/", 1.021651, 1)]),
    ("co", [("https://d.es/", 1.832581, 2)]),
    ("becas máster", [("https://b.es/", 1.937942, 2), ("https://a.es/", 1.021651, 1)]),
    ("C", [("https://d.es/", 1.832581, 2), ("https://c.es/x", 1.832581, 1)]),
    ("https://a.es/", []),
    ("  ", []),
]


@pytest.mark.parametrize("text, hits", SEARCHES)
def test_search_published(spark, published, text, hits):
    got = rebuild.search_text(spark, f"{published}/out", text).collect()
    assert [(r.url, r.score, r.matches) for r in got] == [(u, round(s, 2), m) for u, s, m in hits]
    t = rebuild.open_tables(spark, f"{published}/out")
    raw = search.scores(t.postings, t.idf, search.terms_of(text)).join(t.mappings, "doc_key")
    assert {r.url: round(r.content_score, 6) for r in raw.collect()} == {u: s for u, s, _ in hits}


def test_search_for_an_address(spark, published):
    got = rebuild.search_text(spark, f"{published}/out", "https://c.es/x", normalise=True).collect()
    assert got[0].url == "https://c.es/x"


def test_batch_equals_single_searches(spark, published):
    t = rebuild.open_tables(spark, f"{published}/out")
    texts = [s for s, _ in SEARCHES] + ["becas", "co c coche", "a e BECAS b"]
    queries = spark.createDataFrame(list(enumerate(texts)), "query_id bigint, text string")
    got = {}
    for r in search.search_batch(t.postings, t.idf, t.mappings, queries, k=3).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.url, r.score, r.matches, r.popularity))
    for i, text in enumerate(texts):
        want = search.search(t.postings, t.idf, t.mappings, text, k=3).collect()
        assert sorted(got.get(i, [])) == [
            (n + 1, r.url, r.score, r.matches, r.popularity) for n, r in enumerate(want)
        ]


@pytest.mark.parametrize("k", [1, 2, 5])
def test_best_documents_by_brute_force(spark, k):
    """Ties, exact addresses with low scores, and fewer hits than asked for."""
    docs = spark.range(60).selectExpr(
        "id as doc_key",
        "concat('https://', case when id = 59 then 'needle' else concat('s', id) end) as url",
    )
    mappings = docs.selectExpr(
        "doc_key", "url", "'t' as title", "doc_key % 4 as external_refs",
        "cast(doc_key % 3 as double) as pagerank",
    )
    posts = docs.selectExpr("explode(array('needle', 'needles')) as token", "doc_key",
                            "case when token = 'needle' then 1 + doc_key % 5 else doc_key % 2 end as tf")
    posts = posts.where("tf > 0 and (doc_key < 59 or token = 'needle')")
    idf = index.idf(index.doc_freq_of(posts), docs.unionByName(docs))
    weight = {r.token: r.idf for r in idf.collect()}
    sums, matches = Counter(), Counter()
    for r in posts.collect():
        sums[r.doc_key] += r.tf * weight[r.token]
        matches[r.doc_key] += 1
    rows = {r.doc_key: r for r in mappings.collect()}
    order = sorted(
        sums,
        key=lambda d: (
            rows[d].url != "https://needle", -round(sums[d], 6), -matches[d], -rows[d].pagerank,
            -rows[d].external_refs, "needle" not in rows[d].url, d,
        ),
    )
    want = [rows[d].url for d in order[:k]]
    assert [r.url for r in search.search(posts, idf, mappings, " needle ", k).collect()] == want
    queries = spark.createDataFrame([(7, "needle"), (8, "needle"), (9, "none")], "query_id bigint, text string")
    got = search.search_batch(posts, idf, mappings, queries, k).collect()
    assert sorted((r.query_id, r["rank"], r.url) for r in got) == sorted(
        (q, i + 1, u) for q in (7, 8) for i, u in enumerate(want)
    )


def test_scored_history(spark, published):
    rows = rebuild.open_tables(spark, f"{published}/out").pages.collect()
    assert len(rows) == 5
    for r in rows:
        assert round(r.pagerank, 6) == RANKS[r.url]
        assert r.external_refs == {"a": 2, "b": 2, "c": 1, "d": 1}[r.domain[0]]
    assert sorted((r.domain, r.date) for r in rows if not r.is_latest) == [("a.es", "2025-01-01")]


def test_rebuild_of_a_rebuilt_lake_changes_nothing(spark, published, tmp_path):
    before = rebuild.open_tables(spark, f"{published}/out").pages
    before.drop("domain_p", "date_p").write.parquet(f"{tmp_path}/landing")
    assert rebuild.rebuild(spark, f"{tmp_path}/landing", f"{tmp_path}/out") == 1
    assert rebuild.rebuild(spark, f"{tmp_path}/landing", f"{tmp_path}/out") == 2
    after = rebuild.open_tables(spark, f"{tmp_path}/out").pages
    key = lambda r: (r.url, r.date, r.external_refs, round(r.pagerank, 9), r.is_latest)
    assert sorted(map(key, after.collect())) == sorted(map(key, before.collect()))


def test_lookup_and_sample(spark, published):
    got = rebuild.lookup(spark, f"{published}/out", "a.es").collect()
    assert [r.date for r in got] == ["2025-01-02", "2025-01-01"]
    assert rebuild.lookup(spark, f"{published}/out", "nowhere.es").count() == 0
    assert {r.token for r in rebuild.sample(spark, f"{published}/out", "becas").collect()} == {"becas"}
    assert rebuild.sample(spark, f"{published}/out", limit=3).count() == 3


def test_before_the_first_rebuild(spark, tmp_path):
    assert rebuild.search_text(spark, str(tmp_path), "becas").collect() == []
    empty = lake.scan(spark, str(tmp_path / "missing"))
    assert empty.select("content.links.https", "pagerank").collect() == []
    assert empty.schema == S.SCORED_PAGE
    assert lake.open_current(spark, str(tmp_path)).count() == 0


def test_publish_keeps_old_versions(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, S.PAGE)
    base = str(tmp_path / "lake")
    assert lake.publish(pages.where("domain = 'a.es'"), base) == 1
    old = lake.open_current(spark, base)
    assert lake.publish(pages, base, domain_buckets=2) == 2
    assert old.count() == 3
    now = lake.open_current(spark, base)
    assert now.count() == 6 and {r.domain_p for r in now.collect()} <= {"0", "1"}


def test_split_sources_give_the_same_ranks(spark, latest):
    links = graph.link_rows(latest)
    nodes = graph.vertices(latest)
    edges = graph.edges(links, nodes)
    for size in (1, 2, 1_000):
        ranks = graph.pagerank(nodes, edges, edges_per_piece=size).collect()
        assert {r.url: round(r.pagerank, 6) for r in ranks} == RANKS


def test_hot_keys_do_not_fill_a_task(spark):
    """Joins on a hot key lean on the adaptive skew join: 5,000 warm keys, one with a third."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        postings = spark.range(0, 600_000, 1, 24).selectExpr(
            "case when id % 3 = 0 then 'hot' else concat('k', id % 5000) end AS token",
            "id AS doc_key",
            "1L AS tf",
        )
        weights = spark.range(5_000).selectExpr("concat('k', id) AS token", "id * 1.0D AS idf").unionByName(
            spark.sql("SELECT 'hot' AS token, 1.0D AS idf")
        )
        joined = postings.join(weights, "token").select(
                "doc_key", "tf", F.spark_partition_id().alias("task")
            )
        per_task = [r["count"] for r in joined.groupBy("task").count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(per_task) >= 590_000 and max(per_task) < 0.1 * sum(per_task)


def scratch_files(spark):
    folder = os.path.join(shared_dir(spark).removeprefix("file:"), "webloom")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_rebuild_after_a_failure_and_with_clashing_hashes(spark, published, tmp_path, monkeypatch):
    base, landing = f"{tmp_path}/out", f"{published}/landing"
    before = scratch_files(spark)
    with monkeypatch.context() as m:
        def broken(*a):
            raise RuntimeError("stopped after the pages")

        m.setattr(rebuild, "write_index", broken)
        for _ in range(2):
            with pytest.raises(RuntimeError):
                rebuild.rebuild(spark, landing, base)
    assert rebuild.open_tables(spark, base).pages.isEmpty()
    few = lambda url: F.pmod(F.xxhash64(url), F.lit(2))
    assert rebuild.rebuild(spark, landing, base, hash_of=few) == 1
    t = rebuild.open_tables(spark, base)
    keys = [r.doc_key for r in t.mappings.collect()]
    assert len(keys) == len(set(keys)) == 4
    assert [r.url for r in rebuild.search_text(spark, base, "becas").collect()] == [
        "https://a.es/", "https://b.es/",
    ]
    assert scratch_files(spark) == before
    assert {r.pagerank for r in t.postings.select("pagerank").collect()} == {
        r.pagerank for r in t.mappings.select("pagerank").collect()
    }


def test_two_publishers_at_once(spark, tmp_path):
    raw = spark.createDataFrame(ROWS, S.SCORED_PAGE)
    base = f"{tmp_path}/lake"
    one, two = lake.new_version(spark, base), lake.new_version(spark, base)
    assert one[0] == two[0] == 1 and one[1] != two[1]
    lake.write_partitioned(raw, f"{base}/{one[1]}")
    lake.write_partitioned(raw.limit(1), f"{base}/{two[1]}")
    lake.commit_version(spark, base, *one)
    lake.commit_version(spark, base, *two)
    newest = max(one[1], two[1])
    assert lake.open_current(spark, base).count() == (raw.count() if newest == one[1] else 1)
    assert lake.publish(raw, base) == 2 and lake.open_current(spark, base).count() == raw.count()


@pytest.mark.parametrize("buckets", [None, 3])
def test_lookup_prunes_folders(spark, tmp_path, buckets):
    raw = spark.createDataFrame(ROWS, S.SCORED_PAGE)
    base = f"{tmp_path}/lake"
    lake.publish(raw, base, buckets)
    pages = lake.open_current(spark, base)
    found = search.page_lookup(pages, "https://a.es/", buckets)
    assert {r.url for r in found.collect()} == {"https://a.es/"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[([^\]]*)", plan).group(1)
    assert "domain_p" in filters
