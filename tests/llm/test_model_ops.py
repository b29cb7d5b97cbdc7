"""Quality classifier, mixing, packing, URL rules, licences: brute force and odd rows."""

import fnmatch
import itertools
import random
import re
import textwrap
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import check
from tests.llm import helpers as H
from webloom.llm import licences, mixing, packing, quality_fm, queries, tokens, url_globs
from webloom.llm import words as W
from webloom.plans import registry

SF = "/root/testdata/sf0.01"


def docs_of(spark, rows):
    return spark.createDataFrame(rows, H.DOC_SCHEMA)


# Quality classifier


def test_linear_time_score_is_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    w, v = rng.normal(size=50), rng.normal(size=(50, 4))
    first = np.array([0, 3, 10, 11])
    x = quality_fm.Features(rng.integers(0, 50, 11), rng.normal(size=11), first)
    got, _ = quality_fm.raw_scores(x, 0.7, w, v)
    for row in range(3):
        i, value = x.index[first[row] : first[row + 1]], x.value[first[row] : first[row + 1]]
        want = 0.7 + (w[i] * value).sum()
        for a, b in itertools.combinations(range(len(i)), 2):
            want += (v[i[a]] @ v[i[b]]) * value[a] * value[b]
        assert got[row] == pytest.approx(want)


def test_quality_held_out(spark):
    rows = queries.op1_quality(spark, SF).join(queries.table(spark, SF, "labels"), "doc_id")
    held = rows.where("held_out").select("quality", "score", "predicted").toPandas()
    good, bad = held.score[held.quality == 1].values, held.score[held.quality == 0].values
    auc = ((good[:, None] > bad) + 0.5 * (good[:, None] == bad)).mean()
    assert len(bad) >= 5 and auc > 0.97
    assert (held.predicted[held.quality == 1] == 1).mean() > 0.97
    everyone = queries.op1_quality(spark, SF).select("doc_id", "held_out", "score", "predicted")
    for r in everyone.collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)


def test_quality_never_learns_from_held_out_labels(spark):
    docs, labels = (queries.table(spark, SF, t) for t in ("documents", "labels"))
    turned = labels.withColumn(
        "quality",
        F.when(queries.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")),
    )
    a, b = (queries.quality_model(docs, x) for x in (labels, turned))
    assert a.bias == b.bias and (a.weights == b.weights).all() and (a.factors == b.factors).all()


def test_quality_odd_rows(spark):
    rows = H.odd_documents()
    docs = docs_of(spark, rows).withColumn("score", F.lit("x")).withColumn("_label", F.lit(1))
    labels = spark.createDataFrame(
        [(1, 1), (4, 0), (4, 1), (None, 1), (8, None), (5, 0), (99, 1)],
        "doc_id long, quality int",
    )
    model = quality_fm.train(docs.drop("_label"), labels)
    assert model.trained
    scored = quality_fm.score(docs, model)
    assert sorted(scored.columns) == sorted(docs.columns)
    got = [r.score for r in scored.collect()]
    assert len(got) == len(rows) and all(0 <= s <= 1 for s in got)
    none = quality_fm.train(docs, labels.limit(0))
    assert {r.score for r in quality_fm.score(docs, none).collect()} == {0.5}
    assert quality_fm.score(docs.limit(0), model).collect() == []
    bare = docs.select("doc_id", "text")
    assert quality_fm.score(bare, quality_fm.train(bare, labels)).count() == len(rows)


# Packing


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


def test_ids_are_the_tokenizer_s():
    rng = random.Random(2)
    letters = "abcXYZéÉßſŉıİ'`´·ªº²½0123456789.,!?#$%&|<>-_\u0301\u00ad\u200b\u00a0\u3000語Σςσ😀\u1e9e\u01c5"
    texts = ["", " ", "It's we'll I'd 's 'S don'T", "<|endoftext|> a<|startoftext|>b", "x" * 3000,
             "\x1c\x1d a\x0bb\x0cc\x85d", "ǅ Ĳ Ǆ ﬁ Å"]
    texts += ["".join(rng.choice(letters + "   \n") for _ in range(rng.randrange(80))) for _ in range(400)]
    texts += [r[1] for r in H.odd_documents() if r[1]]
    own, other = tokens.WordTokens(queries.tokenizer_path()), tokenizer()
    for text in texts:
        want = np.array(other.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert own.ids(text.encode()) == want, text
        assert own.ids(text.encode()) == want


def test_caches_are_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_WORDS", 10)
    own = tokens.WordTokens(queries.tokenizer_path())
    text = " ".join(f"word{k}" for k in range(100))
    assert own.ids(text.encode()) == np.array(tokenizer().encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert len(own.words) <= 10 and len(own.pieces) <= 10


def least_bins(lengths, capacity):
    best = [len(lengths)]

    def place(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(lengths):
            best[0] = len(bins)
            return
        for b in range(len(bins)):
            if bins[b] + lengths[k] <= capacity and bins[b] not in bins[:b]:
                place(k + 1, bins[:b] + [bins[b] + lengths[k]] + bins[b + 1 :])
        place(k + 1, bins + [lengths[k]])

    place(0, [])
    return best[0]


def test_bound_and_best_fit():
    rng = random.Random(4)
    for _ in range(120):
        capacity = rng.choice([10, 16, 30])
        lengths = [rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 9))]
        bins, offsets, count = packing.best_fit_decreasing(np.array(lengths), capacity)
        bound = packing.lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        least = least_bins(sorted(lengths, reverse=True), capacity)
        assert bound <= least <= count
        for b in range(count):
            spans = sorted((offsets[k], lengths[k]) for k in np.flatnonzero(bins == b))
            assert [s for s, _ in spans] == [sum(x for _, x in spans[:k]) for k in range(len(spans))]
            assert sum(x for _, x in spans) <= capacity


def check_places(rows, capacity=packing.CAPACITY):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by_sequence.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by_sequence)


def test_packing_query(spark, tmp_path):
    rows = H.odd_documents()
    folder = H.write_tables(spark, str(tmp_path), documents=docs_of(spark, rows))
    got = queries.op4_packing(spark, folder).collect()
    check_places(got)
    other, want = tokenizer(), []
    for i, text, *_ in rows:
        ids = np.array([*other.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for piece, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            want.append((str(i), piece, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    empty = spark.createDataFrame([], H.DOC_SCHEMA)
    assert packing.packed_documents(empty, queries.tokenizer_path()).collect() == []


def test_gaps_are_closed_by_exchange(spark):
    rng = random.Random(6)
    rows = [(k, rng.choice([5, 9, 13, 17, 33, 40, 60])) for k in range(3_000)]
    pieces = spark.createDataFrame(rows, "number long, length long")
    parts = packing.pack(pieces, capacity=100, part_pieces=60)
    placed = parts.join(pieces, "number")
    used = check_places(placed.collect(), 100)
    told = packing.certificate(pieces, parts, 100)
    apart = packing.pack(pieces, capacity=100, part_pieces=60, max_rounds=0)
    assert told["sequences"] == used >= told["lower_bound"]
    assert used <= apart.select("sequence_id").distinct().count()
    assert used - told["lower_bound"] <= 0.05 * used
    assert placed.count() == 3_000


def test_exchange_goes_on_to_one_partition(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(k, rng.choice([5, 9, 13, 17, 33, 40, 60])) for k in range(1_000)]
    pieces = spark.createDataFrame(rows, "number long, length long")
    packed, over = packing._packed, []

    def with_gaps(rows, n, *rest):
        over.append(n)
        return packed(rows, n, *rest).withColumn("gap", F.lit(1).cast("long"))

    monkeypatch.setattr(packing, "_packed", with_gaps)
    parts = packing.pack(pieces, capacity=100, part_pieces=10)
    told = packing.certificate(pieces, parts, 100)
    assert over == [100, 50, 25, 13, 7, 4, 2, 1]
    assert check_places(parts.join(pieces, "number").collect(), 100) == told["sequences"]
    assert parts.count() == 1_000


def test_sequences_hold_the_ids(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "d e")], "doc_id long, text string")
    cut = packing.pieces(docs, queries.tokenizer_path(), with_ids=True)
    whole = packing.sequences(cut.join(packing.pack(cut), "number")).collect()
    other = tokenizer()
    want = [[*other.encode(t, add_special_tokens=False).ids, 0] for t in ("a b c", "d e")]
    assert [list(np.frombuffer(bytes(r.ids), "<u4")) for r in whole] == [want[0] + want[1]]


# URL rules


def as_pattern(glob):
    parts = {"*": ".*", "+": "[^/]*", "?": "."}
    return re.compile("".join(parts.get(c, re.escape(c)) for c in glob).encode(), re.S)


def test_automaton_against_patterns():
    rng = random.Random(7)
    for _ in range(40):
        globs = ["".join(rng.choice("ab/*+?") for _ in range(rng.randrange(0, 9))) for _ in range(30)]
        texts = ["".join(rng.choice("ab/") for _ in range(rng.randrange(0, 12))) for _ in range(60)]
        data = W.texts_of(pa.array(texts))
        got = url_globs.Automaton(globs).fits(data.data, data.offsets)
        assert len(globs) * 4 > 64
        for t, text in enumerate(texts):
            for g, glob in enumerate(globs):
                assert got[t, g] == bool(as_pattern(glob).fullmatch(text.encode())), (text, glob)
    assert fnmatch.fnmatchcase("ab", "a*")


URLS = [
    None, "", "x", "http://", "https://EXAMPLE.net", "https://a.example.net/en/x?y#z", "http://Net/",
    "http://anet/", "http://x.net?/en/", "ftp://example.com/de/", "https://a.b.org/fr/", "x://o.org/FR/",
    "https://example.com#/de/", "https://cheap-pills.example.com/a", "//a.net/", "a://b://c.net/",
    "https://x.org/casino/1", "https://x.org/a.exe", "https://é.net/ü?q", "https://user@x.net:80/en/",
    "https://.net/", "http://x.com/" + "a" * 20_000 + ".exe", "https://a.example.net/en/x?y#z",
    "https://example.net/en", "http://x.example.net/y.net/", "http://a.com/b.net/",
]


def test_url_query_on_odd_rows(spark, tmp_path):
    rows = [(k, u, None, "r") for k, u in enumerate(URLS)] + [(0, URLS[0], None, "r")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, rule string")
    folder = H.write_tables(spark, str(tmp_path), pages=pages)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet/*.parquet'")
    ok, note = check.compare(spark, con, queries.op5_url_globs, queries.OP5_SQL, folder)
    assert ok, note
    rules = [url_globs.site_rule("block", "net/")]
    assert url_globs.judge(pages, rules).columns == ["page_id", "url", "html", "host", "path", "rule", "verdict"]
    assert url_globs.judge(pages.limit(0), rules).collect() == []
    assert {r.verdict for r in url_globs.judge(pages, []).collect()} == {"allow"}


# Mixing


def test_mixing_meets_the_targets(spark):
    got = queries.op6_mixing(spark, SF).collect()
    words = sum(r.n_tokens for r in got)
    for k, share in enumerate(queries.TARGETS.values()):
        total = sum(r.n_tokens * r.posteriors[k] * r.rate for r in got)
        assert total / words == pytest.approx(share, abs=2e-4)
    assert all(r.rate >= 0 and abs(r.copies - r.rate) < 1 for r in got)
    lang = {r.doc_id: r.lang for r in queries.table(spark, SF, "documents").collect()}
    names = list(queries.TARGETS)
    right = sum(names[int(np.argmax(r.posteriors))] == lang[r.doc_id] for r in got)
    assert right / len(got) > 0.95


def test_rates_are_those_of_projected_gradient(spark):
    rng = np.random.default_rng(3)
    p = rng.dirichlet([0.3, 0.3, 0.3], 60)
    n = rng.integers(1, 50, 60)
    rows = [(k, int(n[k]), p[k].tolist()) for k in range(60)]
    members = spark.createDataFrame(rows, "id long, n_tokens long, posteriors array<double>")
    target = [0.9, 0.08, 0.02]  # far enough that some rates end at nothing
    found = mixing.fit(members, target, mixing.Settings(max_rounds=200, tolerance=1e-6))
    r = np.ones(60)
    m = (p * n[:, None]).T @ p / n.sum()
    step = 1 / (m / np.diag(m)[:, None]).sum(1).max()
    for _ in range(len(found)):
        gap = (n * r) @ p / n.sum() - target
        r = np.maximum(0, r - step * p @ (gap / np.diag(m)))
    got = members.select(mixing.rate(F.col("posteriors"), found).alias("r")).collect()
    assert np.allclose([x.r for x in got], r) and (r == 0).any()
    gap = lambda r: np.abs((n * r) @ p / n.sum() - target).max()
    assert gap(r) < 0.05 * gap(np.ones(60))


def test_mixing_odd_rows(spark):
    rows = H.odd_documents()
    docs = docs_of(spark, rows).withColumn("copies", F.lit("c")).withColumn("rate", F.lit(7))
    labelled = spark.createDataFrame(
        [(1, "en"), (17, "fr"), (None, "en"), (4, None), (8, "xx"), (19, "en")],
        "doc_id long, domain string",
    )
    targets = {"en": 0.5, "fr": 0.3, "zz": 0.2}
    got = mixing.rates(docs, labelled, targets).collect()
    assert len(got) == len(rows) and all(abs(sum(r.posteriors) - 1) < 1e-9 for r in got)
    assert all(r.rate >= 0 and len(r.posteriors) == 2 for r in got)
    left = mixing.mixed(docs, labelled, targets)
    assert left.columns == docs.columns
    copies = {}
    for r in got:
        copies[r.doc_id] = max(copies.get(r.doc_id, 0), r.copies)
    want = sum(1 if r[0] is None else copies[r[0]] for r in rows)
    assert left.count() == want
    assert {r.rate for r in mixing.rates(docs, labelled.limit(0), targets).collect()} == {1.0}
    assert mixing.rates(docs.limit(0), labelled, targets).collect() == []
    assert mixing.mixed(docs.limit(0), labelled, targets).collect() == []


# Licences


def test_licence_query_on_odd_rows(spark, tmp_path):
    texts = [r[1] for r in H.odd_documents()] + [t for _, t in licences.TEMPLATES]
    texts += ["Released under the MIT License.\n" * 3, "\n\nlicensed under cc by nc 4 0\n", "All\nrights"]
    texts += [t.upper() + " extra" for _, t in licences.TEMPLATES]
    texts += [" ".join(t.split()[1:]) for _, t in licences.TEMPLATES]
    texts += [t + "\n" + t for _, t in licences.TEMPLATES]
    rows = [(k, t, None, "matches", 1) for k, t in enumerate(texts)]
    folder = H.write_tables(spark, str(tmp_path), documents=docs_of(spark, rows))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    sql = registry.CHECK_SQL["op7_licences"]
    ok, note = check.compare(spark, con, queries.op7_licences, sql, folder)
    assert ok, note
    docs = docs_of(spark, rows).withColumn("matches", F.lit(1)).withColumn("line", F.lit(2))
    assert licences.with_matches(docs).columns == docs.columns
    assert licences.with_matches(docs.limit(0)).collect() == []


def in_lines(text, width):
    return "\n".join(textwrap.wrap(text, width))


def brute_windows(text, templates, threshold):
    """{licence: highest dice of any run of words}."""
    words = re.sub("[^a-z0-9]+", " ", text.lower()).split()
    best = {}
    for name, template in templates:
        b = set(licences.template_bigrams(template))
        for i in range(len(words)):
            for j in range(i + 1, len(words) + 1):
                a = set(licences.template_bigrams(" ".join(words[i:j])))
                dice = 2.0 * len(a & b) / (len(a) + len(b))
                if dice >= threshold:
                    best[name] = max(best.get(name, 0), dice)
    return best


def test_wrapped_and_inline_notices_are_found(spark, tmp_path):
    prose = H.prose(random.Random(5), 120)
    by_name = {}
    for name, t in licences.TEMPLATES:
        by_name[name] = max(by_name.get(name, ""), t, key=len)
    planted = [
        (name, text)
        for name, t in by_name.items()
        for text in (
            f"{prose}\n{in_lines(t, 30)}\n{prose}", f"{prose} {t} {prose}",
            f"{prose}\n{in_lines(t, 70)} {prose}", in_lines(f"{prose} {t} {prose}", 25),
        )
    ]
    planted += [
        ("Proprietary", "Copyright (c) 2020 Foo Inc. All rights reserved."),
        ("CC-BY-NC-4.0", "Photos by the author. Licensed under CC BY-NC 4.0. Please cite."),
        ("MIT", "MIT License\n\nCopyright (c) 2020 Foo\n\n" + in_lines(by_name["MIT"], 80)
         + "\n\nThe above copyright notice and this permission notice shall be included in all\n"
         "copies or substantial portions of the Software.\n\n" + prose),
    ]
    rows = [(k, t, None, "s", 1) for k, (_, t) in enumerate(planted)]
    rows.append((len(rows), f"{prose} {by_name['MIT']} {prose} {by_name['MIT']} {prose}", None, "s", 1))
    rows.append((len(rows), f"{prose}\nx {by_name['Proprietary']}\n{prose}", None, "s", 1))
    rows.append((len(rows), prose, None, "s", 1))
    folder = H.write_tables(spark, str(tmp_path), documents=docs_of(spark, rows))
    got = {r.doc_id: r for r in queries.op7_licences(spark, folder).collect()}
    for k, (name, text) in enumerate(planted):
        assert got[k].licence == name and got[k].dice > 0.95, (name, text, got[k])
    twice, second_line, none = (got[k] for k in range(len(planted), len(rows)))
    assert (twice.licence, twice.n_matches, twice.line) == ("MIT", 2, 1)
    assert (second_line.licence, second_line.line) == ("Proprietary", 2)
    assert (none.n_matches, none.licence) == (0, None)


def test_windows_are_the_best_of_all_runs(spark):
    rng = random.Random(8)
    templates = [("A", "a b c d e f"), ("B", "a b a c"), ("C", "d"), ("D", "b c b c b")]
    texts = ["".join(rng.choice("abcdef xy\n") + " " for _ in range(rng.randrange(40))) for _ in range(60)]
    texts += ["x a b c d e f y", "x a b y c d e f x", "x a b c\nd e f x", "x a a b b c d e f x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for one, threshold in itertools.product(templates, (0.6, 0.8)):
        for r in licences.with_matches(docs, [one], threshold).collect():
            best = max((m.dice for m in r.matches), default=None)
            want = brute_windows(r.text, [one], threshold).get(one[0])
            assert (best is None) == (want is None), (r.text, r.matches, want)
            if want and not brute_lines(r.text, [one], threshold):
                assert best == pytest.approx(want)


def brute_lines(text, templates, threshold):
    """Licences of which a line, or the whole text, is a match."""
    out = set()
    for line in [text, *text.split("\n")]:
        a = set(licences.template_bigrams(line))
        for name, template in templates:
            b = set(licences.template_bigrams(template))
            if a and b and 2.0 * len(a & b) / (len(a) + len(b)) >= threshold:
                out.add(name)
    return out


def test_size_bounds_lose_no_match():
    """Sets that just reach the threshold lie within the bounds."""
    for b in range(1, 200):
        low, high = licences._bounds(b, 0.8)
        for a in range(1, 400):
            if 2 * min(a, b) / (a + b) >= 0.8:
                assert low <= a <= high
