"""Toxicity: features, trees and calibration on known cases, accuracy on held-out rows."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.llm import helpers as H
from webloom.llm import toxicity as X
from webloom.llm import words as W

SF = "/root/testdata/sf0.1"


def texts(*values):
    return W.texts_of(pa.array(values, pa.string()))


def unmasked(text):
    data, words, changed = X.unmask(texts(text))
    found = [bytes(data[a:b]).decode() for a, b in zip(words.starts, words.ends)]
    return [w for w, c in zip(found, changed) if c]


def test_unmask():
    assert unmasked("a st00pid m0ron, 1d10t") == ["stoopid", "moron", "idiot"]
    assert unmasked("looooser and trash") == ["loser"]
    assert unmasked("you s.t.u.p.i.d one") == ["stupid"]
    assert unmasked("l o s e r") == ["loser"]
    assert unmasked("2024 10 50 x y plain 7") == []
    assert unmasked("") == [] and unmasked("!!! ... 111") == []
    # Nothing crosses from one text to the next.
    data, words, changed = X.unmask(texts("a b", "c d e", "oo", "o", ""))
    assert np.diff(words.first).tolist() == [2, 1, 1, 1, 0]
    assert changed.tolist() == [False, False, True, False, False]


def lexicon(*words):
    data, w = X.plain_words(texts(*words))
    found = np.sort(w.hashes)
    return X.Lexicon(found, np.full(len(found), 5.0))


def feature(text, name):
    value = X.features(texts(text), lexicon("moron", "scum"), 5)
    return value[0, X.FEATURES.index(name)]


def test_features():
    assert feature("You are a moron", "near_you") == np.log1p(1)
    assert feature("You are a moron", "closest") == 3
    assert feature("you one two three four five six moron", "near_you") == 0
    assert feature("moron", "closest") == 50
    assert feature("ah MORON ah ah", "plain_density_0") == 0.25
    assert feature("ah MORON ah ah", "capital_hits") == 1
    assert feature("ah m0r0n", "masked_density_0") == 0.5
    assert feature("ah m0r0n", "plain_density_0") == 0
    assert feature("a!! b?!", "exclamations") == 3 / 7
    assert feature("f**l d*mn *", "starred_words") == 2 / 4  # masked words of four
    for text in ("", " \n", "\0", "é" * 10, "?"):
        assert np.isfinite(X.features(texts(text), lexicon("moron"), 5)).all()


def test_features_do_not_depend_on_the_block():
    rng = random.Random(2)
    many = [H.prose(rng, rng.randrange(40), 30) + rng.choice(["", " you w1", "!!", " w2 M0RON"]) for _ in range(60)]
    lex = lexicon("w1", "w2", "moron")
    whole = X.features(texts(*many), lex, 5)
    assert np.allclose(whole, np.vstack([X.features(texts(t), lex, 5) for t in many]))


def test_boosting_and_calibration():
    rng = np.random.default_rng(4)
    bins = rng.integers(0, 32, (3_000, 5))
    label = ((bins[:, 1] > 20) ^ (bins[:, 3] < 8)).astype(float)
    s = X.Settings()
    trees = X.boost(bins, label, s)
    assert ((trees.raw(bins) > 0) == (label > 0)).mean() > 0.99
    raw = rng.normal(size=4_000)
    chance = 1 / (1 + np.exp(-3 * raw))
    x, y = X.isotonic(raw, (rng.random(4_000) < chance).astype(float))
    assert (np.diff(x) > 0).all() and (np.diff(y) > 0).all()
    assert np.abs(np.interp(raw, x, y) - chance).mean() < 0.05


def test_held_out_rows(spark):
    found = entry.queries()["op12_toxicity"](spark, SF)
    assert found.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    rows = found.where("held_out").join(labels, "doc_id").collect()
    caught = [r.predicted for r in rows if r.toxic == 1]
    clean = [r.predicted for r in rows if r.toxic == 0]
    assert sum(caught) / len(caught) > 0.9 and sum(clean) / len(clean) < 0.005
    assert np.mean([(r.score - r.toxic) ** 2 for r in rows]) < 0.02


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_odd_rows(spark, tmp_path):
    rng = random.Random(8)
    rows = H.odd_documents()
    rows += [(100 + k, H.prose(rng, 30) + (" scumbag" if k % 3 == 0 else ""), None, None, 1) for k in range(90)]
    docs = spark.createDataFrame(rows, H.DOC_SCHEMA).withColumn("score", F.lit("s")).withColumn("label", F.lit(7))
    labels = [(100 + k, 1, int(k % 3 == 0)) for k in range(90)]
    labels += [(None, 1, 1), (5, None, None), (6, 1, 0), (101, 1, 0), (999, 1, 1), (7, 0, 2)]
    folder = H.write_tables(spark, str(tmp_path), documents=docs, labels=labelled(spark, labels))
    found = entry.queries()["op12_toxicity"](spark, folder).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found)
    right = {r.doc_id: r.predicted for r in found if r.doc_id and r.doc_id >= 100}
    assert sum(right[100 + k] == (k % 3 == 0) for k in range(90)) > 85
    kept = X.score(docs, X.train(docs, labelled(spark, labels)))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "label", "score"]


def test_one_class_and_empty(spark):
    docs = spark.createDataFrame([(1, "a", None, None, 1), (2, None, None, None, None)], H.DOC_SCHEMA)
    for labels, want in (([], 0.0), ([(1, 1, 1)], 1.0), ([(1, 1, 0), (2, 1, 0)], 0.0)):
        model = X.train(docs, labelled(spark, labels))
        assert [r.score for r in X.score(docs, model).collect()] == [want, want]
        assert X.score(docs.limit(0), model).count() == 0
    tiny = X.train(docs, labelled(spark, [(1, 1, 1), (2, 1, 0)]))
    assert all(0 <= r.score <= 1 for r in X.score(docs, tiny).collect())
