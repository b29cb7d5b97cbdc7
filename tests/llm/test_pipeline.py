"""The pipeline against brute force, stage by stage."""

import numpy as np

import __spark_entry__ as entry
import corpus_pipeline as P
from tests.llm import helpers as H
from tests.llm.test_dedup import exact_brute
from tests.llm.test_model_ops import check_places
from webloom.llm import mixing, quality_fm, queries
from webloom.session import stage_table

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def through(spark, folder):
    rows = queries.table(spark, folder, "documents")
    tables = [rows]
    for _, stage in P.STAGES:
        rows = stage_table(stage(spark, rows, folder), "stage")
        tables.append(rows)
    return tables


def check_stages(spark, folder, tables):
    docs, good, distinct, apart, mixed, packed = tables
    for t in tables[:-1]:
        assert t.columns[:5] == COLUMNS
    model = queries.quality_model(docs, queries.table(spark, folder, "labels"))
    want = quality_fm.score(docs, model).where("score >= 0.3").select(*COLUMNS)
    assert sorted(map(str, good.select(*COLUMNS).collect())) == sorted(map(str, want.collect()))
    groups, best = exact_brute([(r.doc_id, r.text) for r in good.collect()])
    left = {r.doc_id for r in distinct.collect()}
    assert left == set(best.values()) and distinct.count() == len(groups)
    near = H.brute_near([(r.doc_id, r.text) for r in distinct.collect()])
    assert sorted(r.doc_id for r in apart.collect()) == sorted(i for i, (_, c) in near.items() if i == c)
    labelled = queries.labelled_domains(apart, queries.table(spark, folder, "labels"))
    copies = {r.doc_id: r.copies for r in mixing.rates(apart, labelled, queries.TARGETS).collect()}
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(i for i, n in copies.items() for _ in range(n))
    rows = packed.collect()
    check_places(rows)
    from tests.llm.test_model_ops import tokenizer

    other = tokenizer()
    sizes = sorted(len(other.encode(r.text or "", add_special_tokens=False).ids) + 1 for r in mixed.collect())
    per_doc = {}
    for r in rows:
        per_doc[r.doc] = per_doc.get(r.doc, 0) + r.length
    assert sorted(per_doc.values()) == sizes


def test_stages(spark):
    check_stages(spark, SF, through(spark, SF))


def test_run_is_the_stages(spark):
    assert "pipeline" in entry.queries() and P.ORACLE_SQL is None
    assert [n for n, _ in P.STAGES] == [
        "quality classifier", "exact dedup", "n-gram Jaccard join",
        "mixing sources to target weights", "best-fit packing",
    ]
    rows = P.run(spark, SF).collect()
    check_places(rows)
    assert len(rows) == through(spark, SF)[-1].count()


def test_odd_tables(spark, tmp_path):
    rows = [r for r in H.odd_documents() if r[0] is not None and r[0] != 19]
    docs = spark.createDataFrame(rows, H.DOC_SCHEMA).withColumn("score", np_lit("x"))
    labels = spark.createDataFrame(
        [(k, int(k not in (6, 7)), 0) for k in range(1, 23)], "doc_id long, quality int, toxic int"
    )
    folder = H.write_tables(spark, str(tmp_path / "a"), documents=docs, labels=labels)
    tables = through(spark, folder)
    assert all(t.columns == docs.columns for t in tables[:-1])
    check_places(tables[-1].collect())
    empty = H.write_tables(spark, str(tmp_path / "b"), documents=docs.limit(0), labels=labels.limit(0))
    assert P.run(spark, empty).collect() == []


def np_lit(value):
    from pyspark.sql import functions as F

    return F.lit(value)
