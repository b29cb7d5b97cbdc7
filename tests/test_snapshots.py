"""The snapshot table: batches, compaction while others write and read, expiry."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from webloom import schema as S
from webloom.sources import lake
from webloom.sources.snapshots import Conflict, SnapshotTable
from webloom.streaming import ingest

ALL = ["domain", "real_path", "date", "n"]
SCHEMA = "domain string, real_path string, date string, n bigint, path string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)


def table(spark, path, **kw):
    from pyspark.sql import types as T

    return SnapshotTable(spark, str(path), T._parse_datatype_string(SCHEMA), **kw)


def content(df):
    return sorted(map(tuple, df.select(*ALL).collect()), key=repr)


def batch(i):
    """A third of all rows in one folder, repeated rows, nulls, odd names."""
    odd = [(None, "/x", None, i), ("a:b/c%3A", "/ü", "", i), ("a.es", "/r", "2024-01-01", 0)]
    return odd + [(f"d{k % 3 or k}.es", f"/{k}", "2024-01-01", i) for k in range(12)]


def test_empty(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    assert t.read().count() == 0 and not t.compact() and t.expire(0) == (0, 0)
    t.append(pages(spark, []))
    assert t.read().count() == 0 and t.current()["live"] == []


def test_rows_stay_through_compaction(spark, tmp_path):
    t = table(spark, tmp_path / "t", fanout=3)
    want = []
    for i in range(7):
        t.append(pages(spark, batch(i)))
        want += batch(i)
        while t.compact():
            pass
    assert content(t.read()) == sorted(want, key=repr)
    assert len(t.current()["live"]) < 5
    some = t.read().where("domain_p = 'd0.es' AND date_p = '2024-01-01'")
    assert content(some) == sorted((r for r in want if r[0] == "d0.es"), key=repr)


def test_bins_bound_files(spark, tmp_path):
    probe = table(spark, tmp_path / "probe")
    probe.append(pages(spark, [("a.es", "/r", "2024-01-01", 1)]))
    one = probe.files([probe.current()["live"][0]["gen"]]).first()["bytes"]
    t = table(spark, tmp_path / "t", target=3 * one, fanout=8)
    for i in range(8):
        t.append(pages(spark, [("a.es", "/r", "2024-01-01", i)]))
    old = {g["gen"] for g in t.current()["live"]}
    t.swap(list(old), made := t.rewrite(list(old)))
    files = t.files([made["gen"]]).collect()
    # Three files each go to the first bins; no bin is split or shares its file.
    assert len(files) == len({f["bin"] for f in files}) == 3
    assert max(f["bytes"] for f in files) <= 4 * one
    assert sorted(r[3] for r in content(t.read())) == list(range(8))


def test_writers_and_readers_meanwhile(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    for i in range(4):
        t.append(pages(spark, batch(i)))
    reader = t.read()
    due = t.due()
    assert len(due) == 4
    made, rival = t.rewrite(due), t.rewrite(due)
    t.append(pages(spark, batch(4)))  # the stream goes on before the swap
    t.swap(due, made)
    with pytest.raises(Conflict):
        t.swap(due, rival)
    assert len(content(t.read())) == 5 * len(batch(0))
    assert content(reader) == sorted(sum(map(batch, range(4)), []), key=repr)
    assert content(t.read(version=5)) == content(t.read())


def test_two_writers_of_one_version(spark, tmp_path, monkeypatch):
    t, other = table(spark, tmp_path / "t"), table(spark, tmp_path / "t")
    put, rivals = t._put, [1]

    def late(line):
        while rivals:
            other.append(pages(spark, batch(rivals.pop())))
        return put(line)

    monkeypatch.setattr(t, "_put", late)
    t.append(pages(spark, batch(0)))
    assert content(t.read()) == sorted(batch(0) + batch(1), key=repr)
    assert t.current()["version"] == 2


def test_repeated_batch_of_a_stream(spark, tmp_path):
    t = table(spark, tmp_path / "t", fanout=2)
    t.append(pages(spark, batch(0)), "s", 0)
    t.append(pages(spark, batch(1)), "s", 1)
    t.compact()
    t.append(pages(spark, batch(1)), "s", 1)
    t.append(pages(spark, batch(0)), "other", 0)
    assert len(content(t.read())) == 3 * len(batch(0))


def test_expiry(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    for i in range(4):
        t.append(pages(spark, batch(i)))
    reader = t.read()
    failed = t._written(
        lake.with_partition_columns(pages(spark, batch(9))).withColumn("bin", F.lit(0).cast("bigint"))
    )
    assert t.compact()
    folders = lambda: set(os.listdir(tmp_path / "t" / "data"))
    assert t.expire(3600) == (0, 0) and len(folders()) == 6
    assert len(content(reader)) == 4 * len(batch(0))  # an open reader within the age
    time.sleep(0.1)
    assert t.expire(0) == (4, 5)
    assert folders() == {f"gen={t.current()['live'][0]['gen']}"} and failed["gen"] not in str(folders())
    assert content(t.read()) == sorted(sum(map(batch, range(4)), []), key=repr)
    t.append(pages(spark, batch(4)))
    assert t.current()["version"] == 6
    with pytest.raises(ValueError):
        t.read(version=1)


def test_expired_versions_of_the_lake(spark, tmp_path):
    base = str(tmp_path / "lake")
    assert lake.expire_versions(spark, base, 0) == 0
    rows = spark.createDataFrame([], S.SCORED_PAGE)
    rows = spark.createDataFrame([{"domain": "a.es", "date": "2024-01-01"}], S.SCORED_PAGE)
    for n in (1, 2, 3):
        lake.publish(rows.withColumn("real_path", F.lit(f"/{n}")), base)
    os.makedirs(f"{base}/v=4-failed/pages")
    reader = lake.open_current(spark, base)
    assert lake.expire_versions(spark, base, 3600) == 0
    time.sleep(0.1)
    assert lake.expire_versions(spark, base, 0) == 3
    assert [r.real_path for r in reader.collect()] == ["/3"]
    assert lake.publish(rows, base) == 4


def test_stream_restart(spark, tmp_path):
    event = {"timestamp": "2025-01-02T10:00:00Z", "content": {"texts": {"h1": ["X"]}}}
    (tmp_path / "in").mkdir()
    t = SnapshotTable(spark, str(tmp_path / "t"), fanout=2)

    def run(n, state="state"):
        for k in range(n):
            line = json.dumps({**event, "url": f"https://a{k % 2}.es/{k}"})
            (tmp_path / "in" / f"{k}.json").write_text(line + "\n")
        source = ingest.file_source(spark, f"{tmp_path}/in", 1)
        ingest.to_snapshots(source, t, f"{tmp_path}/{state}", "crawl", available_now=True).awaitTermination()

    run(2)
    t.compact()
    run(3)
    assert sorted(r.real_path for r in t.read().collect()) == ["/0", "/1", "/2"]
    run(3, "state-lost")  # all batches are delivered again under their old numbers
    assert t.read().count() == 3
