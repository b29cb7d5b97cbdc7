"""Streams with state: the crawl queue, and deliveries that repeat or come late."""

import datetime as dt
import json

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from webloom.sources import lake
from webloom.streaming import crawl_queue, redelivery

HOUR = 3_600_000_000
T0 = dt.datetime(2025, 1, 1, tzinfo=dt.timezone.utc)


def replay(links, fetches, now, expiry):
    """What is queued before ``now``, from all events at once."""
    fetches = sorted(set(fetches))
    out = []
    if links and (not fetches or min(links) <= fetches[0]):
        out.append(min(links))
    for this, following in zip(fetches, [*fetches[1:], None]):
        if following is None or following > this + expiry:
            out.append(this + expiry)
    return sorted(t for t in out if t < now)


moments = st.lists(st.tuples(st.sampled_from(["link", "crawled"]), st.integers(0, 60)), max_size=12)


@settings(max_examples=300, deadline=None)
@given(moments, st.lists(st.integers(0, 70), max_size=5), st.integers(1, 20))
def test_order_of_batches_does_not_count(events, marks, expiry):
    """Events in any batch before the watermark passes them give the same queue."""
    phase, due, link, fetches, got = crawl_queue.NEW, 0, None, [], []
    seen = -1
    for now in [*sorted(marks), 1_000]:
        for kind, t in events:
            if seen <= t < now:
                if kind == "link":
                    link = t if link is None else min(link, t)
                else:
                    fetches.append(t)
        seen = max(seen, now)
        queued, phase, due, link, fetches = crawl_queue.advance(phase, due, link, fetches, now, expiry)
        got += queued
    want = replay(
        [t for k, t in events if k == "link"], [t for k, t in events if k == "crawled"], 1_000, expiry
    )
    assert sorted(got) == want


def run_queue(spark, base, rows):
    if rows is not None:
        events = spark.createDataFrame(
            [(d, k, T0 + dt.timedelta(hours=h)) for d, k, h in rows],
            "domain string, kind string, at timestamp",
        )
        events.write.mode("append").parquet(f"{base}/in")
    source = spark.readStream.schema("domain string, kind string, at timestamp").parquet(f"{base}/in")
    crawl_queue.queue_to_files(
        source, f"{base}/out", f"{base}/state", expiry_hours=24, available_now=True
    ).awaitTermination()
    got = spark.read.schema("domain string, queued_at timestamp").parquet(f"{base}/out")
    hours = (F.unix_timestamp("queued_at") - int(T0.timestamp())) / 3600
    return sorted(map(tuple, got.select("domain", hours.cast("int")).collect()))


def test_queue_goes_on_after_a_restart(spark, tmp_path):
    first = [("a", "link", 2), ("a", "link", 1), ("b", "crawled", 1), ("b", "link", 2), (None, "link", 1),
             ("", "link", 1), ("e", "other", 1), ("c", "link", 5), ("c", "link", 5), ("z", "link", 9)]
    assert run_queue(spark, tmp_path, first) == [("a", 1), ("c", 5)]
    # Nothing new: nothing again.
    assert run_queue(spark, tmp_path, None) == [("a", 1), ("c", 5)]
    # "a" is fetched and expires; "b" expires by its timer alone, no event of it is there.
    got = run_queue(spark, tmp_path, [("a", "crawled", 10), ("a", "link", 11), ("z", "link", 40)])
    assert got == [("a", 1), ("a", 34), ("b", 25), ("c", 5), ("z", 9)]


def test_hot_domain_is_cut_down_before_the_shuffle():
    import pyarrow as pa

    n = 5_000
    at = pa.array([T0 + dt.timedelta(seconds=k) for k in range(n)], pa.timestamp("us", "UTC"))
    kinds = ["crawled" if k % 2_500 == 7 else "link" for k in range(n)]
    batch = pa.RecordBatch.from_arrays([pa.array(["hot"] * n), pa.array(kinds), at], ["domain", "kind", "at"])
    rows = pa.Table.from_batches(list(crawl_queue._fewer([batch]))).to_pylist()
    assert sorted((r["kind"], r["at"]) for r in rows) == [
        ("crawled", at[7].as_py()), ("crawled", at[2507].as_py()),
        ("link", at[0].as_py()), ("link", at[n - 1].as_py()),
    ]


def event(n, day=1):
    return json.dumps({
        "url": f"https://s.es/{n}", "timestamp": f"2025-01-0{day}T10:00:0{n}Z",
        "content": {"links": None, "metadata": None, "imgs": None, "texts": {"h1": [str(n)]}},
    })


def deliver(spark, base, rows):
    moment = lambda day, hour: dt.datetime(2025, 1, day, hour, tzinfo=dt.timezone.utc)
    spark.createDataFrame(
        [(v, moment(*when) if when else None) for v, when in rows], "value string, arrived timestamp"
    ).write.mode("append").parquet(f"{base}/in")
    source = spark.readStream.schema("value string, arrived timestamp").parquet(f"{base}/in")
    redelivery.to_lake(source, f"{base}/lake", f"{base}/s1", available_now=True).awaitTermination()
    redelivery.late_to_files(source, f"{base}/late", f"{base}/s2", available_now=True).awaitTermination()
    late = spark.read.schema("url string, timestamp timestamp").parquet(f"{base}/late")
    return (
        sorted(r.real_path for r in lake.scan(spark, f"{base}/lake").collect()),
        sorted(r.url for r in late.collect()),
    )


def test_repeats_and_late_records(spark, tmp_path):
    first = [(event(1), (1, 10)), (event(1), (1, 11)), (event(2), (1, 10)), (event(3), (3, 0)),
             (None, (1, 10)), ("broken", (1, 10)), (event(4), None)]
    assert deliver(spark, tmp_path, first) == (["/1", "/2"], ["https://s.es/3"])
    # After a restart: 2 again within two hours of its first arrival, 5 for the first time.
    again = [(event(2), (1, 11)), (event(5), (1, 12)), (event(3), (3, 1))]
    assert deliver(spark, tmp_path, again) == (["/1", "/2", "/5"], ["https://s.es/3"])


def test_late_only_after_the_day_is_closed(spark):
    rows = spark.sql(
        "SELECT timestamp'2025-01-01 23:59:59' AS m, explode(array(timestamp'2025-01-02 06:00:00', "
        "timestamp'2025-01-02 06:00:01', null)) AS a UNION ALL SELECT null, timestamp'2025-01-09 00:00:00'"
    )
    got = [r[0] for r in rows.select(redelivery.is_late(F.col("m"), F.col("a"))).collect()]
    assert got == [False, True, False, False]


def test_domains_of_a_bucket_do_not_mix(spark, tmp_path, monkeypatch):
    """All domains in one state row give the same as each in its own."""
    monkeypatch.setattr(crawl_queue, "BUCKETS", 1)
    rows = [(f"d{n}", "link" if n % 3 else "crawled", n % 7) for n in range(40)]
    rows += [(f"d{n}", "crawled", 9) for n in range(0, 40, 4)] + [("z", "link", 20)]
    got = run_queue(spark, tmp_path / "a", rows) and run_queue(spark, tmp_path / "a", [("z", "link", 90)])
    want = []
    for n in range(40):
        links = [h for d, k, h in rows if d == f"d{n}" and k == "link"]
        fetches = [h for d, k, h in rows if d == f"d{n}" and k == "crawled"]
        want += [(f"d{n}", h) for h in replay(links, fetches, 89, 24)]
    assert got == sorted([*want, ("z", 20)])
