"""The crawl queue as a stream: roots to fetch, once each and again when they expire.

Events are (domain, kind, at): a ``link`` says that somebody links to the domain, a
``crawled`` that it was fetched. In the order of event time a domain is queued

* at its first link, unless it was fetched before, and
* ``expiry_hours`` after a fetch that no other fetch followed until then.

While it is queued nothing queues it again; a fetch takes it off the queue. At one
moment links come before fetches. What is queued depends on the events alone, not on how
they fall into batches: an event waits in the state until the watermark is past it, and
timers on the watermark bring expired domains back without a new event.

State is a few values per domain (its phase, the moment it expires, waiting events). Domains
are dealt by hash to ``BUCKETS`` groups whose domains share a state row and a timer: a call
into Python costs milliseconds, which a domain's few events do not pay for. The number of
buckets belongs to the checkpoint. A domain to which everybody links costs a few rows per task and batch: each task keeps the
first and the last of its links before the shuffle. Events without a domain or a
time and other kinds are left out. Events older than the watermark come too late and
are dropped; ``delay`` is the time that an event may be late.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from webloom.functions import urls
from webloom.streaming.ingest import start

LINK, CRAWLED = "link", "crawled"
NEW, QUEUED, FETCHED = 0, 1, 2
_EVENT = "domain string, kind string, at timestamp"
_STATE = "domains array<string>, phases array<int>, dues array<long>, links array<long>, fetches array<array<long>>"
# Groups of domains, for up to some hundred million domains.
BUCKETS = 4096


def link_events(links: DataFrame) -> DataFrame:
    """Events of ``links(link, at)``."""
    return links.select(urls.domain(F.col("link")).alias("domain"), F.lit(LINK).alias("kind"), "at")


def fetch_events(pages: DataFrame) -> DataFrame:
    """Events of crawled ``pages(url, timestamp)``."""
    return pages.select(
        urls.domain(F.col("url")).alias("domain"),
        F.lit(CRAWLED).alias("kind"),
        F.col("timestamp").alias("at"),
    )


def _fewer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First and last link of a domain, and its distinct fetches, per Arrow batch."""
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        is_link = pa.compute.equal(rows["kind"], LINK)
        links = rows.filter(is_link).group_by("domain").aggregate([("at", "min"), ("at", "max")])
        fetched = rows.filter(pa.compute.invert(is_link)).group_by(["domain", "at"]).aggregate([])
        domain = pa.chunked_array([*links["domain"].chunks, *links["domain"].chunks], pa.string())
        at = pa.chunked_array([*links["at_min"].chunks, *links["at_max"].chunks], batch["at"].type)
        kept = [
            pa.table({"domain": domain, "kind": pa.array([LINK] * len(domain), pa.string()), "at": at}),
            pa.table(
                {
                    "domain": fetched["domain"],
                    "kind": pa.array([CRAWLED] * len(fetched), pa.string()),
                    "at": fetched["at"],
                }
            ),
        ]
        yield from pa.concat_tables(kept).to_batches()


def advance(
    phase: int, due: int, link: int | None, fetches: list[int], now: int, expiry: int
) -> tuple[list[int], int, int, int | None, list[int]]:
    """Queueings before ``now``, and what waits from then on: phase, due, link, fetches.

    ``link`` is the first waiting link and counts in phase NEW only; all times are in
    microseconds.
    """
    queued: list[int] = []
    waiting = [t for t in fetches if t >= now]
    past = sorted(t for t in fetches if t < now)
    if phase == NEW and link is not None and link < now and (not past or link <= past[0]):
        queued.append(link)
        phase = QUEUED
    for t in past:
        if phase == FETCHED and due < t:
            queued.append(due)
        phase, due = FETCHED, t + expiry
    if phase == FETCHED and due < now:
        queued.append(due)
        phase = QUEUED
    return queued, phase, due, link if phase == NEW else None, waiting


def _step(expiry: int):
    def run(
        key: tuple[int], frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        known = {d: values for d, *values in zip(*state.get)} if state.exists else {}
        for frame in frames:
            # Plain lists: most buckets have few rows, for which columns cost more.
            rows = zip(frame["domain"].tolist(), frame["kind"].tolist(), frame["micros"].tolist())
            for domain, kind, micros in rows:
                values = known.get(domain)
                if values is None:
                    values = known[domain] = [NEW, 0, None, []]
                if kind == CRAWLED:
                    if micros not in values[3]:
                        values[3] = [*values[3], micros]
                elif values[0] == NEW:
                    values[2] = micros if values[2] is None else min(values[2], micros)
        # Before the first watermark everything waits.
        now = max(state.getCurrentWatermarkMs(), 0) * 1000
        domains, moments, timer = [], [], None
        for domain, values in known.items():
            queued, *values[:] = advance(*values, now, expiry)
            domains += [domain] * len(queued)
            moments += queued
            phase, due, link, waiting = values
            times = [*waiting, *([link] if link is not None else []), *([due] if phase == FETCHED else [])]
            if times:
                timer = min(times) if timer is None else min(timer, *times)
        state.update(([*known], *map(list, zip(*known.values()))))
        if timer is not None:
            state.setTimeoutTimestamp(-(-timer // 1000))
        if domains:
            yield pd.DataFrame({"domain": domains, "micros": moments})

    return run


def queue(events: DataFrame, expiry_hours: int = 24, delay: str = "1 hour") -> DataFrame:
    """(domain, queued_at) from a stream of events (domain, kind, at)."""
    known = events.where(
        (F.col("domain") != "") & F.col("at").isNotNull() & F.col("kind").isin(LINK, CRAWLED)
    ).select("domain", "kind", F.col("at").cast("timestamp").alias("at"))
    return (
        known.mapInArrow(_fewer, _EVENT)
        .withColumn("micros", F.unix_micros("at"))
        .withWatermark("at", delay)
        .withColumn("bucket", F.pmod(F.xxhash64("domain"), F.lit(BUCKETS)).cast("int"))
        .groupBy("bucket")
        .applyInPandasWithState(
            _step(expiry_hours * 3_600_000_000),
            "domain string, micros long",
            _STATE,
            "append",
            GroupStateTimeout.EventTimeTimeout,
        )
        .select("domain", F.timestamp_micros("micros").alias("queued_at"))
    )


def queue_to_files(
    events: DataFrame,
    path: str,
    checkpoint: str,
    expiry_hours: int = 24,
    delay: str = "1 hour",
    available_now: bool = False,
) -> StreamingQuery:
    """Append what is queued to Parquet files, exactly once; goes on where it stopped."""
    writer = (
        queue(events, expiry_hours, delay)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return start(writer, available_now)
