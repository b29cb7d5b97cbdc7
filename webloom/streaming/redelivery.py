"""Redelivered and late records of an event stream.

A broker that delivers at least once sends a record again after a consumer was lost,
within a bounded time. ``arrived`` is when the broker took the record (its own time
stamp, or the landing time of a file). Records with equal values that arrive within
``within`` of each other are one: Spark's state keeps a hash of each value until the
watermark over ``arrived`` is past it. The hash spreads the records, so no key is hot;
of a record only the hash stays in the state.

A delivery is late when it arrived more than ``lateness_hours`` after the end of the
UTC day of its event: the snapshot of that day may be closed by then. Late deliveries go
to a side table, together with their arrival, and not to the lake. Each delivery is
judged alone and repeats are looked for on either side, so the result does not depend
on how deliveries fall into batches: the lake has every record with a timely
delivery once, the side table every record with a late one once. Events without a
time are never late. Records without a value or arrival are left to
``ingest.rejects_to_files``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from webloom.sources import crawl_events
from webloom.streaming import ingest

WITHIN = "2 hours"
LATENESS_HOURS = 6


def once(source: DataFrame, within: str = WITHIN) -> DataFrame:
    """``source(value, arrived)`` without records that were delivered before."""
    return (
        source.where(F.col("value").isNotNull() & F.col("arrived").isNotNull())
        .withColumn("_id", F.sha2(F.col("value").cast("binary"), 256))
        .withWatermark("arrived", within)
        .dropDuplicatesWithinWatermark(["_id"])
        .drop("_id")
    )


def is_late(moment: Column, arrived: Column, lateness_hours: int = LATENESS_HOURS) -> Column:
    """Whether an event of ``moment`` arrived after its UTC day was closed."""
    zone = F.current_timezone()
    day_end = F.date_trunc("day", F.to_utc_timestamp(moment, zone)) + F.make_dt_interval(
        days=F.lit(1), hours=F.lit(lateness_hours)
    )
    return F.coalesce(F.to_utc_timestamp(arrived, zone) > day_end, F.lit(False))


def _late(lateness_hours: int) -> Column:
    moment = F.from_json(F.col("value").cast("string"), "timestamp timestamp")["timestamp"]
    return is_late(moment, F.col("arrived"), lateness_hours)


def to_lake(
    source: DataFrame,
    lake_path: str,
    checkpoint: str,
    within: str = WITHIN,
    lateness_hours: int = LATENESS_HOURS,
    **lake_options,
) -> StreamingQuery:
    """``ingest.to_lake`` for ``source(value, arrived)``, without repeats and late events."""
    timely = once(source.where(~_late(lateness_hours)), within)
    return ingest.to_lake(timely.select("value"), lake_path, checkpoint, **lake_options)


def late_to_files(
    source: DataFrame,
    path: str,
    checkpoint: str,
    within: str = WITHIN,
    lateness_hours: int = LATENESS_HOURS,
    available_now: bool = False,
) -> StreamingQuery:
    """Late events (url, timestamp, content, arrived) of the same source as a side table."""
    decoded = crawl_events.decode(once(source.where(_late(lateness_hours)), within))
    writer = (
        decoded.where(~F.col("bad"))
        .select("event.url", "event.timestamp", "event.content", "arrived")
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return ingest.start(writer, available_now)
