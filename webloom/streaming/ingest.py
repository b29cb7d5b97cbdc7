"""Crawl events to the page lake as a stateless stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from webloom.functions.tags import DEFAULT_DICTIONARY, Dictionary
from webloom.operators.tagging import to_page_rows
from webloom.sources import crawl_events, lake
from webloom.sources.snapshots import SnapshotTable

EVENTS_TOPIC = "crawled_data"
FLUSH = "60 seconds"
# Tasks that may share the rows of one folder in a batch.
FOLDER_SPLITS = 8


def file_source(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Lines of JSON event files as they arrive."""
    return spark.readStream.format("text").option("maxFilesPerTrigger", max_files).load(path)


def kafka_source(
    spark: SparkSession,
    servers: str,
    topic: str = EVENTS_TOPIC,
    max_offsets: int = 1_000_000,
    start: str = "earliest",
) -> DataFrame:
    """Event values of a topic; needs the Kafka connector jar in the session.

    A new stream begins with the oldest event still there, or as ``start`` says; a
    restarted one goes on where its checkpoint is.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", start)
        .option("maxOffsetsPerTrigger", max_offsets)
        .load()
        .select("value")
    )


def event_sink(
    pages: DataFrame, crawled_at: Column, checkpoint: str, servers: str, topic: str = EVENTS_TOPIC
) -> StreamingQuery:
    """Publish parsed pages as events to a topic."""
    return (
        crawl_events.encode(pages, crawled_at)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def event_file_sink(
    pages: DataFrame, crawled_at: Column, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Publish parsed pages as event files."""
    writer = (
        crawl_events.encode(pages, crawled_at)
        .writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return start(writer, available_now)


def start(writer, available_now: bool) -> StreamingQuery:
    trigger = {"availableNow": True} if available_now else {"processingTime": FLUSH}
    return writer.trigger(**trigger).start()


def decoded_pages(
    source: DataFrame, date: Column | None = None, dictionary: Dictionary = DEFAULT_DICTIONARY
) -> DataFrame:
    """Tagged page rows of the good events; ``date`` as in ``to_lake``."""
    events = crawl_events.good_events(crawl_events.decode(source))
    moment = F.coalesce("timestamp", F.current_timestamp())
    utc = F.to_utc_timestamp(moment, F.current_timezone())
    day = F.date_format(utc, "yyyy-MM-dd") if date is None else date
    with_day = events.withColumn("_day", day)
    return to_page_rows(with_day, F.col("_day"), dictionary)


def to_lake(
    source: DataFrame,
    lake_path: str,
    checkpoint: str,
    date: Column | None = None,
    dictionary: Dictionary = DEFAULT_DICTIONARY,
    available_now: bool = False,
    domain_buckets: int | None = None,
    file_format: str = "parquet",
) -> StreamingQuery:
    """Decode, tag and append events to the lake, exactly once.

    The file sink logs which files belong to a finished batch, so a batch that is
    run again after a failure adds nothing twice. ``date`` is the crawl day, by
    default the UTC day of the event, or of the batch for events without a time;
    neither changes in a rerun. ``file_format`` may be ``avro`` where its jar is
    there.
    """
    pages = decoded_pages(source, date, dictionary)
    rows = lake.with_partition_columns(pages, domain_buckets)
    spread = F.pmod(F.xxhash64("real_path"), F.lit(FOLDER_SPLITS))
    writer = (
        rows.repartition(*lake.PARTITIONS, spread)
        .writeStream.format(file_format)
        .partitionBy(*lake.PARTITIONS)
        .option("path", lake_path)
        .option("checkpointLocation", checkpoint)
    )
    return start(writer, available_now)


def to_snapshots(
    source: DataFrame,
    table: SnapshotTable,
    checkpoint: str,
    stream: str,
    date: Column | None = None,
    dictionary: Dictionary = DEFAULT_DICTIONARY,
    available_now: bool = False,
) -> StreamingQuery:
    """Decode, tag and append events to a table that is compacted while the stream goes on.

    ``stream`` names the stream in the manifest, which knows its last batch: one that is
    run again after a failure adds nothing twice.
    """

    def add(batch: DataFrame, number: int) -> None:
        table.append(batch, stream, number)

    pages = decoded_pages(source, date, dictionary)
    writer = pages.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return start(writer, available_now)


def rejects_to_files(
    source: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Keep undecodable records in a side folder."""
    writer = (
        crawl_events.rejected(crawl_events.decode(source))
        .writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return start(writer, available_now)
