"""Crawl events as JSON and page rows as Avro."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom import schema as S

CORRUPT = "_corrupt"
_WITH_CORRUPT = T.StructType(S.CRAWL_EVENT.fields + [T.StructField(CORRUPT, T.StringType())])


def encode(pages: DataFrame, crawled_at: Column) -> DataFrame:
    """(value): parsed pages (url, content) as one JSON event each."""
    event = F.struct(
        F.col("url"), crawled_at.cast("timestamp").alias("timestamp"), F.col("content")
    )
    return pages.select(F.to_json(event).alias("value"))


def decode(lines: DataFrame) -> DataFrame:
    """Adds ``event`` and ``bad`` to rows with a ``value`` of JSON text or bytes."""
    parsed = F.from_json(
        F.col("value").cast("string"),
        _WITH_CORRUPT,
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT},
    )
    return lines.withColumn("event", parsed).withColumn(
        "bad", F.col("event").isNull() | F.col(f"event.{CORRUPT}").isNotNull()
    )


def good_events(decoded: DataFrame) -> DataFrame:
    return decoded.where(~F.col("bad")).select("event.url", "event.timestamp", "event.content")


def rejected(decoded: DataFrame) -> DataFrame:
    """Undecodable records, kept for inspection."""
    return decoded.where("bad").select(F.col("value").cast("string").alias("value"))


def page_avro_value(pages: DataFrame) -> DataFrame:
    """(value): page rows as Avro bytes; needs the spark-avro jar in the session."""
    from pyspark.sql.avro.functions import to_avro

    return pages.select(to_avro(F.struct(*[f.name for f in S.PAGE.fields])).alias("value"))
