"""Table schemas. Every array may be null: writers may leave empty lists out."""

from __future__ import annotations

from pyspark.sql import types as T

_STRINGS = T.ArrayType(T.StringType())


def _record(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, _STRINGS) for n in names])


LINKS = _record("http", "https", "files", "internal")
METADATA = _record("charset", "logo", "scripts", "styles", "title").add(
    "other", T.MapType(T.StringType(), _STRINGS)
)
IMGS = _record("imgs")
TEXTS = _record("h1", "h2", "p")

CONTENT = T.StructType(
    [
        T.StructField("links", LINKS),
        T.StructField("metadata", METADATA),
        T.StructField("imgs", IMGS),
        T.StructField("texts", TEXTS),
    ]
)

CRAWL_EVENT = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("content", CONTENT),
    ]
)

PAGE = T.StructType(
    [
        T.StructField("domain", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("real_path", T.StringType()),
        T.StructField("tags", _STRINGS),
        T.StructField("content", CONTENT),
    ]
)

SCORED_PAGE = T.StructType(
    PAGE.fields
    + [
        T.StructField("url", T.StringType()),
        T.StructField("external_refs", T.LongType()),
        T.StructField("pagerank", T.DoubleType()),
    ]
)

POSTING = T.StructType(
    [
        T.StructField("token", T.StringType()),
        T.StructField("doc_key", T.LongType()),
        T.StructField("tf", T.LongType()),
        T.StructField("pagerank", T.DoubleType()),
    ]
)

MAPPING = T.StructType(
    [
        T.StructField("doc_key", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("external_refs", T.LongType()),
        T.StructField("pagerank", T.DoubleType()),
    ]
)

IDF = T.StructType(
    [
        T.StructField("token", T.StringType()),
        T.StructField("doc_freq", T.LongType()),
        T.StructField("idf", T.DoubleType()),
    ]
)
