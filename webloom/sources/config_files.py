"""JSON inputs beside the pages: tag dictionary and crawl seeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.functions.tags import Dictionary

DICTIONARY_SCHEMA = "keywords map<string,array<string>>, patterns array<string>"
SEEDS_TYPE = "array<map<string,int>>"


def keyword_rows(dictionary: DataFrame) -> DataFrame:
    """(tag, word) of a dictionary record."""
    return dictionary.select(F.explode("keywords").alias("tag", "words")).select(
        "tag", F.explode("words").alias("word")
    )


def pattern_rows(dictionary: DataFrame) -> DataFrame:
    return dictionary.select(F.explode("patterns").alias("pattern"))


def load_dictionary(spark: SparkSession, path: str) -> Dictionary:
    """One dictionary file. It is configuration: one record, read once by the driver."""
    record = (
        spark.read.schema(DICTIONARY_SCHEMA).option("multiLine", "true").json(path).first()
    )
    return Dictionary(dict(record["keywords"] or {}), list(record["patterns"] or []))


def explode_seeds(raw: DataFrame, column: str = "seeds") -> DataFrame:
    """(url, depth) of a JSON list of one-entry objects url -> depth."""
    others = [c for c in raw.columns if c != column]
    return raw.select(
        *others, F.explode(F.from_json(F.col(column), SEEDS_TYPE)).alias("entry")
    ).select(*others, F.explode("entry").alias("url", "depth"))


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """Seeds from a configuration file with a ``seeds`` list."""
    raw = spark.read.schema("seeds array<map<string,int>>").option("multiLine", "true").json(path)
    return raw.select(F.explode("seeds").alias("entry")).select(
        F.explode("entry").alias("url", "depth")
    )
