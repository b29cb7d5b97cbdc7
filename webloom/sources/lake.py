"""The page lake: scan of landed files, partitioned write, versioned publish."""

from __future__ import annotations

import time
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom import schema as S

FORMATS = ("parquet", "json", "avro")
PARTITIONS = ("domain_p", "date_p")
_VERSIONS = "_versions"


def has_format(spark: SparkSession, fmt: str) -> bool:
    """Whether a file format can be read here; Avro comes with a separate jar."""
    if fmt != "avro":
        return True
    try:
        spark.read.format("avro").schema("x int").load([])
        return True
    except Exception as e:  # the error class differs between Spark versions
        return "avro" not in str(e).lower()


def scan(
    spark: SparkSession,
    base: str,
    formats: tuple[str, ...] = FORMATS,
    schema: T.StructType = S.SCORED_PAGE,
) -> DataFrame:
    """All files below ``base`` in any known format, as one table.

    The schema is given, so nothing is inferred or merged and columns that a file
    lacks are null. A missing folder or one without such files gives an empty
    table of the same schema.
    """
    parts = []
    for fmt in formats:
        if not has_format(spark, fmt):
            continue
        try:
            parts.append(
                spark.read.format(fmt)
                .schema(schema)
                .option("pathGlobFilter", f"*.{fmt}")
                .option("recursiveFileLookup", "true")
                .load(base)
            )
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
    if not parts:
        return spark.createDataFrame([], schema)
    return reduce(lambda a, b: a.unionByName(b), parts)


def with_partition_columns(pages: DataFrame, domain_buckets: int | None = None) -> DataFrame:
    """Copies of domain and date for the folder names; the files keep both columns.

    With ``domain_buckets`` the first level is a hash bucket of the domain, which
    keeps the number of folders fixed in a lake with very many domains.
    """
    first = domain_folder(F.col("domain"), domain_buckets)
    return pages.withColumn("domain_p", first).withColumn("date_p", F.col("date"))


def domain_folder(domain: Column, domain_buckets: int | None = None) -> Column:
    """Value of ``domain_p`` for a domain."""
    if domain_buckets is None:
        return domain
    return F.pmod(F.xxhash64(domain), F.lit(domain_buckets)).cast("string")


def write_partitioned(pages: DataFrame, path: str, domain_buckets: int | None = None) -> None:
    """Write as ``domain_p=…/date_p=…``.

    The rebalance hint gathers each folder's rows, and splits folders that are
    too big for one task.
    """
    (
        with_partition_columns(pages, domain_buckets)
        .hint("rebalance", *PARTITIONS)
        .write.partitionBy(*PARTITIONS)
        .mode("errorifexists")
        .parquet(path)
    )


def read_partitioned(
    spark: SparkSession, path: str, schema: T.StructType = S.SCORED_PAGE
) -> DataFrame:
    """Read with folder discovery: filters on ``domain_p`` and ``date_p`` skip folders."""
    full = T.StructType(schema.fields + [T.StructField(c, T.StringType()) for c in PARTITIONS])
    return spark.read.schema(full).parquet(path)


# ------------------------------------------------------------------ versions


LOG_SCHEMA = "version bigint, folder string, domain_buckets int"


def current(spark: SparkSession, base: str) -> Row | None:
    """Newest line of the version log (version, folder, domain_buckets), None without one.

    Of two writers that took the same number the one with the greater folder name
    counts; each wrote a folder of its own.
    """
    try:
        log = spark.read.schema(LOG_SCHEMA).json(f"{base}/{_VERSIONS}")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None
    return log.agg(F.max(F.struct("version", "folder", "domain_buckets")).alias("newest")).first()[0]


def current_version(spark: SparkSession, base: str) -> int | None:
    """Number of the newest published version, None if there is none."""
    line = current(spark, base)
    return None if line is None else line["version"]


def new_version(spark: SparkSession, base: str) -> tuple[int, str]:
    """The next number and a folder name that no other attempt has.

    What a failed attempt leaves behind is never read and stands in nobody's way.
    """
    version = (current_version(spark, base) or 0) + 1
    return version, f"v={version}-{uuid.uuid4().hex}"


def commit_version(
    spark: SparkSession, base: str, version: int, folder: str, domain_buckets: int | None = None
) -> None:
    """Make a fully written version the current one.

    One line is appended to the version log; nothing is renamed or deleted, so
    readers see the old version until then and the new one afterwards.
    """
    row = spark.range(1).select(
        F.lit(version).cast("bigint").alias("version"),
        F.lit(folder).alias("folder"),
        F.lit(domain_buckets).cast("int").alias("domain_buckets"),
    )
    row.write.mode("append").json(f"{base}/{_VERSIONS}")


def publish(pages: DataFrame, base: str, domain_buckets: int | None = None) -> int:
    """Write the pages as the next version of the lake and make it current."""
    spark = pages.sparkSession
    version, folder = new_version(spark, base)
    write_partitioned(pages, f"{base}/{folder}", domain_buckets)
    commit_version(spark, base, version, folder, domain_buckets)
    return version



def expire_versions(spark: SparkSession, base: str, age: float) -> int:
    """Remove folders of versions that were replaced more than ``age`` seconds ago, and of
    attempts that were never published and are older than that. Returns their number.

    The current version always stays. ``age`` has to exceed the longest reader and the
    longest rebuild. The log keeps its lines, so numbers are not used again.
    """
    limit = time.time() - age
    try:
        log = spark.read.schema(LOG_SCHEMA).json(f"{base}/{_VERSIONS}")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return 0
    at = F.unix_micros("_metadata.file_modification_time") / 1e6
    lines = log.select("version", "folder", at.alias("at")).orderBy("version", "folder").collect()
    nexts = lines[1:] + [None]
    kept = {now["folder"] for now, after in zip(lines, nexts) if after is None or after["at"] >= limit}
    return remove_unnamed(spark, base, kept, "v=", limit)


def remove_unnamed(spark: SparkSession, base: str, names: set[str], prefix: str, limit: float) -> int:
    """Remove folders of ``base`` with ``prefix`` that are not in ``names`` and have not been
    touched since ``limit`` (seconds since 1970). Returns their number."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    n = 0
    for status in fs.listStatus(root) if fs.exists(root) else ():
        name = status.getPath().getName()
        if not name.startswith(prefix) or name in names:
            continue
        if status.getModificationTime() / 1000 < limit:
            fs.delete(status.getPath(), True)
            n += 1
    return n


def open_current(
    spark: SparkSession, base: str, schema: T.StructType = S.SCORED_PAGE
) -> DataFrame:
    """The published lake; an empty table of the same schema before the first publish."""
    line = current(spark, base)
    if line is None:
        full = T.StructType(schema.fields + [T.StructField(c, T.StringType()) for c in PARTITIONS])
        return spark.createDataFrame([], full)
    return read_partitioned(spark, f"{base}/{line['folder']}", schema)
