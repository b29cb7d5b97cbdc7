"""Result files of platform load tests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STORAGE = (
    "Timestamp string, Test_Type string, File_Size_MB int, Duration_Sec double, "
    "Throughput_MB_s double"
)
COMPUTE = "Timestamp string, Load_Level string, Iterations int, Real_Execution_Time_sec int"
BROKER = (
    "Timestamp string, Load_Level string, Records bigint, Records_Per_Sec double, "
    "MB_Per_Sec double, Avg_Latency_ms double, Max_Latency_ms double, "
    "`50th_Percentile_ms` double"
)

# "5000 records sent, 49.5 records/sec (4.7 MB/sec), 2.0 ms avg latency, 9.0 ms max
# latency, 1 ms 50th, ..."
_NUMBER = r"([0-9.]+(?:[eE][-+]?[0-9]+)?)"
PERF_LINE = (
    rf"{_NUMBER} records sent, {_NUMBER} records/sec \({_NUMBER} MB/sec\), "
    rf"{_NUMBER} ms avg latency, {_NUMBER} ms max latency, {_NUMBER} ms 50th"
)


def config_label(path: Column) -> Column:
    """File name parts from the fourth on; the whole name if there are fewer."""
    name = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.csv$", "")
    parts = F.split(name, "_")
    return F.when(
        F.size(parts) > 3, F.array_join(F.slice(parts, 4, F.size(parts)), "_")
    ).otherwise(name)


def read_results(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """All result files that match a glob, each row labelled from its file name.

    Columns are found by the names in each file's header, whatever their order; other
    columns are ignored. A file whose header lacks a column is refused.
    """
    wanted = T.StructType.fromDDL(schema)
    lines = spark.read.text(pattern).select("value", F.col("_metadata.file_path").alias("path"))
    names = F.transform(F.split("value", ","), lambda n: F.btrim(n, F.lit(' "\r')))
    is_header = F.size(F.array_intersect(names, F.array(*map(F.lit, wanted.names)))) == len(wanted)
    headers = lines.where(is_header).select("path", "value").distinct()
    without = lines.select("path").distinct().join(headers, "path", "left_anti").head(3)
    if without:
        raise ValueError(f"no header with {wanted.names} in {[r.path for r in without]}")
    parts = []
    # One row per way of writing the header, of which there are a few.
    for layout in headers.select("value").distinct().collect():
        found = [n.strip(' "\r') for n in layout.value.split(",")]
        text = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(found))])
        rows = lines.join(headers.where(F.col("value") == layout.value).select("path"), "path")
        parsed = rows.where(F.col("value") != layout.value).select(
            "path", F.from_csv("value", F.lit(text.simpleString()[7:-1].replace(":", " "))).alias("row")
        )
        parts.append(
            parsed.select(
                *[
                    F.expr(f"try_cast(row.c{found.index(f.name)} AS {f.dataType.simpleString()})")
                    .alias(f.name)
                    for f in wanted
                ],
                config_label(F.col("path")).alias("config"),
            )
        )
    if not parts:
        return spark.createDataFrame([], T.StructType([*wanted, T.StructField("config", T.StringType())]))
    return reduce(lambda a, b: a.unionByName(b), parts)


def parse_perf_lines(lines: DataFrame) -> DataFrame:
    """Typed columns of broker test summary lines in ``value``; other lines are dropped."""
    field = lambda i, t: F.regexp_extract("value", PERF_LINE, i).cast(t)
    others = [c for c in lines.columns if c != "value"]
    return lines.where(F.col("value").rlike(PERF_LINE)).select(
        *others,
        field(1, "bigint").alias("records"),
        field(2, "double").alias("records_per_sec"),
        field(3, "double").alias("mb_per_sec"),
        field(4, "double").alias("avg_latency_ms"),
        field(5, "double").alias("max_latency_ms"),
        field(6, "double").alias("p50_latency_ms"),
    )
