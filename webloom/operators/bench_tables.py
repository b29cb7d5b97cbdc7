"""Summaries of load-test results per configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHORTEST_SEC = 0.01


def throughput(size: Column, seconds: Column) -> Column:
    return size / F.greatest(seconds, F.lit(SHORTEST_SEC))


def mean_throughput(storage: DataFrame) -> DataFrame:
    """Per file size and configuration; reads and writes together."""
    return storage.groupBy("File_Size_MB", "config").agg(
        F.avg("Throughput_MB_s").alias("mean_mb_s")
    )


def mean_time(compute: DataFrame) -> DataFrame:
    return compute.groupBy("Iterations", "config").agg(
        F.avg("Real_Execution_Time_sec").alias("mean_sec")
    )


def mean_load(broker: DataFrame) -> DataFrame:
    return broker.groupBy("Load_Level", "config").agg(
        F.avg("Records_Per_Sec").alias("mean_records_per_sec"),
        F.avg("Avg_Latency_ms").alias("mean_latency_ms"),
    )
