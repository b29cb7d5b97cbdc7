"""Session helpers: a local builder, the shared scratch folder, lineage cuts."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and bench runs; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("webloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, named by ``spark.checkpoint.dir``.

    Only a session in one process, as in tests, gets a temporary folder when the
    setting is missing.
    """
    sc = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    if sc.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="webloom-"))
    return sc.getCheckpointDir()


_open_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediate tables made inside, at the end or after an error.

    For work that is finished inside, such as a rebuild. What a function returns as
    a lazy table still needs its files; its caller may open the scope around their
    use.
    """
    paths: list[str] = []
    _open_scopes.append(paths)
    try:
        yield
    finally:
        _open_scopes.remove(paths)
        for path in paths:
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            conf = spark.sparkContext._jsc.hadoopConfiguration()
            target.getFileSystem(conf).delete(target, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path for an intermediate table in the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/webloom/{name}-{uuid.uuid4().hex}"
    if _open_scopes:
        _open_scopes[-1].append(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """The plan restarts from a written table, which outlives any executor."""
    return stage_table(df, "cut")


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write a reused intermediate result as Parquet and read it back.

    Chosen over ``persist`` where several later jobs need the columns: the file
    survives a lost executor, is read column by column, and has exact sizes.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Rows that one task is given to group or to sort.
ROWS_PER_TASK = 2_000_000


def dealt_by(df: DataFrame, *keys: str, rows: int) -> DataFrame:
    """Rows with equal keys in one task, in as many tasks as ``rows`` of them need.

    A fixed number of shuffle partitions would let a task's share grow with the input.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    n = -(-rows // ROWS_PER_TASK)
    return df.repartition(n, *keys) if n > cores else df.repartition(*keys)


def deal_out(df: DataFrame) -> DataFrame:
    """Give every core a share of a small input that arrives in few partitions.

    Input with at least as many partitions as cores, so any large one, stays as it
    is read.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
