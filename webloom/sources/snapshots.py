"""A page table that grows by small batches: folders, a manifest, compaction, expiry.

Rows lie in ``data/gen=…/domain_p=…/date_p=…/bin=…``. A generation is what one batch or one
compaction wrote; it is never changed. A line of the manifest names all live generations, so
a reader sees one version, whatever is written or compacted meanwhile. Lines are put in place
by a rename that fails where the name is taken, so of two writers of one version one has to
look again: an added generation goes on top of the newer line, a compaction does so only if
all it has read is still live.

``compact`` joins generations as soon as ``fanout`` of them have one tier, a power of
``fanout`` in bytes, so a row is rewritten once per tier, a logarithmic number of times. A
generation whose files have half the target on average is settled and never read again.
Files of one folder are dealt to bins by a running sum of their sizes; a bin becomes one
file, written by one task, from less than ``target`` and its last file. So a folder with
very many rows has many bins, and what a task holds does not depend on the table's size.

``expire`` removes generations that no kept line names: those of compacted batches, and those
of attempts that failed. Lines are kept while they were current within ``age`` seconds, which
has to exceed the longest reader and the longest write.

Defined results: before the first batch the table is empty. An empty batch is a line without
a new generation. Null domains and days have folders of their own. Equal rows all stay. A
batch of a stream that is delivered again (same number or less) is ignored.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom import schema as S
from webloom.sources.lake import PARTITIONS, remove_unnamed, with_partition_columns

FANOUT = 4
TARGET_BYTES = 256 << 20
_LOG, _DATA = "_snapshots", "data"
GENERATION = "gen string, bytes bigint, files bigint"
LINE = f"version bigint, at double, streams map<string, bigint>, live array<struct<{GENERATION}>>"


class Conflict(RuntimeError):
    """What a compaction has read is no longer live."""


@dataclass
class SnapshotTable:
    spark: SparkSession
    base: str
    schema: T.StructType = field(default_factory=lambda: S.SCORED_PAGE)
    domain_buckets: int | None = None
    fanout: int = FANOUT
    target: int = TARGET_BYTES

    # ------------------------------------------------------------- manifest

    def lines(self) -> DataFrame:
        """All lines of the manifest that have not expired."""
        try:
            return self.spark.read.schema(LINE).json(f"{self.base}/{_LOG}/line=*")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], LINE)

    def current(self) -> Row | None:
        return self.lines().orderBy(F.desc("version")).first()

    def _hadoop(self, path: str):
        jvm = self.spark.sparkContext._jvm
        return jvm.org.apache.hadoop.fs.Path(path), self.spark.sparkContext._jsc.hadoopConfiguration()

    def _put(self, line: dict) -> bool:
        """Write a line and rename it into place; False if its number is taken."""
        made = f"{self.base}/{_LOG}/made-{uuid.uuid4().hex}"
        rows = self.spark.createDataFrame([json.dumps(line)], "string").toDF("value")
        rows.coalesce(1).write.text(made)
        source, conf = self._hadoop(made)
        final, _ = self._hadoop(f"{self.base}/{_LOG}/line={line['version']:012d}")
        fs = source.getFileSystem(conf)
        if not fs.exists(final):
            files = self.spark.sparkContext._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                fs.getUri(), conf
            )
            options = self.spark.sparkContext._gateway.new_array(
                self.spark.sparkContext._jvm.org.apache.hadoop.fs.Options.Rename, 0
            )
            try:
                files.rename(source, final, options)
                return True
            except Exception as e:
                if "FileAlreadyExists" not in str(e) and not fs.exists(final):
                    raise
        fs.delete(source, True)
        return False

    def _commit(self, change) -> int:
        """Publish ``change(line)`` as the next version; looks again while others are faster."""
        while True:
            before = self.current()
            line = change(
                before.asDict(True) if before else dict(version=0, streams={}, live=[])
            )
            if line is None:
                return before["version"]
            line = {**line, "version": (before["version"] if before else 0) + 1, "at": time.time()}
            if self._put(line):
                return line["version"]

    # ----------------------------------------------------------------- rows

    def _stored(self, generations: list[str]) -> DataFrame:
        more = [T.StructField(c, T.StringType()) for c in (*PARTITIONS, "gen")]
        full = T.StructType(self.schema.fields + more + [T.StructField("bin", T.LongType())])
        if not generations:
            return self.spark.createDataFrame([], full)
        root = f"{self.base}/{_DATA}"
        paths = [f"{root}/gen={g}" for g in generations]
        return self.spark.read.schema(full).option("basePath", root).parquet(*paths)

    def read(self, version: int | None = None) -> DataFrame:
        """Rows of the newest version, or of one that has not expired; filters on the folder
        columns skip folders."""
        if version is None:
            line = self.current()
        else:
            line = self.lines().where(F.col("version") == version).first()
            if line is None:
                raise ValueError(f"version {version} is not there, or has expired")
        return self._stored([g["gen"] for g in line["live"]] if line else []).drop("gen", "bin")

    def files(self, generations: list[str]) -> DataFrame:
        """(gen, domain_p, date_p, bin, _file, bytes) of the files; no column of the rows is read."""
        rows = self._stored(generations)
        return rows.groupBy(
            "gen", *PARTITIONS, "bin", F.col("_metadata.file_path").alias("_file")
        ).agg(F.max("_metadata.file_size").alias("bytes"))

    def _written(self, rows: DataFrame) -> dict | None:
        """Write rows (…, domain_p, date_p, bin) as a new generation that nobody sees yet."""
        gen = uuid.uuid4().hex
        path = f"{self.base}/{_DATA}/gen={gen}"
        rows.write.partitionBy(*PARTITIONS, "bin").mode("errorifexists").parquet(path)
        size = self.files([gen]).agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("n")).first()
        return dict(gen=gen, bytes=size["bytes"], files=size["n"]) if size["n"] else None

    # -------------------------------------------------------------- changes

    def append(self, pages: DataFrame, stream: str | None = None, batch: int | None = None) -> int:
        """Add rows; columns that they lack are null. With ``stream`` and ``batch``, only if no later batch of it is there."""

        def seen(line) -> bool:
            return stream is not None and (line["streams"] or {}).get(stream, -1) >= batch

        before = self.current()
        if before and seen(before):
            return before["version"]
        columns = [f.name for f in self.schema.fields if f.name in pages.columns]
        rows = with_partition_columns(pages.select(*columns), self.domain_buckets)
        made = self._written(rows.withColumn("bin", F.lit(0).cast("bigint")))

        def change(line):
            if seen(line):
                return None
            streams = dict(line["streams"] or {})
            if stream is not None:
                streams[stream] = batch
            return dict(streams=streams, live=line["live"] + ([made] if made else []))

        return self._commit(change)

    def due(self) -> list[str]:
        """Generations to be compacted now, empty if there are fewer than ``fanout``."""
        line = self.current()
        tiers: dict[int, list[str]] = {}
        for g in line["live"] if line else ():
            if g["bytes"] < g["files"] * self.target // 2:
                tiers.setdefault(int(math.log(g["bytes"], self.fanout)), []).append(g["gen"])
        smaller: list[str] = []
        for tier in sorted(tiers):
            smaller += tiers[tier]
            if len(tiers[tier]) >= self.fanout:
                return smaller
        return []

    def rewrite(self, generations: list[str]) -> dict | None:
        """One new generation with the rows of the given ones, one file per bin."""
        w = Window.partitionBy(*PARTITIONS).orderBy("bytes", "_file")
        before = F.coalesce(
            F.sum("bytes").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        )
        bins = self.files(generations).select(
            "_file", F.floor(before / F.lit(self.target)).cast("bigint").alias("bin")
        )
        rows = self._stored(generations).withColumn("_file", F.col("_metadata.file_path"))
        dealt = rows.drop("gen", "bin").join(bins, "_file").drop("_file")
        return self._written(dealt.repartition(*PARTITIONS, "bin"))

    def swap(self, generations: list[str], made: dict | None) -> int:
        """Publish ``made`` in place of ``generations``; what came since then stays."""
        old = set(generations)

        def change(line):
            names = {g["gen"] for g in line["live"]}
            if not old <= names:
                raise Conflict("another compaction was faster; nothing is lost")
            kept = [g for g in line["live"] if g["gen"] not in old]
            return dict(streams=line["streams"], live=kept + ([made] if made else []))

        return self._commit(change)

    def compact(self) -> bool:
        """Join what is due; False if nothing is."""
        generations = self.due()
        if not generations:
            return False
        self.swap(generations, self.rewrite(generations))
        return True

    # --------------------------------------------------------------- expiry

    def expire(self, age: float) -> tuple[int, int]:
        """Remove lines that were replaced more than ``age`` seconds ago, then generations which
        no kept line names and which are older than that. Returns both numbers.

        The driver sees names of lines and generations, whose number compaction and expiry
        bound; files are removed folder by folder.
        """
        limit = time.time() - age
        lines = sorted(self.lines().collect(), key=lambda r: r["version"])
        kept = [
            now for now, after in zip(lines, lines[1:] + [None]) if after is None or after["at"] >= limit
        ]
        names = {g["gen"] for line in kept for g in line["live"]}
        numbers = {line["version"] for line in kept}
        gone = [line["version"] for line in lines if line["version"] not in numbers]
        for version in gone:
            self._delete(f"{self.base}/{_LOG}/line={version:012d}")
        return len(gone), remove_unnamed(
            self.spark, f"{self.base}/{_DATA}", {f"gen={n}" for n in names}, "gen=", limit
        )

    def _delete(self, path: str) -> None:
        target, conf = self._hadoop(path)
        target.getFileSystem(conf).delete(target, True)
