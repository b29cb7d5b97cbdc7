"""An inverted index that takes changes: segments, a manifest, merge on read, merging by tiers.

A batch of new, changed and removed documents becomes one segment, a folder with
- ``docs``: forward rows (all tokens) of its documents, with what a hit shows,
- ``postings``: token, document and frequency, sorted by token,
- ``gone``: keys of documents whose older versions no longer count,
- ``df``: how the batch changes the document frequency of each token.
No file of an older segment is written, renamed or deleted by a batch; postings of older
segments are not even read, since the forward rows say which tokens a replaced document had.

Readers take the newest line of the manifest and the folders it lists. A row counts if no
later segment has its key among ``gone``. When as many neighbours as ``FANOUT`` have reached
one tier, they are merged into one segment of the next, so that a corpus of N batches has
some FANOUT * log(N) segments and a document is rewritten log(N) times.

Defined results: a null text is a document without tokens, which counts for N. Rows with a
null key are left out. A key that a batch both brings and removes is brought. A key that
occurs twice in a batch is an error, found before anything is published. Removing an unknown
key does nothing. A batch that another writer overtook is an error, and can be repeated.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.functions import text as txt
from webloom.operators import blocks
from webloom.session import stage_table

# Segments of a tier that are merged into one of the next.
FANOUT = 4
# Replaced and removed keys, of 16 bytes, that are sent to all tasks; beyond, they are joined by a
# shuffle.
SMALL_GONE = 2_000_000
_LOG = "_manifest"
SEGMENT = "folder string, seq bigint, tier int, n_docs bigint, n_postings bigint, n_gone bigint"
MANIFEST = f"version bigint, writer string, n_live bigint, segments array<struct<{SEGMENT}>>"
GONE = "doc_key bigint, seq bigint"
FREQUENCY = "token string, change bigint"


class Overtaken(RuntimeError):
    """Another writer published the same version."""


@dataclass
class Segments:
    """The index at ``base``. ``payload`` names columns of documents that are stored along."""

    spark: SparkSession
    base: str
    payload: tuple[tuple[str, str], ...] = ()
    fanout: int = FANOUT
    token_chars: str = txt.TOKEN_CHARS

    # ------------------------------------------------------------- manifest

    def manifest(self) -> Row | None:
        """Newest line, None before the first batch. Of two with one number the lesser writer counts."""
        try:
            log = self.spark.read.schema(MANIFEST).json(f"{self.base}/{_LOG}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return None
        return log.orderBy(F.desc("version"), "writer").first()

    def live(self) -> list[Row]:
        """Segments of the newest version, oldest first."""
        line = self.manifest()
        return sorted(line["segments"], key=lambda s: s["seq"]) if line else []

    def _publish(self, before: Row | None, segments: list[dict], n_live: int) -> int:
        version = (before["version"] if before else 0) + 1
        writer = uuid.uuid4().hex
        row = self.spark.createDataFrame([(version, writer, n_live, segments)], MANIFEST)
        row.coalesce(1).write.mode("append").json(f"{self.base}/{_LOG}")
        now = self.manifest()
        if (now["version"], now["writer"]) != (version, writer):
            raise Overtaken(f"version {version} of {self.base} is another writer's; repeat the batch")
        return version

    # --------------------------------------------------------------- tables

    def _doc_schema(self) -> T.StructType:
        more = "".join(f", {name} {kind}" for name, kind in self.payload)
        return T._parse_datatype_string(f"{blocks.FORWARD}{more}")

    def _read(self, part: str, schema, segments: list) -> DataFrame:
        paths = [f"{self.base}/{s['folder']}/{part}" for s in segments]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _last_gone(self, segments: list) -> DataFrame:
        """(doc_key, last): the last segment that replaces or removes the key."""
        gone = self._read("gone", GONE, segments)
        return gone.groupBy("doc_key").agg(F.max("seq").alias("last"))

    def _counting(self, rows: DataFrame, segments: list) -> DataFrame:
        """Rows (doc_key, seq, …) that no later segment takes back."""
        if len(segments) < 2:
            return rows
        last = self._last_gone(segments)
        if sum(s["n_gone"] for s in segments) <= SMALL_GONE:
            last = F.broadcast(last)
        met = rows.join(last, "doc_key", "left")
        return met.where(F.col("last").isNull() | (F.col("seq") >= F.col("last"))).drop("last")

    def docs(self) -> DataFrame:
        """Forward rows of all documents as they are now."""
        found = self.live()
        return self._counting(self._read("docs", self._doc_schema(), found), found)

    def mappings(self) -> DataFrame:
        """(doc_key, payload) of all documents."""
        return self.docs().select("doc_key", *[name for name, _ in self.payload])

    def stored_postings(self) -> DataFrame:
        """Postings of all segments, with those that no longer count among them."""
        return self._read("postings", blocks.POSTING, self.live())

    def places(self) -> DataFrame:
        """(doc_key, seq, block, length) of all versions of documents that segments hold."""
        rows = self._read("docs", self._doc_schema(), self.live())
        return rows.select("doc_key", "seq", "block", "length")

    def counting(self, rows: DataFrame) -> DataFrame:
        """Postings (doc_key, seq, …) that still count."""
        return self._counting(rows, self.live())

    def postings(self, where=None) -> DataFrame:
        """(token, doc_key, tf), of the tokens that ``where`` picks; the filter reaches the files."""
        rows = self.stored_postings()
        rows = rows if where is None else rows.where(where)
        return self.counting(rows).select("token", "doc_key", "tf")

    def doc_freq(self) -> DataFrame:
        """Documents per token, from the changes of all segments."""
        changes = self._read("df", FREQUENCY, self.live())
        summed = changes.groupBy("token").agg(F.sum("change").alias("doc_freq"))
        return summed.where("doc_freq > 0")

    def n_docs(self) -> int:
        line = self.manifest()
        return line["n_live"] if line else 0

    def idf(self) -> DataFrame:
        n = self.n_docs()
        return self.doc_freq().withColumn("idf", F.log((F.lit(n) + 1) / (F.col("doc_freq") + 1)))

    # -------------------------------------------------------------- changes

    def apply(self, changed: DataFrame, removed: DataFrame | None = None) -> int:
        """Publish a version with ``changed`` (doc_key, text, payload) and without ``removed``
        (doc_key); merges what has become due. Returns the version."""
        before = self.manifest()
        older = sorted(before["segments"], key=lambda s: s["seq"]) if before else []
        seq = older[-1]["seq"] + 1 if older else 1
        folder = f"segment-{seq}-{uuid.uuid4().hex}"
        kept = ["doc_key", "text", *[name for name, _ in self.payload]]
        rows = changed.select(*kept).where(F.col("doc_key").isNotNull())
        placed = blocks.with_blocks(rows, F.octet_length("text"))
        stored = self._write_rows(blocks.forward_rows(placed, seq, self.token_chars), folder)
        counts = stored.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_key").alias("keys")).first()
        if counts["n"] != counts["keys"]:
            raise ValueError("a document key occurs twice in one batch")
        gone = stored.select("doc_key")
        if removed is not None:
            keys = removed.select(F.col("doc_key").cast("bigint").alias("doc_key"))
            gone = gone.unionByName(keys.where(F.col("doc_key").isNotNull())).distinct()
        if not older:  # nothing that a key could take back
            gone = gone.limit(0)
        gone = self._write(gone.withColumn("seq", F.lit(seq).cast("bigint")), folder, "gone", GONE)
        replaced = self._replaced(older, gone) if older else None
        n_postings = self._write_postings(stored, folder)
        n_replaced = self._write_changes(folder, replaced)
        segment = dict(
            folder=folder, seq=seq, tier=0, n_docs=counts["n"], n_postings=n_postings, n_gone=gone.count()
        )
        n_live = (before["n_live"] if before else 0) + counts["n"] - n_replaced
        version = self._publish(before, [s.asDict() for s in older] + [segment], n_live)
        while self._merge_due():
            version += 1
        return version

    def _write(self, rows: DataFrame, folder: str, part: str, schema) -> DataFrame:
        path = f"{self.base}/{folder}/{part}"
        rows.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def _write_rows(self, forward: DataFrame, folder: str) -> DataFrame:
        schema = self._doc_schema()
        return self._write(forward.select(*schema.names), folder, "docs", schema)

    def _write_postings(self, stored: DataFrame, folder: str) -> int:
        """Every file is sorted by token, so a filter on tokens skips row groups in each."""
        rows = blocks.postings_of(stored).sortWithinPartitions("token", "block")
        return self._write(rows, folder, "postings", blocks.POSTING).count()

    def _replaced(self, older: list, gone: DataFrame) -> DataFrame:
        """Distinct tokens of the documents, as they were until now, that the batch replaces or removes."""
        rows = self._read("docs", self._doc_schema(), older).select("doc_key", "seq", "tokens")
        touched = rows.join(gone.select("doc_key"), "doc_key", "left_semi")
        terms = F.array_distinct("tokens").alias("terms")
        return stage_table(self._counting(touched, older).select(terms), "replaced")

    def _write_changes(self, folder: str, replaced: DataFrame | None) -> int:
        new = self.spark.read.schema(blocks.POSTING).parquet(f"{self.base}/{folder}/postings")
        changes = new.groupBy("token").agg(F.count(F.lit(1)).alias("change"))
        n = 0
        if replaced is not None:
            n = replaced.count()
            lost = replaced.select(F.explode("terms").alias("token"), F.lit(-1).cast("bigint").alias("change"))
            changes = changes.unionByName(lost)
        summed = changes.groupBy("token").agg(F.sum("change").alias("change")).where("change != 0")
        self._write(summed.sortWithinPartitions("token"), folder, "df", FREQUENCY)
        return n

    # -------------------------------------------------------------- merging

    def _merge_due(self) -> bool:
        """Merge the newest segments if ``fanout`` of them have one tier."""
        before = self.manifest()
        found = sorted(before["segments"], key=lambda s: s["seq"])
        last = found[-self.fanout :]
        if len(last) < self.fanout or len({s["tier"] for s in last}) > 1:
            return False
        self._merge(before, found[: -self.fanout], last)
        return True

    def merge_all(self) -> int:
        """One segment of everything."""
        before = self.manifest()
        return self._merge(before, [], sorted(before["segments"], key=lambda s: s["seq"]))

    def _merge(self, before: Row, rest: list, last: list) -> int:
        seq, tier = last[-1]["seq"], max(s["tier"] for s in last) + 1
        folder = f"segment-{seq}-{uuid.uuid4().hex}"
        rows = self._counting(self._read("docs", self._doc_schema(), last), last)
        placed = blocks.with_blocks(rows.drop("block"), F.col("length"))
        stored = self._write_rows(placed.withColumn("seq", F.lit(seq).cast("bigint")), folder)
        n_postings = self._write_postings(stored, folder)
        # Without older segments there is nothing left that a key could take back.
        gone = self._last_gone(last) if rest else self._last_gone([])
        gone = gone.select("doc_key", F.lit(seq).cast("bigint").alias("seq"))
        gone = self._write(gone, folder, "gone", GONE)
        changes = self._read("df", FREQUENCY, last).groupBy("token").agg(F.sum("change").alias("change"))
        self._write(changes.where("change != 0").sortWithinPartitions("token"), folder, "df", FREQUENCY)
        merged = dict(
            folder=folder, seq=seq, tier=tier, n_docs=stored.count(), n_postings=n_postings, n_gone=gone.count()
        )
        return self._publish(before, [s.asDict() for s in rest] + [merged], before["n_live"])


def from_documents(spark: SparkSession, base: str, docs: DataFrame) -> Segments:
    """A new index with one segment; payload: all columns of ``docs`` but key and text."""
    payload = tuple(
        (f.name, f.dataType.simpleString()) for f in docs.schema if f.name not in ("doc_key", "text")
    )
    out = Segments(spark, base, payload)
    out.apply(docs)
    return out


