"""Exact dedup on an extendible-hash index, in DataFrame functions only.

The index lives in the shared folder as Parquet tables:

``entries``    one narrow row per document: id, 64-bit key of the normalised text,
               SHA-256, length.
``directory``  slot -> bucket. A slot is the first ``max_depth`` bits of a key. The
               directory starts with one bucket (depth 0); every doubling looks one
               more bit at the buckets that hold more than ``bucket_rows`` rows and
               splits them, until each fits or ``max_depth`` is reached. It has at
               most 2**max_depth rows, which is why it may be broadcast.
``leaves``     one row per distinct text: bucket, key, chain position, SHA-256, the
               id that stays, number of copies. Written by owner tasks, each for a
               range of buckets and keys, sorted.

Texts are the same when their normalised bytes are: the leaves come from grouping
by bucket, key and the text itself, so two texts that share a key become two
links of a chain. Grouping counts copies inside every task before anything is
shuffled, so a group that holds a third of all rows costs one row per task; the
answers return over a join dealt out over ``salts`` tasks per key.

Defined results: a null text is an empty one; a null id counts as smaller than any
other (a group of null ids has a null ``keep_id`` and all its rows are kept);
rows that repeat an id and a text get one answer each, all alike, and
``distinct_rows`` leaves one of them, one without an id per text as well; an empty
table gives an empty one. Only the id and text columns are read, so names of other
columns cannot clash (``_key`` aside, which ``distinct_rows`` adds and removes).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from webloom.session import stage_table

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def normalised(text: Column) -> Column:
    """A-Z lower-cased, nothing else; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def key_of(norm: Column) -> Column:
    return F.xxhash64(norm)


def slot_of(key: Column, max_depth: int) -> Column:
    return F.shiftrightunsigned(key, 64 - max_depth).cast("int")


def directory(entries: DataFrame, bucket_rows: int, max_depth: int) -> DataFrame:
    """(slot, bucket, depth): the state after the last doubling.

    A bucket of depth d is a prefix of d bits. A slot's bucket is the shortest
    prefix that holds at most ``bucket_rows`` rows, as splitting would leave it.
    The prefix is numbered with a leading one bit, so that no two depths clash.
    """
    slots = entries.groupBy(slot_of(F.col("key"), max_depth).alias("slot")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    ancestors = slots.select(
        "slot", "rows", F.explode(F.sequence(F.lit(0), F.lit(max_depth))).alias("depth")
    ).withColumn(
        "bucket",
        F.expr(f"shiftright(slot, {max_depth} - depth)") + F.expr("shiftleft(1, depth)"),
    )
    fits = (
        ancestors.groupBy("bucket", "depth")
        .agg(F.sum("rows").alias("rows"))
        .where((F.col("rows") <= bucket_rows) | (F.col("depth") == max_depth))
        .select("bucket")
    )
    return (
        ancestors.join(fits, "bucket", "left_semi")
        .groupBy("slot")
        .agg(F.min(F.struct("depth", "bucket")).alias("found"))
        .select("slot", "found.bucket", "found.depth")
    )


@dataclass
class Index:
    entries: DataFrame
    directory: DataFrame
    leaves: DataFrame


def build_index(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_rows: int = 4_096,
    max_depth: int = 16,
) -> Index:
    """Write the three tables of the index and return them."""
    norm = normalised(F.col(text_col))
    entries = stage_table(
        docs.select(F.col(id_col).alias("id"), norm.alias("norm")).select(
            "id",
            key_of(F.col("norm")).alias("key"),
            F.sha2("norm", 256).alias("sha256"),
            F.octet_length("norm").alias("bytes"),
        ),
        "dedup-entries",
    )
    slots = stage_table(directory(entries, bucket_rows, max_depth), "dedup-directory")
    texts = (
        docs.select(F.col(id_col).alias("id"), norm.alias("norm"))
        .withColumn("key", key_of(F.col("norm")))
        .withColumn("slot", slot_of(F.col("key"), max_depth))
        # At most 2**max_depth rows of three numbers.
        .join(F.broadcast(slots), "slot")
    )
    groups = stage_table(
        texts.groupBy("bucket", "key", "norm")
        .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("bucket", "key", F.sha2("norm", 256).alias("sha256"), "keep_id", "group_size"),
        "dedup-groups",
    )
    chain = Window.partitionBy("bucket", "key").orderBy("sha256")
    leaves = stage_table(
        groups.repartitionByRange("bucket", "key")
        .withColumn("chain", F.row_number().over(chain))
        .sortWithinPartitions("bucket", "key", "chain"),
        "dedup-leaves",
    )
    return Index(entries, slots, leaves)


def lookup(index: Index, salts: int = 32) -> DataFrame:
    """Every entry with the answer of its chain link: keep_id, group_size, kept.

    Texts without a copy answer for themselves, so only the leaves of repeated
    texts join, each repeated once per salt.
    """
    repeated = (
        index.leaves.where(F.col("group_size") > 1)
        .select("key", "sha256", "keep_id", "group_size")
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    )
    dealt = index.entries.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int"))
    single = F.col("group_size").isNull()
    return (
        dealt.join(repeated, ["key", "sha256", "salt"], "left")
        .withColumn("keep_id", F.when(single, F.col("id")).otherwise(F.col("keep_id")))
        .select(
            "id",
            "keep_id",
            F.coalesce("group_size", F.lit(1)).alias("group_size"),
            F.equal_null("id", "keep_id").alias("kept"),
            "sha256",
            "key",
        )
    )


def distinct_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one whole row per text, that of the largest id."""
    answers = lookup(build_index(docs, id_col, text_col))
    dropped = answers.where(~F.col("kept")).select(F.col("id").alias(id_col), "key").distinct()
    keyed = docs.withColumn("_key", key_of(normalised(F.col(text_col))))
    kept = keyed.join(dropped.withColumnRenamed("key", "_key"), [id_col, "_key"], "left_anti")
    # Rows that repeat id and text; they lie together since the join.
    return kept.dropDuplicates([id_col, "_key"]).select(*docs.columns)
