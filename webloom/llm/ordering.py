"""Places of rows in an order: by ranks in bitmaps, or by one range sort.

``ranked`` needs no sort of the rows. The keys of a group are bits of 64-bit words, which
tasks fill on their own and a shuffle merges by OR; only words with a bit are kept. A
directory of counts over the leading bits says how many keys lie before a word, in
windows of at most 2**20 entries whatever the keys are. The rank of a key is that count
and the number of lower bits in its word.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webloom.session import stage_table

WORD_BITS = 6
# Bits that each level of the directory adds to those of a word.
STEPS = (18, 20)


def same(left: DataFrame, right: DataFrame, columns: Sequence[str], mark: str = "_") -> Column:
    """Null-safe equality of ``columns`` with their marked twins."""
    return reduce(
        lambda a, b: a & b, [left[c].eqNullSafe(right[mark + c]) for c in columns], F.lit(True)
    )


def attach(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on columns that may be null; the right side's copies of them go.

    A key that fills many rows belongs to the left side, where an adaptive join splits it.
    """
    marked = right.select(*[F.col(c).alias(f"_{c}") if c in on else F.col(c) for c in right.columns])
    return left.join(marked, same(left, marked, on), how).drop(*[f"_{c}" for c in on])


def _words(rows: DataFrame, group: list[str], key: str) -> DataFrame:
    """(group, c, bits, extra, total) per word: its bits, and the rows beyond one per bit."""
    per_key = rows.groupBy(*group, F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    bit = F.expr("cast(_key & 63 as int)")
    return (
        per_key.withColumn("_bit", bit)
        .groupBy(*group, F.shiftright("_key", WORD_BITS).alias("c"))
        .agg(
            F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("bits"),
            F.collect_list(
                F.when(F.col("_n") > 1, F.struct(F.col("_bit").alias("bit"), (F.col("_n") - 1).alias("n")))
            ).alias("extra"),
            F.sum("_n").alias("total"),
        )
    )


def directory(words: DataFrame, group: list[str]) -> DataFrame:
    """``words`` with ``base``, the rows of the group before the word, and ``size``, its rows."""
    levels = [words]
    for step in STEPS:
        levels.append(
            levels[-1].groupBy(*group, F.shiftright("c", step).alias("c")).agg(F.sum("total").alias("total"))
        )
    before = lambda *part: F.coalesce(
        F.sum("total").over(
            Window.partitionBy(*group, *part).orderBy("c").rowsBetween(Window.unboundedPreceding, -1)
        ),
        F.lit(0).cast("bigint"),
    )
    known = levels[-1].select(
        *group,
        "c",
        before().alias("base"),
        F.sum("total").over(Window.partitionBy(*group)).alias("size"),
    )
    for step, level in zip(reversed(STEPS), reversed(levels[:-1])):
        inner = level.withColumn("up", F.shiftright("c", step)).withColumn("_before", before("up"))
        inner = attach(inner, known.withColumnRenamed("c", "up"), [*group, "up"])
        known = inner.withColumn("base", F.col("base") + F.col("_before")).drop("up", "_before")
    return known


def ranked(rows: DataFrame, group: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """``rows`` with ``rank``, from 0 in their group by ``keys`` in turn, and the group's ``size``.

    Keys are 64-bit integers, null first. Later keys only matter to rows that are equal in
    the earlier ones; the last key is unique there. ``rows`` is a stored table.
    """
    group, key = list(group), keys[0]
    words = stage_table(_words(rows, group, key), "key-words")
    known = directory(words, group).drop("total")
    known = known.withColumnRenamed("c", "_word")
    met = attach(rows.withColumn("_word", F.shiftright(key, WORD_BITS)), known, [*group, "_word"])
    bit = F.expr(f"cast({key} & 63 as int)")
    lower = F.col("bits").bitwiseAND(F.bitwise_not(F.expr(f"shiftleft(-1L, cast({key} & 63 as int))")))
    extra = lambda keep: F.aggregate(
        F.filter("extra", keep), F.lit(0).cast("bigint"), lambda a, x: a + x["n"]
    )
    placed = met.select(
        *rows.columns,
        (
            F.col("base")
            + F.coalesce(F.bit_count(lower), F.lit(0))
            + F.coalesce(extra(lambda x: x["bit"] < bit), F.lit(0))
        ).alias("rank"),
        "size",
        extra(lambda x: x["bit"].eqNullSafe(bit)).alias("_twins"),
    )
    if len(keys) == 1:
        return placed.drop("_twins")
    placed = stage_table(placed, "ranks")
    alone = placed.where("_twins = 0").drop("_twins")
    twins = placed.where("_twins > 0").drop("_twins")
    if twins.isEmpty():
        return alone
    lead, size = f"_lead_{key}", f"_size_{key}"
    twins = twins.withColumnsRenamed({"rank": lead, "size": size})
    inside = ranked(twins, [*group, key], keys[1:])
    return alone.unionByName(
        inside.select(*rows.columns, (F.col(lead) + F.col("rank")).alias("rank"), F.col(size).alias("size"))
    )


def numbered(rows: DataFrame, order: Sequence[str], name: str = "place") -> DataFrame:
    """``rows`` with their number from 0 in the order of ``order``, nulls first.

    One range sort. The driver sees one count per partition, no row.
    """
    parts = stage_table(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id()),
        "sorted-parts",
    )
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("low"))
    total, shifts = 0, []
    for r in sorted(sizes.collect()):
        shifts.append((r["_part"], total - r["low"]))
        total += r["n"]
    table = parts.sparkSession.createDataFrame(shifts, "_part int, _shift bigint")
    # One row per partition.
    return parts.join(F.broadcast(table), "_part").select(
        *rows.columns, (F.col("_at") + F.col("_shift")).alias(name)
    )
