"""Merkle manifest of a dataset: one hash tree per group, one over the groups, proofs.

Leaves are sha256 over the rows' fields. A group's leaves are in the order of their id;
their places come from ranks in merged bitmaps of the ids (``ordering.ranked``), so no
group is sorted or gathered. A level joins runs of two nodes; the last run may be a single
one. Nodes are reduced in slot arrays: the block of a node is its place without the last
ten bits, its slot those ten bits, and a task turns at most 1,024 slots into one node of
the next round. Proofs come back the same way, from the top round down.

The text of a row is read once, for its leaf, and never shuffled.

Defined results: a null field is ``-``, an empty text ``0:``; a null id comes before all
others of its group; rows with one id follow each other by leaf, and equal rows have
places of their own; a null group is a group, before all others. A table without rows has
no groups and the root None. Texts of any length are hashed whole. Columns that are
neither named nor kept play no part, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.llm.ordering import numbered, ranked
from webloom.session import stage_table

# Levels of the tree that one round reduces: blocks of 2**10 slots.
ROUND_LEVELS = 10
_HEX = 64


@dataclass
class Manifest:
    """``leaves``: (tree, idx, n, hash, …) per row; ``groups``: (tree, group, n_leaves, subroot);
    ``rounds`` and ``top``: the nodes that blocks of each round start from."""

    leaves: DataFrame
    groups: DataFrame
    root: str | None
    rounds: list[DataFrame]
    top: list[DataFrame]


def framed(value: Column) -> Column:
    """``-`` for null, else the UTF-8 length, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text), F.lit(":"), text))


def leaf_hash(*fields: Column) -> Column:
    return F.sha2(F.concat(*[framed(f) for f in fields]), 256)


def _height(n: int) -> int:
    """Levels that a tree of ``n`` nodes still has to go."""
    return max(n - 1, 0).bit_length()


def reduce_slots(slots: np.ndarray, levels: int) -> list[np.ndarray]:
    """The slots and every level above them."""
    out = [slots]
    for _ in range(levels):
        flat, below = out[-1].tobytes(), len(out[-1])
        out.append(
            np.array(
                [
                    hashlib.sha256(flat[i : i + 2 * _HEX]).hexdigest().encode()
                    for i in range(0, below * _HEX, 2 * _HEX)
                ],
                dtype=f"S{_HEX}",
            )
        )
    return out


def _slots(table: pa.Table) -> tuple[pa.Table, list[np.ndarray]]:
    table = table.sort_by("idx")
    slots = np.array(table["hash"].to_pylist(), dtype=f"S{_HEX}")
    return table, reduce_slots(slots, min(ROUND_LEVELS, _height(table["n"][0].as_py())))


def _block_root(table: pa.Table) -> pa.Table:
    table, levels = _slots(table)
    n = table["n"][0].as_py()
    return pa.table(
        {
            "tree": table["tree"][:1],
            "idx": pa.array([table["idx"][0].as_py() >> ROUND_LEVELS], pa.int64()),
            "n": pa.array([-(-n >> ROUND_LEVELS)], pa.int64()),
            "hash": [levels[-1][0].decode()],
        }
    )


def _block() -> Column:
    return F.shiftright("idx", ROUND_LEVELS).alias("_block")


def reduce_rounds(nodes: DataFrame) -> list[DataFrame]:
    """Nodes (tree, idx, n, hash) round by round, until every tree has one."""
    rounds = [nodes]
    while (rounds[-1].agg(F.max("n")).first()[0] or 0) > 1:
        above = (
            rounds[-1]
            .select("tree", "idx", "n", "hash")
            .groupBy("tree", _block())
            .applyInArrow(_block_root, "tree string, idx long, n long, hash string")
        )
        rounds.append(stage_table(above, f"merkle-round-{len(rounds)}"))
    return rounds


def _strings(cells: np.ndarray, known: np.ndarray) -> pa.Array:
    """The cells as strings, null where not known."""
    offsets = np.zeros(cells.size + 1, np.int32)
    np.cumsum(known.ravel() * _HEX, out=offsets[1:])
    bitmap = np.packbits(known.ravel(), bitorder="little")
    return pa.StringArray.from_buffers(
        cells.size, pa.py_buffer(offsets), pa.py_buffer(cells[known].tobytes()), pa.py_buffer(bitmap)
    )


def _with_paths(carried: list[str]):
    """Cogroup function: a block's nodes get their siblings in it, then those above it."""

    def run(nodes: pa.Table, above: pa.Table) -> pa.Table:
        nodes, levels = _slots(nodes)
        slot = nodes["idx"].to_numpy() & ((1 << ROUND_LEVELS) - 1)
        higher = above["siblings"][0].as_py() or []
        higher_left = above["left"][0].as_py() or []
        own = len(levels) - 1
        width = own + len(higher)
        cells = np.zeros((len(slot), width), f"S{_HEX}")
        left = np.zeros((len(slot), width), bool)
        known = np.zeros((len(slot), width), bool)
        for k in range(own):
            at = slot >> k
            other = at ^ 1
            known[:, k] = other < len(levels[k])
            left[:, k] = other < at
            cells[known[:, k], k] = levels[k][other[known[:, k]]]
        for k, (sibling, side) in enumerate(zip(higher, higher_left)):
            known[:, own + k] = sibling is not None
            left[:, own + k] = bool(side)
            cells[:, own + k] = (sibling or "").encode()
        ends = pa.array(np.arange(len(slot) + 1, dtype=np.int32) * width)
        out = {c: nodes[c] for c in nodes.column_names if c != "_block"}
        out["siblings"] = pa.ListArray.from_arrays(ends, _strings(cells, known))
        sides = pa.array(left.ravel(), mask=~known.ravel())
        out["left"] = pa.ListArray.from_arrays(ends, sides)
        for c in carried:
            out[c] = pa.array([above[c][0].as_py()] * len(slot), pa.string())
        return pa.table(out)

    return run


PATH = "siblings array<string>, left array<boolean>"


def _path_type(nodes: DataFrame, carried: list[str]) -> T.StructType:
    return T.StructType(
        [
            *nodes.schema,
            *T._parse_datatype_string(PATH),
            *[T.StructField(c, T.StringType()) for c in carried],
        ]
    )


def _down(rounds: list[DataFrame], above: DataFrame, carried: list[str]) -> DataFrame:
    """Paths of the first round's nodes; ``above``: (tree, idx, siblings, left, carried)."""
    paths = above
    for k in range(len(rounds) - 2, -1, -1):
        nodes = rounds[k]
        upper = paths.select("tree", "idx", "siblings", "left", *carried)
        found = (
            nodes.groupBy("tree", _block())
            .cogroup(upper.groupBy("tree", F.col("idx").alias("_block")))
            .applyInArrow(_with_paths(carried), _path_type(nodes, carried))
        )
        paths = found if k == 0 else stage_table(found, f"merkle-paths-{k}")
    if len(rounds) > 1:
        return paths
    # One node per tree: nothing stands between it and what is above.
    upper = above.select("tree", "siblings", "left", *carried)
    return rounds[0].join(upper, "tree")


def build(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    group_col: str = "lang",
    extra: dict[str, Column] | None = None,
) -> Manifest:
    """The trees over all rows of ``docs``; ``extra`` are columns to carry along with the leaves."""
    group = F.col(group_col).cast("string")
    rows = docs.select(
        # Groups in order of these keys: null first, then bytewise.
        F.when(group.isNull(), "").otherwise(F.concat(F.lit("="), group)).alias("tree"),
        F.col(id_col).cast("bigint").alias("id"),
        leaf_hash(*[F.col(f) for f in fields]).alias("hash"),
        *[c.alias(name) for name, c in (extra or {}).items()],
        F.monotonically_increasing_id().alias("row_id"),
    )
    rows = stage_table(
        rows.withColumn("_bits", F.conv(F.substring("hash", 1, 15), 16, 10).cast("bigint")),
        "merkle-leaves",
    )
    placed = ranked(rows, ["tree"], ["id", "_bits", "row_id"])
    leaves = stage_table(
        placed.withColumnRenamed("rank", "idx").withColumnRenamed("size", "n").drop("_bits"), "merkle-places"
    )
    rounds = reduce_rounds(leaves)
    subroots = rounds[-1].select("tree", F.col("hash").alias("subroot"))
    n_groups = subroots.count()
    ordered = stage_table(
        numbered(subroots, ["tree"]).select(
            F.lit("").alias("tree"),
            F.col("place").alias("idx"),
            F.lit(n_groups).cast("bigint").alias("n"),
            F.col("subroot").alias("hash"),
            F.col("tree").alias("of"),
        ),
        "merkle-groups",
    )
    top = reduce_rounds(ordered)
    last = top[-1].select("hash").first() if n_groups else None
    sizes = leaves.where("idx = 0").select("tree", F.col("n").alias("n_leaves"))
    groups = subroots.join(sizes, "tree").select(
        "tree", F.expr("if(tree = '', null, substr(tree, 2))").alias("group"), "n_leaves", "subroot"
    )
    return Manifest(leaves, groups, last[0] if last else None, rounds, top)


def proofs(m: Manifest) -> DataFrame:
    """Every leaf with its way to the root: ``siblings``, level by level (null where a run has one
    node), and whether each stands on the ``left``; also its ``subroot`` and the ``root``."""
    start = m.top[-1].select(
        "tree",
        "idx",
        F.array().cast("array<string>").alias("siblings"),
        F.array().cast("array<boolean>").alias("left"),
    )
    tops = _down(m.top, start, []).select(
        F.col("of").alias("tree"),
        F.lit(0).cast("bigint").alias("idx"),
        "siblings",
        "left",
        F.col("hash").alias("subroot"),
        F.lit(m.root).cast("string").alias("root"),
    )
    tops = stage_table(tops, "merkle-tops")
    return _down(m.rounds, tops, ["subroot", "root"])


def fold(leaf: Column, siblings: Column, left: Column) -> Column:
    """Root that follows from a leaf and its siblings."""

    def join(node: Column, step: Column) -> Column:
        other = F.coalesce(step["siblings"], F.lit(""))
        return F.sha2(
            F.when(step["left"], F.concat(other, node)).otherwise(F.concat(node, other)), 256
        )

    steps = F.zip_with(
        siblings, left, lambda s, side: F.struct(s.alias("siblings"), side.alias("left"))
    )
    return F.aggregate(steps, leaf, join)


def proof_digest(siblings: Column) -> Column:
    """sha256 over the siblings from the leaf to the root."""
    return F.sha2(F.array_join(siblings, ""), 256)
