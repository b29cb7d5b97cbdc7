"""Facts about 64-bit fingerprints, worked out over all texts, brought back to the texts.

Texts are dealt out in blocks of a few megabytes. A block sends, for each bucket of
the fingerprint space, one binary row with its distinct fingerprints and a few
bytes about each; a bucket's task merges the rows of all blocks and answers each
block with one byte per fingerprint, in the order they were sent. So

* a fingerprint that occurs in a third of all texts costs one entry per block, not
  one per text, and no task ever holds the texts of one fingerprint;
* a bucket holds a fixed share of the fingerprints and is sized by ``bucket_bytes``,
  a block by ``block_bytes``; their numbers grow with the corpus. Rows carry some
  kilobytes each; for very large corpora raise both sizes by the same factor.

Blocks are dealt by a hash of id and text. The block exchange is written the same
way wherever a plan needs it, so Spark runs it once per plan and reuses it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20


@dataclass(frozen=True)
class Plan:
    blocks: int
    bucket_bits: int

    @property
    def buckets(self) -> int:
        return 1 << self.bucket_bits


def plan_for(
    docs: DataFrame,
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
) -> Plan:
    """Numbers of blocks and buckets from the texts' bytes and rows."""
    size, rows = docs.select(
        F.sum(F.octet_length(text_col).cast("long")), F.count(F.lit(1))
    ).first()
    size = (size or 0) + 64 * rows
    blocks = max(1, -(-size // block_bytes))
    return Plan(blocks, max(3, int(-(-size // bucket_bytes) - 1).bit_length()))


def in_blocks(
    docs: DataFrame, plan: Plan, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, text, block)."""
    return docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(text_col, F.lit("")).alias("text")
    ).withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(plan.blocks)))


SENT = "bucket int, block long, fingerprints binary, facts binary"
BACK = "block long, bucket int, answers binary"


def cut(fingerprints: np.ndarray, plan: Plan) -> np.ndarray:
    """First entry of each bucket in sorted distinct fingerprints, and the end."""
    marks = np.arange(1, plan.buckets, dtype=np.uint64) << np.uint64(64 - plan.bucket_bits)
    return np.concatenate([[0], np.searchsorted(fingerprints, marks), [len(fingerprints)]])


def send(
    block: int, fingerprints: np.ndarray, facts: np.ndarray, plan: Plan, width: int
) -> pa.Table:
    """Rows of one block. ``fingerprints``: sorted, distinct; ``facts``: one item each.

    ``width`` bytes of each fingerprint travel, counted behind the bucket's bits.
    """
    marks = cut(fingerprints, plan)
    full = np.flatnonzero(np.diff(marks))
    rest = (fingerprints << np.uint64(plan.bucket_bits)) >> np.uint64(64 - 8 * width)
    narrow = np.ascontiguousarray(rest.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width])
    return pa.table(
        {
            "bucket": pa.array(full, pa.int32()),
            "block": pa.array(np.full(len(full), block), pa.int64()),
            "fingerprints": pa.array(
                [narrow[marks[b] : marks[b + 1]].tobytes() for b in full], pa.binary()
            ),
            "facts": pa.array([facts[marks[b] : marks[b + 1]].tobytes() for b in full], pa.binary()),
        }
    )


def answer(
    sent: DataFrame,
    plan: Plan,
    width: int,
    fact_type: str,
    merge: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray],
) -> DataFrame:
    """Merge each bucket: ``merge(group, n, facts)`` gives a byte per entry, where
    entries with equal ``group`` (0 … n - 1) have the same fingerprint."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        parts = table["fingerprints"].to_pylist()
        sizes = [len(p) // width for p in parts]
        padded = np.zeros((sum(sizes), 8), np.uint8)
        padded[:, :width] = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, width)
        distinct, group = np.unique(padded.view("<u8").ravel(), return_inverse=True)
        facts = np.frombuffer(b"".join(table["facts"].to_pylist()), fact_type)
        out = merge(group, len(distinct), facts).astype(np.uint8)
        ends = np.cumsum(sizes)
        return pa.table(
            {
                "block": table["block"],
                "bucket": pa.array(np.full(len(parts), key[0].as_py()), pa.int32()),
                "answers": pa.array(
                    [out[e - n : e].tobytes() for e, n in zip(ends, sizes)], pa.binary()
                ),
            }
        )

    return sent.groupBy("bucket").applyInArrow(run, BACK)


def received(answers: pa.Table, fingerprints: np.ndarray, plan: Plan) -> np.ndarray:
    """The bytes for all of a block's fingerprints, from its rows of answers."""
    marks = cut(fingerprints, plan)
    out = np.zeros(len(fingerprints), np.uint8)
    for bucket, part in zip(answers["bucket"].to_pylist(), answers["answers"].to_pylist()):
        out[marks[bucket] : marks[bucket + 1]] = np.frombuffer(part, np.uint8)
    return out
