"""Best-fit packing with certified bin counts.

1. ``pieces``: every document becomes token ids and the end id, cut into pieces of
   at most ``capacity`` tokens. Only longer documents are cut.
2. Pieces of full length are sequences of their own. The others are dealt out over
   partitions of about ``part_pieces`` pieces. A task packs its partition by
   best-fit decreasing and sets against it a lower bound from dual-feasible
   functions. Equal numbers certify that the partition cannot be packed better.
3. Partitions with a gap exchange documents: the pieces of their bins that are not
   full are dealt out anew over half as many partitions and packed again. A
   round's packing is taken when it needs fewer bins than before. Rounds end with
   the gaps, or with one partition; one that brings nothing is followed by one over
   half as many partitions.

What moves is narrow (piece, length); texts and ids are never shuffled. Lengths
are whole numbers up to ``capacity``, so a histogram describes a partition to the
bound, and the bound of the whole corpus needs one histogram of ``capacity`` rows.

Defined results: a null or empty text has only the end id; rows that repeat an id are
packed as documents of their own; ties are broken by the piece's number. An
empty table gives an empty one. Only the id and text columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm import tokens
from webloom.session import stage_table

CAPACITY = 2048
END_ID = 0
PART_PIECES = 200_000


def pieces(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: document, piece, start, length, ids_crc32 and, on demand, ids.

    ``doc`` numbers the rows of ``docs`` and ``number`` the pieces, for this run.
    """
    end = int(end_id).to_bytes(4, "little")
    columns = "id, piece int, start long, length long, ids_crc32 long, doc long, number long"
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    schema = columns.replace("id,", f"id {kind},", 1) + (", ids binary" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ids_of = tokens.word_tokens(tokenizer_path).ids
        base = TaskContext.get().partitionId() << 36
        doc = number = 0
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            rows: list[tuple] = []
            where: list[int] = []
            for row in range(batch.num_rows):
                ids = ids_of(texts[row].as_py() or b"") + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    where.append(row)
                    rows.append(
                        (piece, at // 4, len(part) // 4, zlib.crc32(part), base + doc,
                         base + number, part if with_ids else None)
                    )
                    number += 1
                doc += 1
            names = ["piece", "start", "length", "ids_crc32", "doc", "number", "ids"]
            kinds = [pa.int32(), *[pa.int64()] * 5, pa.binary()]
            arrays = [
                pa.array([r[k] for r in rows], kind)
                for k, kind in enumerate(kinds[: len(kinds) - (not with_ids)])
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(where, pa.int64())), *arrays],
                names=["id", *names[: len(arrays)]],
            )

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset) of each piece and the number of bins; equal pieces in given order.

    Open bins are kept by free room; bit r of ``rooms`` says that some bin has r left.
    """
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, count = 0, 0
    for at in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[at])
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            chosen = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            room, chosen = capacity, count
            count += 1
        bins[at], offsets[at] = chosen, capacity - room
        left = room - length
        if left:
            if not open_bins[left]:
                rooms |= 1 << left
            open_bins[left].append(chosen)
    return bins, offsets, count


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs; counts[x] pieces have length x.

    Largest value over two families of dual-feasible functions: lengths above
    capacity - k count as a whole bin and those below k as nothing (k = 0 is the
    plain sum), and x (m + 1) / capacity rounded down to multiples of 1 / m.
    """
    x = np.arange(len(counts))
    best = 0
    for k in range(capacity // 2 + 1):
        value = np.where(x > capacity - k, capacity, np.where(x < k, 0, x))
        best = max(best, -(-int((value * counts).sum()) // capacity))
    for m in range(1, 101):
        scaled = x * (m + 1)
        whole = scaled % capacity == 0
        # In units of 1 / (m capacity): whole multiples stay, others are rounded down.
        value = np.where(whole, x * m, scaled // capacity * capacity)
        best = max(best, -(-int((value * counts).sum()) // (m * capacity)))
    return best


def _pack_part(capacity: int, turn: int):
    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("number")
        lengths = table["length"].to_numpy()
        bins, offsets, count = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        used = np.bincount(bins, lengths, count).astype(np.int64)
        n, part = len(lengths), key[0].as_py()
        return pa.table(
            {
                "number": table["number"],
                "length": lengths,
                "part": pa.array(np.full(n, part), pa.int64()),
                "sequence_id": bins + (part << 32) + (turn << 56),
                "offset": offsets,
                "room": capacity - used[bins],
                "gap": pa.array(np.full(n, count - bound), pa.int64()),
            }
        )

    return pack


PLACED = "number long, length long, part long, sequence_id long, offset long, room long, gap long"


def _packed(rows: DataFrame, parts: int, capacity: int, turn: int) -> DataFrame:
    """``rows`` (number, length) dealt out over ``parts`` and packed."""
    dealt = rows.select(
        "number", "length", F.pmod(F.xxhash64("number", F.lit(turn)), F.lit(parts)).alias("part")
    )
    return stage_table(
        dealt.groupBy("part").applyInArrow(_pack_part(capacity, turn), PLACED), f"packed-{turn}"
    )


def pack(
    all_pieces: DataFrame,
    capacity: int = CAPACITY,
    part_pieces: int = PART_PIECES,
    max_rounds: int | None = None,
) -> DataFrame:
    """(number, sequence_id, offset) for pieces (number, length).

    ``all_pieces`` is read several times; stage it.
    """
    full = all_pieces.where(F.col("length") == capacity).select(
        "number", (F.col("number") + F.lit(1 << 62)).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    rest = all_pieces.where(F.col("length") < capacity).select("number", "length")
    parts = -(-rest.count() // part_pieces)
    if parts == 0:
        return full
    placed = _packed(rest, parts, capacity, 0)
    turn, over = 0, parts
    while max_rounds is None or turn < max_rounds:
        open_rows = placed.where((F.col("gap") > 0) & (F.col("room") > 0))
        before, gap_parts = open_rows.select(
            F.count_distinct("sequence_id"), F.count_distinct("part")
        ).first()
        if not before:
            break
        turn, over = turn + 1, -(-min(over, gap_parts) // 2)
        again = _packed(open_rows, over, capacity, turn)
        after = again.select(F.count_distinct("sequence_id")).first()[0]
        if after < before:
            done = placed.where(~((F.col("gap") > 0) & (F.col("room") > 0)))
            placed = stage_table(done.unionByName(again), f"placed-{turn}")
        if over == 1:
            break
    return full.unionByName(placed.select("number", "sequence_id", "offset"))


def packed_documents(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    cut = stage_table(pieces(docs, tokenizer_path, id_col, text_col), "pieces")
    return cut.join(pack(cut), "number").select(
        F.col("id").alias(id_col),
        "piece",
        "start",
        "length",
        "ids_crc32",
        "sequence_id",
        "offset",
        "doc",
    )


def certificate(all_pieces: DataFrame, placed: DataFrame, capacity: int = CAPACITY) -> dict:
    """Sequences used, and the number that no packing of these pieces can go below."""
    rows = all_pieces.groupBy("length").count().collect()  # at most ``capacity`` rows
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in rows:
        counts[length] = n
    used = placed.select(F.count_distinct("sequence_id")).first()[0]
    return {"sequences": used, "lower_bound": lower_bound(counts, capacity)}


def sequences(placed_pieces: DataFrame) -> DataFrame:
    """Real sequences (sequence_id, ids) from pieces with ids and their places.

    A sequence has at most ``capacity`` pieces, so each group is small.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed_pieces.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.expr("aggregate(parts, X'', (a, p) -> a || p.ids)").alias("ids")
    )
