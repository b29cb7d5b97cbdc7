"""Prefix trie of conversations: shared openings, their members and what sharing them saves.

A node is a distinct sequence of first turns (role, text). Its key is the depth and a
128-bit hash of the sequence; that all members of a node have the same last turn and the
same parent is checked while they are counted, so by induction whole sequences are equal.

Totals of subtrees come from time-forward processing. Nodes are dealt out in shards: a
shard is a largest subtree with at most ``Settings.members`` conversations, cut at every
``Settings.band``-th depth. Tasks sort their shards' nodes in reverse level order (Spark's
external sort), walk over them once and pass each node's total to its parent through a
priority queue that spills sorted runs (``MessageQueue``). What a finished shard adds up to
goes to the node above its root. The nodes above shards, and shards that have others below
them, are then the nodes of the next round, with both bounds raised to the next power. So
each round leaves a few hundredths of the nodes at most, no group outgrows the bounds, and
the number of rounds is the logarithm of the number of conversations. On the way back, only
shards that were cut by depth are walked over again.

Conversations of any length are spread over tasks: turns are numbered by one range sort,
and prefix hashes are summed within bands of depths. Texts are hashed where they are read
and never shuffled.

Defined results: a null role or text is empty; turns are ordered by their number, null
first, then by role and a hash of the turn; equal turns stay, one after the other. Rows
without a conversation id belong to no conversation and are left out; a table without
conversations has no nodes, not even a root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webloom.llm.ordering import numbered
from webloom.session import stage_table

KEY = ["d", "k1", "k2"]
PARENT = ["pd", "p1", "p2"]
SHARD = ["sd", "s1", "s2"]
_WORD_GAP = r"[\x20\x09-\x0D]+"
_CHUNK = 4096


@dataclass(frozen=True)
class Settings:
    """Bounds of a shard, at least 2 each; ``queue`` is how many messages a task holds in memory."""

    members: int = 256
    band: int = 1024
    queue: int = 100_000

    def __post_init__(self) -> None:
        if min(self.members, self.band) < 2:
            raise ValueError("bounds of a shard below 2 never grow")


# ------------------------------------------------------------- turns and paths


def turn_rows(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(c, pos, a, b, words): turns from 0 per conversation, hashed, with the words of the text."""
    role = F.coalesce(F.col(role_col), F.lit(""))
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role), F.lit(":"), role, text), 256)
    half = lambda at: F.conv(F.substring("digest", at, 16), 16, -10).cast("bigint")
    rows = (
        turns.where(F.col(conv_col).isNotNull())
        .select(
            F.col(conv_col).cast("bigint").alias("c"),
            F.col(turn_col).alias("turn"),
            role.alias("role"),
            digest.alias("digest"),
            F.size(F.filter(F.split(text, _WORD_GAP), lambda w: w != "")).cast("bigint").alias("words"),
        )
        .select("c", "turn", "role", half(1).alias("a"), half(17).alias("b"), "words")
        .withColumn("row", F.monotonically_increasing_id())
    )
    # The row number keeps even a turn that is repeated very often from being one range.
    placed = numbered(rows, ["c", "turn", "role", "a", "b", "row"])
    return stage_table(placed.select("c", "place", "a", "b", "words"), "trie-turns")


def conversations(rows: DataFrame) -> DataFrame:
    """(c, start, n) per conversation of ``turn_rows``."""
    return rows.groupBy("c").agg(F.min("place").alias("start"), F.count(F.lit(1)).alias("n"))


def paths_of(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """(c, d, a, b, words, ends) of whole conversations, as they are."""
    return rows.join(convs, "c").select(
        "c",
        (F.col("place") - F.col("start") + 1).alias("d"),
        "a",
        "b",
        "words",
        (F.col("place") - F.col("start") + 1 == F.col("n")).alias("ends"),
    )


def with_shared_heads(
    rows: DataFrame, convs: DataFrame, base: Column, heads: Column, most: int
) -> tuple[DataFrame, DataFrame]:
    """Paths and (c, length) where the first ``heads`` turns come from conversation ``base``.

    A conversation keeps its own turns after its first ``heads`` (at most ``most``); a base
    with fewer turns, or none, gives what it has.
    """
    frame = convs.select("c", "start", "n", base.alias("base"), heads.cast("bigint").alias("h"))
    bases = convs.select(F.col("c").alias("base"), F.col("n").alias("base_n"))
    frame = stage_table(
        frame.join(bases, "base", "left").select(
            "c",
            "start",
            "base",
            "h",
            F.least("h", F.coalesce("base_n", F.lit(0))).alias("lead"),
            F.greatest(F.col("n") - F.col("h"), F.lit(0)).alias("rest"),
        ),
        "trie-conversations",
    )
    length = F.col("lead") + F.col("rest")
    # The turns of a conversation that is most of the table are on the left, where they split.
    numbered_rows = rows.join(frame, "c").withColumn("pos", F.col("place") - F.col("start"))
    own = numbered_rows.where("pos >= h").withColumn("d", F.col("pos") - F.col("h") + F.col("lead") + 1)
    first = rows.join(convs.select("c", "start"), "c").select(
        F.col("c").alias("base"), (F.col("place") - F.col("start")).alias("pos"), "a", "b", "words"
    )
    lent = (
        frame.join(first.where(F.col("pos") < most), "base")
        .where("pos < h")
        .withColumn("d", F.col("pos") + 1)
    )
    columns = ["c", "d", "a", "b", "words", (F.col("d") == length).alias("ends")]
    return own.select(*columns).unionByName(lent.select(*columns)), frame.select("c", length.alias("length"))


def prefixes(paths: DataFrame, s: Settings) -> DataFrame:
    """Paths with the key of each prefix (d, k1, k2) and of the one before it (p1, p2).

    A prefix is the XOR of hashes of its turns, each bound to its depth: running XORs
    within a band of depths on top of the XOR of all bands before.
    """
    rows = paths.select(
        "*",
        F.xxhash64("d", "a", "b").alias("x"),
        F.xxhash64(F.lit(1), "b", "a", "d").alias("y"),
        F.expr(f"(d - 1) div {s.band}").alias("band"),
    )
    bands = rows.groupBy("c", "band").agg(F.bit_xor("x").alias("bx"), F.bit_xor("y").alias("by"))
    earlier = Window.partitionBy("c").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    carry = bands.select(
        "c",
        "band",
        *[F.coalesce(F.bit_xor(n).over(earlier), F.lit(0)).alias(n) for n in ("bx", "by")],
    ).where("bx != 0 OR by != 0")
    upto = Window.partitionBy("c", "band").orderBy("d")
    whole = rows.select(
        "*", F.bit_xor("x").over(upto).alias("rx"), F.bit_xor("y").over(upto).alias("ry")
    ).join(carry, ["c", "band"], "left")
    k1 = F.col("rx").bitwiseXOR(F.coalesce("bx", F.lit(0)))
    k2 = F.col("ry").bitwiseXOR(F.coalesce("by", F.lit(0)))
    return whole.select(
        "c", "d", "a", "b", "words", "ends", k1.alias("k1"), k2.alias("k2"),
        k1.bitwiseXOR(F.col("x")).alias("p1"), k2.bitwiseXOR(F.col("y")).alias("p2"),
    )


def _one(name: str) -> Column:
    return F.min(name) == F.max(name)


def _nodes(steps: DataFrame) -> DataFrame:
    """(d, k1, k2, p1, p2, conv_id, n_convs, words) per node below the root."""
    clash = F.raise_error(F.lit("two sequences of turns share a 128-bit hash")).cast("bigint")
    equal = _one("a") & _one("b") & _one("p1") & _one("p2")
    return steps.groupBy(*KEY).agg(
        F.when(equal, F.count(F.lit(1))).otherwise(clash).alias("n_convs"),
        F.min("c").alias("conv_id"),
        F.min("words").alias("words"),
        F.min("p1").alias("p1"),
        F.min("p2").alias("p2"),
    )


# --------------------------------------------------- time-forward processing


class MessageQueue:
    """Messages (key, leaves, saved), taken in order of their keys; a full heap becomes a sorted
    run in a file of the task, which vanishes with it."""

    _RECORD = struct.Struct("<5q")

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.heap: list[tuple] = []
        self.runs: list[list] = []  # [next record, rest of the run]

    def push(self, key: tuple[int, int, int], leaves: int, saved: int) -> None:
        heapq.heappush(self.heap, (*key, leaves, saved))
        if len(self.heap) >= self.limit:
            self._spill()

    def _spill(self) -> None:
        file = tempfile.TemporaryFile()
        for record in sorted(self.heap):
            file.write(self._RECORD.pack(*record))
        file.seek(0)
        self.heap = []
        rest = self._read(file)
        self.runs.append([next(rest), rest])

    def _read(self, file) -> Iterator[tuple]:
        with file:
            while raw := file.read(self._RECORD.size * 1024):
                yield from self._RECORD.iter_unpack(raw)

    def take(self, key: tuple[int, int, int]) -> tuple[int, int]:
        """Sums of the messages to ``key``. Keys are asked for in rising order."""
        leaves = saved = 0
        while self.heap and self.heap[0][:3] == key:
            *_, more, save = heapq.heappop(self.heap)
            leaves, saved = leaves + more, saved + save
        for run in self.runs:
            while run[0] is not None and run[0][:3] == key:
                leaves, saved = leaves + run[0][3], saved + run[0][4]
                run[0] = next(run[1], None)
        if any(run[0] is None for run in self.runs):
            self.runs = [run for run in self.runs if run[0] is not None]
        return leaves, saved


def _walker(limit: int):
    """Task function over nodes sorted by shard, then deepest level first."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, queue = None, MessageQueue(limit)
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in [*SHARD, *KEY, *PARENT, "leaves", "saved"]]
            sums_l, sums_s = [], []
            for sd, s1, s2, d, k1, k2, pd, p1, p2, leaves, saved in zip(*columns):
                if (sd, s1, s2) != shard:
                    shard, queue = (sd, s1, s2), MessageQueue(limit)
                more, save = queue.take((-d, k1, k2))
                leaves, saved = leaves + more, saved + save
                sums_l.append(leaves)
                sums_s.append(saved)
                if (d, k1, k2) != shard:
                    queue.push((-pd, p1, p2), leaves, saved)
            out = {n: batch.column(n) for n in [*KEY, *PARENT, *SHARD]}
            out["leaves"] = pa.array(sums_l, pa.int64())
            out["saved"] = pa.array(sums_s, pa.int64())
            yield pa.RecordBatch.from_pydict(out)

    return run


_WALKED = ", ".join(f"{n} bigint" for n in [*KEY, *PARENT, *SHARD, "leaves", "saved"])


def walk(nodes: DataFrame, limit: int) -> DataFrame:
    """Totals of every node's subtree inside its shard."""
    ordered = (
        nodes.select(*KEY, *PARENT, *SHARD, "leaves", "saved")
        .repartition(*SHARD)
        .sortWithinPartitions(*SHARD, F.desc("d"), "k1", "k2")
    )
    return ordered.mapInArrow(_walker(limit), _WALKED)


def _equal(columns: list[str], others: list[str]) -> Column:
    out = F.lit(True)
    for a, b in zip(columns, others):
        out = out & (F.col(a) == F.col(b))
    return out


def _as(df: DataFrame, columns: list[str], others: list[str], *rest) -> DataFrame:
    return df.select(*[F.col(a).alias(b) for a, b in zip(columns, others)], *rest)


def _sharded(nodes: DataFrame, path_rows: DataFrame, turn: int, s: Settings) -> DataFrame:
    """Nodes with the key of their shard's root, null above all shards of this round."""
    members, band = s.members ** (turn + 1), s.band ** (turn + 1)
    here = F.expr(f"(d - 1) div {band}")
    cut = F.min(F.when(F.col("n_convs") <= members, F.struct(*KEY)))
    cuts = path_rows.groupBy(F.col("c").alias("conv_id"), here.alias("band")).agg(cut.alias("cut"))
    met = nodes.withColumn("band", here).join(cuts, ["conv_id", "band"], "left")
    own = lambda k: F.when(F.col("n_convs") <= members, F.col("cut")[k])
    return met.select(*nodes.columns, *[own(k).alias(n) for k, n in zip(KEY, SHARD)])


def subtree_totals(nodes: DataFrame, path_rows: DataFrame, s: Settings) -> DataFrame:
    """(d, k1, k2, leaves, saved) summed over every node's subtree.

    ``nodes``: the key, the parent's (pd, p1, p2), conv_id, n_convs and the node's own leaves
    and saved; parents of depth 0 are the root, which is not among them. ``path_rows``: (c, key,
    n_convs) for each prefix of each conversation.
    """
    rounds: list[tuple[DataFrame, DataFrame, DataFrame]] = []
    current = nodes
    while True:
        turn = len(rounds)
        sharded = stage_table(_sharded(current, path_rows, turn, s), f"trie-shards-{turn}")
        local = stage_table(walk(sharded.where("sd IS NOT NULL"), s.queue), f"trie-totals-{turn}")
        roots = local.where(_equal(KEY, SHARD))
        # What a shard's root hangs on: a node above all shards, or the shard of its parent.
        above = _as(sharded, KEY, PARENT, *[F.coalesce(a, b).alias(f"h{b}") for a, b in zip(SHARD, KEY)])
        hub = [f"h{k}" for k in KEY]
        hung = stage_table(roots.join(above, PARENT, "left"), f"trie-roots-{turn}")
        rounds.append((sharded, local, hung))
        hubs = _as(hung.where("hd IS NOT NULL"), hub, KEY).distinct()
        inner = stage_table(hung.join(hubs, KEY, "left_semi"), f"trie-hubs-{turn}")
        tops = sharded.where("sd IS NULL")
        if inner.isEmpty() and tops.isEmpty():
            break
        done = _as(
            hung.where("hd IS NOT NULL").join(hubs, KEY, "left_anti"), hub, KEY, "leaves", "saved"
        )
        about = sharded.select(*KEY, "conv_id", "n_convs")
        joint = inner.join(about, KEY)
        weights = (
            tops.select(*KEY, "leaves", "saved")
            .unionByName(inner.select(*KEY, "leaves", "saved"))
            .unionByName(done)
            .groupBy(*KEY)
            .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        )
        parents = tops.select(*KEY, *PARENT, "conv_id", "n_convs").unionByName(
            joint.select(
                *KEY,
                *[F.coalesce(h, p).alias(p) for h, p in zip(hub, PARENT)],
                "conv_id",
                "n_convs",
            )
        )
        current = stage_table(parents.join(weights, KEY), f"trie-nodes-{turn + 1}")
    totals = None
    for turn in range(len(rounds) - 1, -1, -1):
        totals = _final(*rounds[turn], turn, totals, s)
        if turn:
            totals = stage_table(totals, f"trie-final-{turn}")
    return totals


def _final(
    sharded: DataFrame,
    local: DataFrame,
    hung: DataFrame,
    turn: int,
    higher: DataFrame | None,
    s: Settings,
) -> DataFrame:
    """Totals of a round's nodes; ``local``: those inside shards, ``higher``: those of the nodes
    that the next round had."""
    out = [*KEY, "leaves", "saved"]
    if higher is None:
        return local.select(*out)
    # Shards with others below them: their roots are among ``higher``.
    open_shards = _as(
        hung.where("hd IS NOT NULL").select("hd", "hk1", "hk2").distinct(), ["hd", "hk1", "hk2"], SHARD
    )
    closed = local.join(open_shards, SHARD, "left_anti").select(*out)
    again = sharded.join(open_shards, SHARD, "left_semi")
    final_roots = hung.select(*KEY, *PARENT, "leaves", "saved").join(
        higher.select(*KEY, F.col("leaves").alias("fl"), F.col("saved").alias("fs")), KEY, "left"
    )
    given = _as(
        final_roots.groupBy(*PARENT).agg(
            F.sum(F.coalesce("fl", "leaves")).alias("gl"), F.sum(F.coalesce("fs", "saved")).alias("gs")
        ),
        PARENT,
        KEY,
        "gl",
        "gs",
    )
    loaded = stage_table(
        again.join(given, KEY, "left")
        .withColumn("leaves", F.col("leaves") + F.coalesce("gl", F.lit(0)))
        .withColumn("saved", F.col("saved") + F.coalesce("gs", F.lit(0)))
        .drop("gl", "gs"),
        f"trie-loaded-{turn}",
    )
    walked = walk(loaded, s.queue).select(*out)
    tops = sharded.where("sd IS NULL").select(*KEY).join(higher.select(*out), KEY)
    return closed.unionByName(walked).unionByName(tops)


# ------------------------------------------------------------------ the trie


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, conversation) rows to lists of ids, at most ``_CHUNK`` of one node each."""
    key, ids = None, []

    def flush() -> pa.RecordBatch:
        values = [*key, ids[0], ",".join(map(str, ids))]
        return pa.RecordBatch.from_pydict(dict(zip([*KEY, "first", "ids"], [[v] for v in values])))

    for batch in batches:
        out = []
        for *at, c in zip(*[batch.column(n).to_pylist() for n in [*KEY, "c"]]):
            if ids and (at != key or len(ids) == _CHUNK):
                out.append(flush())
                ids = []
            key = at
            ids.append(c)
        if out:
            yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
    if ids:
        yield flush()


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted lists of ids to one sha256 per node, list by list."""
    key, state = None, None
    for batch in batches:
        keys, found = [], []
        for *at, ids in zip(*[batch.column(n).to_pylist() for n in [*KEY, "ids"]]):
            if at != key:
                if state:
                    keys.append(key)
                    found.append(state.hexdigest())
                key, state = at, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        if keys:
            yield pa.RecordBatch.from_pydict({**dict(zip(KEY, zip(*keys))), "ends_sha256": found})
    if state:
        yield pa.RecordBatch.from_pydict({**{n: [v] for n, v in zip(KEY, key)}, "ends_sha256": [state.hexdigest()]})


def end_digests(ends: DataFrame) -> DataFrame:
    """(d, k1, k2, ends_sha256): hash of the ids, ascending and joined by commas, that end there.

    ``ends``: (d, k1, k2, c). Ids are sorted by range and joined in pieces, so a node that ends
    a large part of all conversations is many pieces; only these meet in one task, as a stream.
    """
    key = ", ".join(f"{n} bigint" for n in KEY)
    pieces = (
        ends.select(*KEY, "c")
        .repartitionByRange(*KEY, "c")
        .sortWithinPartitions(*KEY, "c")
        .mapInArrow(_runs, f"{key}, first bigint, ids string")
    )
    return (
        pieces.repartition(*KEY)
        .sortWithinPartitions(*KEY, "first")
        .mapInArrow(_digests, f"{key}, ends_sha256 string")
    )


def trie(paths: DataFrame, lengths: DataFrame, settings: Settings | None = None) -> DataFrame:
    """One row per node: its key, smallest member (``conv_id``), depth ``d``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    ``paths``: (c, d, a, b, words, ends), one row per turn of every conversation; ``lengths``:
    (c, length) of all conversations, also of those without a turn.
    """
    s = settings or Settings()
    zero = F.lit(0).cast("bigint")
    steps = stage_table(prefixes(paths, s), "trie-steps")
    lengths = stage_table(lengths, "trie-lengths")
    counted = stage_table(_nodes(steps), "trie-counted")
    kids = counted.groupBy((F.col("d") - 1).alias("pd"), "p1", "p2").agg(
        F.count(F.lit(1)).alias("n_children")
    )
    nodes = stage_table(
        counted.join(_as(kids, PARENT, KEY, "n_children"), KEY, "left")
        .withColumn("pd", F.col("d") - 1)
        .withColumn("n_children", F.coalesce("n_children", zero))
        .withColumn("leaves", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint"))
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("words")),
        "trie-nodes",
    )
    path_rows = stage_table(steps.select("c", *KEY).join(nodes.select(*KEY, "n_convs"), KEY), "trie-paths")
    totals = subtree_totals(nodes.select(*KEY, *PARENT, "conv_id", "n_convs", "leaves", "saved"), path_rows, s)
    totals = stage_table(totals, "trie-subtrees")
    first = totals.where("d = 1").agg(
        F.count(F.lit(1)).alias("n_children"), F.sum("leaves").alias("l"), F.sum("saved").alias("s")
    )
    everyone = lengths.agg(F.min("c").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    root = everyone.where("n_convs > 0").crossJoin(first).select(  # one row each
        *[zero.alias(n) for n in KEY],
        zero.alias("pd"),
        zero.alias("p1"),
        zero.alias("p2"),
        "conv_id",
        "n_convs",
        "n_children",
        F.when(F.col("n_children") == 0, 1).otherwise(F.col("l")).alias("leaves"),
        F.coalesce("s", zero).alias("saved"),
    )
    whole = nodes.drop("leaves", "saved").join(totals, KEY).select(root.columns).unionByName(root)
    ends = steps.where("ends").select(*KEY, "c").unionByName(
        lengths.where("length = 0").select(*[zero.alias(n) for n in KEY], "c")
    )
    ended = stage_table(end_digests(ends), "trie-ends")
    upper = _as(nodes, KEY, PARENT, F.col("conv_id").alias("parent_conv_id")).unionByName(
        _as(root, KEY, PARENT, F.col("conv_id").alias("parent_conv_id"))
    )
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        whole.withColumn("pd", F.when(F.col("d") > 0, F.col("pd")))
        .join(ended, KEY, "left")
        .join(upper, PARENT, "left")
        .select(
            *KEY,
            "conv_id",
            "parent_conv_id",
            "n_convs",
            "n_children",
            F.col("leaves").cast("bigint").alias("n_leaves"),
            F.col("saved").cast("bigint").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
        )
    )
