"""Substring dedup by recompression: passages of ``WINDOW`` words that an earlier
document holds are cut out.

*Naming.* The words of a text are parsed bottom up. A ``run`` step turns neighbours
of one name, together at most ``cap`` words, into one symbol; a ``pair`` step splits
all names into left and right ones by a bit of their hash and turns each left
symbol followed by a right one, together at most ``cap`` words, into one symbol. A
name is a 64-bit hash of the names it is made of, so all documents give equal
neighbours the same name without asking each other, and whether two symbols merge
depends on them alone. Equal passages are therefore parsed alike but for their ends:
a step can spoil at most ``cap`` - 1 words at each end. Over all ``STEPS`` that is
``MARGIN`` words, so the ``CORE`` words in the middle of a window lie in symbols that
every copy of the window has, and no symbol is longer than the core.

*Revealing.* Each block of documents sends the names of its high-level symbols (at
least ``HIGH`` words; lower ones only where they fill a whole core) and learns which of
them another document has, too (``block_exchange``). A window can only be repeated
if all symbols that reach into its core are shared.

*Verifying.* The windows that are left are sent as hashes of their words (64 bits and
a 32-bit check), each with the block's smallest document; a bucket tells whether
an earlier document has the same window. A passage in a third of all documents is
one entry per block and window.

Texts are shuffled once, dealt out in blocks; everything else is a few bytes per
symbol or revealed window.

Defined results: a null or empty text has no words; windows repeated inside one
document only are left alone; rows that share an id are not earlier than each other;
rows without an id come after all others. Only the id and text columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm import block_exchange as X
from webloom.llm import words as W

WINDOW = 50
STEPS = (
    ("run", 3), ("pair", 2), ("pair", 2), ("run", 4), ("pair", 4), ("pair", 4), ("pair", 8),
)
HIGH = 4
MARGIN = sum(cap - 1 for _, cap in STEPS)
CORE = WINDOW - 2 * MARGIN
assert max(cap for _, cap in STEPS) <= CORE

SYMBOL_WIDTH = 5
WINDOW_FACT = np.dtype([("doc", "<i8"), ("check", "<u4")])
NO_ID = np.iinfo(np.int64).max

_LEFT = np.uint64(0xD6E8FEB86659FD93)
_RIGHT = np.uint64(0xA5CB9243F9F2B7E5)
_RUN = np.uint64(0xE7037ED1A0B428DB)
_CHECK = np.uint64(0x8EBC6AF09C88C6E3)


def parse(names: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(names, lengths in words) of the top symbols of words that belong to ``doc``."""
    length = np.ones(len(names), np.int64)
    for step, (kind, cap) in enumerate(STEPS):
        if len(names) < 2:
            break
        near = doc[1:] == doc[:-1]
        if kind == "run":
            head = np.concatenate([[True], ~(near & (names[1:] == names[:-1]))])
            heads = np.flatnonzero(head)
            count = np.diff(np.append(heads, len(names)))
            total = count * length[heads]
            merge = (count > 1) & (total <= cap)
            at = heads[merge]
            names = names.copy()
            names[at] = W.mix(names[at] * _RUN + count[merge].astype(np.uint64) * _CHECK)
            length[at] = total[merge]
            keep = head | ~np.repeat(merge, count)
        else:
            right = W.mix(names ^ (_CHECK * np.uint64(step + 1))) >> np.uint64(63) == 1
            merge = near & ~right[:-1] & right[1:] & (length[:-1] + length[1:] <= cap)
            at = np.flatnonzero(merge)
            names = names.copy()
            names[at] = W.mix(names[at] * _LEFT + names[at + 1] * _RIGHT + _CHECK)
            length[at] += length[at + 1]
            keep = np.concatenate([[True], ~merge])
        names, doc, length = names[keep], doc[keep], length[keep]
    return names, length


class Block:
    """Words and symbols of a block's documents."""

    def __init__(self, docs: pa.Table):
        self.ids = docs["id"].combine_chunks().fill_null(NO_ID).to_numpy()
        self.texts = W.texts_of(docs["text"])
        hashes, first = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
        seen = 0
        for _, part in W.blocks(self.texts):
            words = W.words_of(part)
            hashes.append(words.hashes)
            first.append(words.first[1:] + seen)
            seen += len(words.hashes)
        self.words = np.concatenate(hashes)
        self.first = np.concatenate(first)
        self.row = np.repeat(np.arange(len(self.ids)), np.diff(self.first))
        self.names, self.length = parse(self.words, self.row)
        self.start = np.cumsum(self.length) - self.length

    def sent_symbols(self) -> np.ndarray:
        """Which symbols are sent: the high ones, and low ones that fill a core."""
        high = self.length >= HIGH
        row = self.row[self.start]
        # Stretches of low symbols inside one document.
        cut = np.ones(len(high), bool)
        cut[1:] = high[1:] | high[:-1] | (row[1:] != row[:-1])
        stretch = np.cumsum(cut) - 1
        covered = np.bincount(stretch, self.length) if len(high) else np.zeros(0)
        return high | (covered[stretch] >= CORE)

    def symbols(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct names sent, and whether at least two documents here have each."""
        sent = self.sent_symbols()
        names, doc = self.names[sent], self.ids[self.row[self.start[sent]]]
        order = np.argsort(names, kind="stable")
        names, doc = names[order], doc[order]
        if not len(names):
            return names, np.zeros(0, "<u1")
        heads = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
        several = np.minimum.reduceat(doc, heads) != np.maximum.reduceat(doc, heads)
        return names[heads], np.where(several, 2, 1).astype("<u1")

    def revealed(self, known: np.ndarray, shared: np.ndarray) -> np.ndarray:
        """First words of the windows that may be repeated."""
        n = len(self.words)
        if n < WINDOW:
            return np.zeros(0, np.int64)
        sent = self.sent_symbols()
        is_shared = np.zeros(len(self.names), bool)
        is_shared[sent] = shared[np.searchsorted(known, self.names[sent])] > 0
        high = np.repeat(self.length >= HIGH, self.length)
        lone = ~np.repeat(is_shared, self.length)

        def in_core(mark: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0], np.cumsum(mark)])
            low = np.arange(n - WINDOW + 1) + MARGIN
            return total[low + CORE] - total[low]

        fine = (in_core(high & lone) == 0) & ((in_core(high) > 0) | (in_core(lone) == 0))
        inside = self.row[: n - WINDOW + 1] == self.row[WINDOW - 1 :]
        return np.flatnonzero(fine & inside)

    def windows(self, at: np.ndarray):
        """Distinct windows among those at ``at``: hashes, facts, and each one's place."""
        sums = [W.span_sums(v, at, at + WINDOW) for v in (self.words, W.mix(self.words ^ _CHECK))]
        full, check = W.mix(sums[0]), W.mix(sums[1]).astype("<u4")
        doc = self.ids[self.row[at]]
        distinct, place = np.unique(full, return_inverse=True)
        facts = np.zeros(len(distinct), WINDOW_FACT)
        facts["doc"] = NO_ID
        np.minimum.at(facts["doc"], place, doc)
        facts["check"][place] = check
        return distinct, facts, place, doc


def _shared(group: np.ndarray, n: int, facts: np.ndarray) -> np.ndarray:
    return (np.bincount(group, facts, n) > 1)[group]


def _earlier(group: np.ndarray, n: int, facts: np.ndarray) -> np.ndarray:
    """Whether another block has the same window in an earlier document."""
    if not n:
        return np.zeros(0, bool)
    order = np.lexsort((facts["check"], group))
    g, c = group[order], facts["check"][order]
    heads = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (c[1:] != c[:-1])]))
    doc = facts["doc"][order]
    least = np.repeat(np.minimum.reduceat(doc, heads), np.diff(np.append(heads, len(g))))
    out = np.empty(len(group), bool)
    out[order] = least < doc
    return out


def _send_symbols(plan: X.Plan):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table) -> pa.Table:
        with np.errstate(over="ignore"):
            names, facts = Block(docs).symbols()
            return X.send(key[0].as_py(), names, facts, plan, SYMBOL_WIDTH)

    return run


def _send_windows(plan: X.Plan):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, answers: pa.Table) -> pa.Table:
        with np.errstate(over="ignore"):
            block = Block(docs)
            names, _ = block.symbols()
            at = block.revealed(names, X.received(answers, names, plan))
            windows, facts, _, _ = block.windows(at)
            return X.send(key[0].as_py(), windows, facts, plan, 8)

    return run


CUT = (
    "id long, n_words long, n_removed long, kept_text string, "
    "removed array<struct<start: long, stop: long>>"
)
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def _cut_block(plan: X.Plan):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, answers: pa.Table) -> pa.Table:
        with np.errstate(over="ignore"):
            block = Block(docs)
            names, _ = block.symbols()
            kind = answers["kind"].combine_chunks()
            about = [answers.filter(pa.compute.equal(kind, k)) for k in (0, 1)]
            at = block.revealed(names, X.received(about[0], names, plan))
            windows, facts, place, doc = block.windows(at)
            elsewhere = X.received(about[1], windows, plan)[place] > 0
        at = at[elsewhere | (facts["doc"][place] < doc)]
        depth = np.zeros(len(block.words) + 1, np.int64)
        np.add.at(depth, at, 1)
        np.add.at(depth, at + WINDOW, -1)
        gone = np.cumsum(depth)[:-1] > 0
        removed = np.bincount(block.row, gone, len(block.ids)).astype(np.int64)
        texts, spans = [], []
        for row in range(len(block.ids)):
            low, high = block.texts.offsets[row : row + 2]
            found = block.texts.data[low:high].tobytes().split()
            if removed[row]:
                mask = gone[block.first[row] : block.first[row + 1]]
                edges = np.flatnonzero(np.diff(np.concatenate([[0], mask, [0]]))).reshape(-1, 2)
                spans.append([{"start": a, "stop": b} for a, b in edges.tolist()])
                found = [w for w, out in zip(found, mask.tolist()) if not out]
            else:
                spans.append([])
            texts.append(b" ".join(found))
        return pa.table(
            {
                "id": docs["id"],
                "n_words": np.diff(block.first),
                "n_removed": removed,
                "kept_text": pa.array(texts, pa.binary()).cast(pa.string()),
                "removed": pa.array(spans, _SPANS),
            }
        )

    return run


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept_text, removed): spans of words, and what is left."""
    plan = X.plan_for(docs, text_col)
    blocks = X.in_blocks(docs, plan, id_col, text_col)
    symbols = blocks.groupBy("block").applyInArrow(_send_symbols(plan), X.SENT)
    shared = X.answer(symbols, plan, SYMBOL_WIDTH, "<u1", _shared)
    windows = (
        blocks.groupBy("block")
        .cogroup(shared.groupBy("block"))
        .applyInArrow(_send_windows(plan), X.SENT)
    )
    earlier = X.answer(windows, plan, 8, WINDOW_FACT, _earlier)
    answers = shared.withColumn("kind", F.lit(0)).unionByName(
        earlier.withColumn("kind", F.lit(1))
    )
    return (
        blocks.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(_cut_block(plan), CUT)
    )
