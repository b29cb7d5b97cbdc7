"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

Features of a whole text (``FEATURES``): densities of a lexicon's words in three tiers of
strength, as they stand and behind obfuscation (``unmask``: digits and signs for letters,
stretched letters, letters spelled out); how close they stand to words of second person;
capitals; punctuation; rates of obfuscation; lengths.

The lexicon is mined from labelled rows: words, and beginnings of words of 4 to 6 bytes, with
their log odds of standing in a toxic text. Rows of one half get the features of a lexicon
mined from the other half, so that the trees do not learn from what the lexicon remembers;
new texts get that of both halves. Shards of the sample boost trees in parallel, each
over its own rows; a text's raw score is the mean over shards. The calibration is fitted on
raw scores that each row gets from the other shards.

Training reads a bounded sample of labelled rows (``Settings.max_rows``, those with the
smallest hash of their id), with whole texts. Scoring is one pass without a shuffle.

Defined results: a null text counts as empty; empty and blank texts have features like any
other; texts of any length are read whole (a block holds at least one text); rows with a null
id or label are not learned from; repeated labels of one id are each learned from. If
the labelled rows are not of both classes, every score is their share of label 1, and 0 if
there are none. Rows and extra columns are never dropped; an existing column named like
the score is replaced. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.llm import words as W
from webloom.session import stage_table


@dataclass(frozen=True)
class Settings:
    """Sizes of the model and of its training; none depends on the corpus."""

    max_rows: int = 24_000
    entries: int = 20_000
    candidates: int = 400_000
    support: int = 4
    shards: int = 6
    trees: int = 40
    depth: int = 4
    bins: int = 32
    rate: float = 0.2
    near: int = 5


# Least log odds of a word of each tier.
TIERS = (4.0, 2.5, 1.2)
STEMS = (4, 5, 6)
# Words that address the reader.
SECOND_PERSON = (
    "you your yours yourself u ur du dich dir dein deine deinen deiner ihr euch euer eure "
    "tu te toi ton ta tes vous votre vos usted ustedes ti tus vosotros os"
).split()

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_GAP = ~(_LETTER | _DIGIT)
# Signs that stand for letters.
_MEANT = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
_UNLEET = W.LOWER.copy()
for _sign, _letter in _MEANT.items():
    _UNLEET[ord(_sign)] = ord(_letter)
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in _MEANT]] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[b for b in range(33, 127) if not chr(b).isalnum()]] = True


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, tag: int) -> np.ndarray:
    sums = W.span_sums(data.astype(np.uint64) + np.uint64(1), starts, ends)
    lengths = (ends - starts).astype(np.uint64) + np.uint64(tag << 32)
    return W.mix(sums + lengths * np.uint64(0x9E3779B97F4A7C15))


def entry_hashes(data: np.ndarray, words: W.Words) -> np.ndarray:
    """Words x (the word, its beginnings): what a lexicon may hold; 0 where a word is too short."""
    out = np.zeros((len(words.starts), 1 + len(STEMS)), np.uint64)
    out[:, 0] = _hashes(data, words.starts, words.ends, 0)
    for k, size in enumerate(STEMS, 1):
        long = words.ends - words.starts >= size
        starts = words.starts[long]
        out[long, k] = _hashes(data, starts, starts + size, 1)
    return out


def plain_words(texts: W.Texts) -> tuple[np.ndarray, W.Words]:
    return W.LOWER[texts.data], W.words_of(texts, lower=True, space=_GAP)


def unmask(texts: W.Texts) -> tuple[np.ndarray, W.Words, np.ndarray]:
    """Lower-case bytes with obfuscation undone, their words, and which of these it changed.

    Digits and signs next to letters become the letters they look like; of three or more
    equal letters one stays; separators between three or more single letters go.
    """
    data, n = texts.data, len(texts.data)
    if not n:
        none = np.zeros(0, bool)
        return data, W.words_of(texts), none
    edge = np.zeros(n + 1, bool)
    edge[texts.offsets] = True
    letter = _LETTER[data]
    beside = np.zeros(n, bool)
    beside[1:] |= letter[:-1] & ~edge[1:-1]
    beside[:-1] |= letter[1:] & ~edge[1:-1]
    turned = _SIGN[data] & beside
    low = np.where(turned, _UNLEET[data], W.LOWER[data])
    # Runs of one letter: every byte after the first goes if there are three or more.
    first = np.ones(n, bool)
    first[1:] = (low[1:] != low[:-1]) | edge[1:-1]
    run = np.cumsum(first) - 1
    stretched = (np.bincount(run)[run] >= 3) & (_LETTER[low] & (low < 128)) & ~first
    # Single letters with one separator between: x.y.z
    inside = _LETTER[low] | _DIGIT[low]
    left_free = np.ones(n, bool)
    right_free = np.ones(n, bool)
    left_free[1:] = ~inside[:-1] | edge[1:-1]
    right_free[:-1] = ~inside[1:] | edge[1:-1]
    single = inside & left_free & right_free
    joint = np.zeros(n, bool)
    if n > 2:
        joint[1:-1] = ~inside[1:-1] & single[:-2] & single[2:] & ~edge[1:-2] & ~edge[2:-1]
    chained = np.zeros(n, bool)  # separators with another one two places away
    chained[:-2] |= joint[2:]
    chained[2:] |= joint[:-2]
    joint &= chained
    gone = stretched | joint
    keep = ~gone
    place = np.concatenate([[0], np.cumsum(keep)])
    touched = turned.copy()
    touched[1:] |= gone[:-1]
    touched[:-1] |= gone[1:]
    kept = W.Texts(low[keep], place[texts.offsets])
    words = W.words_of(kept, space=_GAP)
    marks = np.concatenate([[0], np.cumsum(touched[keep])])
    return kept.data, words, marks[words.ends] > marks[words.starts]


@dataclass
class Lexicon:
    """Sorted hashes of words and beginnings, with their log odds."""

    hashes: np.ndarray
    odds: np.ndarray

    def strength(self, found: np.ndarray) -> np.ndarray:
        """Greatest log odds among each row's entries, 0 for none."""
        if not len(self.hashes) or not len(found):
            return np.zeros(len(found))
        at = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
        return np.where(self.hashes[at] == found, self.odds[at], 0.0).max(1)


def _second_person() -> np.ndarray:
    joined = W.texts_of(pa.array(SECOND_PERSON))
    _, words = plain_words(joined)
    return np.sort(words.hashes)


_YOU = _second_person()

FEATURES = (
    *[f"{view}_{what}_{t}" for view in ("plain", "masked") for t in range(len(TIERS)) for what in ("log", "density")],
    "plain_max", "masked_max", "plain_mean",
    "you_density", "near_you", "near_share", "closest",
    "capital_letters", "capital_words", "capital_hits",
    "punctuation", "exclamations", "questions", "double_marks",
    "masked_words", "starred_words", "digit_words",
    "log_bytes", "log_words",
)


def _tier_columns(row: np.ndarray, strength: np.ndarray, n: int, per: np.ndarray) -> list[np.ndarray]:
    out, above = [], np.inf
    for low in TIERS:
        hits = np.bincount(row, (strength >= low) & (strength < above), n)
        out += [np.log1p(hits), hits / per]
        above = low
    return out


def _distance(hit: np.ndarray, you: np.ndarray, row: np.ndarray, far: int) -> np.ndarray:
    """Words between each hit and the nearest word of second person in its text, at most ``far``."""
    if not len(hit) or not len(you):
        return np.full(len(hit), far)
    at = np.searchsorted(you, hit)
    best = np.full(len(hit), far)
    for side in (at - 1, at):
        ok = (side >= 0) & (side < len(you))
        other = you[np.clip(side, 0, len(you) - 1)]
        ok &= row[other] == row[hit]
        best = np.where(ok, np.minimum(best, np.abs(other - hit)), best)
    return best


def features(texts: W.Texts, lexicon: Lexicon, near: int) -> np.ndarray:
    """Texts x ``FEATURES`` of one block."""
    n, data = len(texts), texts.data
    sizes = np.diff(texts.offsets)
    low, words = plain_words(texts)
    n_words = np.diff(words.first)
    row = np.repeat(np.arange(n), n_words)
    per = np.maximum(n_words, 1)
    strength = lexicon.strength(entry_hashes(low, words))
    bare, other, changed = unmask(texts)
    other_row = np.repeat(np.arange(n), np.diff(other.first))
    masked = np.where(changed, lexicon.strength(entry_hashes(bare, other)), 0.0)

    def top(r, s):
        out = np.zeros(n)
        np.maximum.at(out, r, s)
        return out

    hit = np.flatnonzero(strength >= TIERS[1])
    at = np.minimum(np.searchsorted(_YOU, words.hashes), len(_YOU) - 1)
    you = np.flatnonzero(_YOU[at] == words.hashes)
    away = _distance(hit, you, row, 50)
    close = np.bincount(row[hit], away <= near, n)
    hits = np.bincount(row[hit], minlength=n)
    closest = np.full(n, 50.0)
    np.minimum.at(closest, row[hit], away)

    def share(mask):
        marks = np.concatenate([[0], np.cumsum(mask)])
        return marks[texts.offsets[1:]] - marks[texts.offsets[:-1]]

    def inside(mask):
        marks = np.concatenate([[0], np.cumsum(mask)])
        return marks[words.ends] - marks[words.starts]

    upper = (data >= 65) & (data <= 90)
    lengths = words.ends - words.starts
    shouted = (inside(upper) == lengths) & (lengths >= 2)
    digits = inside(_DIGIT[data])
    double = np.zeros(len(data), bool)
    double[1:] = (data[1:] == data[:-1]) & ((data[1:] == 33) | (data[1:] == 63))
    starred = np.zeros(len(data), bool)
    if len(data) > 2:
        starred[1:-1] = (data[1:-1] == 42) & _LETTER[data[:-2]] & (_LETTER[data[2:]] | (data[2:] == 42))
    size = np.maximum(sizes, 1)
    columns = [
        *_tier_columns(row, strength, n, per),
        *_tier_columns(other_row, masked, n, per),
        top(row, strength),
        top(other_row, masked),
        np.bincount(row, strength, n) / per,
        np.bincount(row[you], minlength=n) / per,
        np.log1p(close),
        close / np.maximum(hits, 1),
        closest,
        share(upper) / np.maximum(share(_LETTER[data]), 1),
        np.bincount(row, shouted, n) / per,
        np.bincount(row[hit], shouted[hit], n) / np.maximum(hits, 1),
        share(_PUNCTUATION[data]) / size,
        share(data == 33) / size,
        share(data == 63) / size,
        share(double) / size,
        np.bincount(other_row, changed, n) / per,
        share(starred) / per,
        np.bincount(row, (digits > 0) & (digits < lengths), n) / per,
        np.log1p(sizes),
        np.log1p(n_words),
    ]
    return np.column_stack(columns)


# ------------------------------------------------------------------ boosting


@dataclass
class Trees:
    """Complete trees: feature and last bin to the left per inner node, value per leaf."""

    feature: np.ndarray
    last: np.ndarray
    value: np.ndarray

    def raw(self, bins: np.ndarray) -> np.ndarray:
        n, trees = len(bins), len(self.feature)
        node = np.zeros((n, trees), np.int64)
        tree = np.arange(trees)
        rows = np.arange(n)[:, None]
        inner = self.feature.shape[1]
        for _ in range((inner + 1).bit_length() - 1):
            right = bins[rows, self.feature[tree, node]] > self.last[tree, node]
            node = 2 * node + 1 + right
        return self.value[tree, node - inner].sum(1)


def boost(bins: np.ndarray, label: np.ndarray, s: Settings) -> Trees:
    """Boosted trees for the logistic loss, splits from histograms of the bins."""
    n, m = bins.shape
    inner = 2**s.depth - 1
    feature = np.zeros((s.trees, inner), np.int64)
    last = np.full((s.trees, inner), s.bins, np.int64)
    value = np.zeros((s.trees, inner + 1))
    raw = np.zeros(n)
    width = s.bins + 1
    for t in range(s.trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - label, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(n, np.int64)
        for level in range(s.depth):
            head, count = 2**level - 1, 2**level
            local = (node - head) * width
            gains = np.zeros((m, count, width))
            for f in range(m):
                cell = local + bins[:, f]
                gl = np.cumsum(np.bincount(cell, g, count * width).reshape(count, width), axis=1)
                hl = np.cumsum(np.bincount(cell, h, count * width).reshape(count, width), axis=1)
                gr, hr = gl[:, -1:] - gl, hl[:, -1:] - hl
                gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - gl[:, -1:] ** 2 / (hl[:, -1:] + 1)
                gains[f] = np.where((hl >= 1) & (hr >= 1), gain, 0)
            best = gains.transpose(1, 0, 2).reshape(count, m * width).argmax(1)
            found = gains.max((0, 2)) > 1e-6
            feature[t, head : head + count] = np.where(found, best // width, 0)
            last[t, head : head + count] = np.where(found, best % width, s.bins)
            node = 2 * node + 1 + (bins[np.arange(n), feature[t, node]] > last[t, node])
        leaf = node - inner
        value[t] = -s.rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + 1)
        raw += value[t][leaf]
    return Trees(feature, last, value)


def isotonic(raw: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising step function of least squares as knots (raw score, share of label 1)."""
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []  # sum of labels, rows, sum of scores
    for x, y in zip(raw[order].tolist(), label[order].tolist()):
        blocks.append([y, 1, x])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            tail = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], tail)]
    return (
        np.array([b[2] / b[1] for b in blocks]),
        np.array([b[0] / b[1] for b in blocks]),
    )


@dataclass
class Model:
    settings: Settings
    lexicon: Lexicon
    edges: np.ndarray
    trees: Trees | None
    knots: tuple[np.ndarray, np.ndarray]
    share: float

    def raw(self, dense: np.ndarray) -> np.ndarray:
        return self.trees.raw(binned(dense, self.edges)) / self.settings.shards

    def predict(self, dense: np.ndarray) -> np.ndarray:
        if self.trees is None:
            return np.full(len(dense), self.share)
        return np.interp(self.raw(dense), *self.knots)


def binned(dense: np.ndarray, edges: np.ndarray) -> np.ndarray:
    out = np.empty(dense.shape, np.int64)
    for k in range(dense.shape[1]):
        out[:, k] = np.searchsorted(edges[k], dense[:, k], "left")
    return out


def _blocks(batch: pa.RecordBatch, text_col: str) -> Iterator[tuple[int, W.Texts]]:
    return W.blocks(W.texts_of(batch.column(batch.schema.names.index(text_col))))


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.names.index(name)).to_numpy(zero_copy_only=False)


def _distinct_entries(texts: W.Texts, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(group of the text, entry) once per text and entry."""
    low, words = plain_words(texts)
    found = entry_hashes(low, words)
    row = np.repeat(np.arange(len(texts)), np.diff(words.first))
    row = np.repeat(row, found.shape[1])
    found = found.ravel()
    row, found = row[found != 0], found[found != 0]
    order = np.lexsort((found, row))
    row, found = row[order], found[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1])
    return group[row[new]], found[new]


def _count_entries(known: np.ndarray | None):
    """Task function: texts per entry and half; all entries, or those ``known`` (sorted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, entries = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for batch in batches:
            half = _column(batch, "half").astype(np.int64)
            for start, part in _blocks(batch, "text"):
                group, found = _distinct_entries(part, half[start : start + len(part)])
                if known is not None:
                    at = np.minimum(np.searchsorted(known, found), max(len(known) - 1, 0))
                    keep = known[at] == found if len(known) else np.zeros(len(found), bool)
                    group, found = group[keep], found[keep]
                groups.append(group)
                entries.append(found)
        group, found = np.concatenate(groups), np.concatenate(entries)
        for half in (0, 1):
            values, counts = np.unique(found[group == half], return_counts=True)
            yield pa.RecordBatch.from_pydict(
                {"half": np.full(len(values), half), "entry": values.astype(np.int64), "n": counts}
            )

    return run


def _mine(sample: DataFrame, s: Settings) -> dict[int | None, Lexicon]:
    """Lexicons of the halves 0 and 1 and of both (None)."""
    sizes = {
        (r["half"], r["label"]): r["count"] for r in sample.groupBy("half", "label").count().collect()
    }
    shape = "half long, entry long, n long"

    def counts(label: int, known: np.ndarray | None) -> DataFrame:
        rows = sample.where(F.col("label") == label).select("half", "text")
        per_task = rows.mapInArrow(_count_entries(known), shape)
        return per_task.groupBy("half", "entry").agg(F.sum("n").alias("n"))

    # Entries of toxic texts, at most ``candidates``; then how many clean texts have them.
    per_entry = counts(1, None).groupBy("entry").agg(
        F.sum(F.when(F.col("half") == 0, F.col("n")).otherwise(0)).alias("t0"),
        F.sum(F.when(F.col("half") == 1, F.col("n")).otherwise(0)).alias("t1"),
    )
    enough = per_entry.where(F.col("t0") + F.col("t1") >= s.support)
    toxic = enough.orderBy(F.desc(F.col("t0") + F.col("t1")), "entry").limit(s.candidates).toPandas()
    entry = toxic["entry"].to_numpy(np.int64).astype(np.uint64)
    order = np.argsort(entry)
    entry = entry[order]
    positive = toxic[["t0", "t1"]].to_numpy(np.float64)[order]
    negative = np.zeros((len(entry), 2))
    for half, e, n in counts(0, entry).toPandas().itertuples(index=False):  # among those entries
        negative[np.searchsorted(entry, np.uint64(e & (2**64 - 1))), half] = n

    def lexicon(halves: list[int]) -> Lexicon:
        t, c = positive[:, halves].sum(1), negative[:, halves].sum(1)
        all_t = sum(sizes.get((h, 1), 0) for h in halves)
        all_c = sum(sizes.get((h, 0), 0) for h in halves)
        odds = np.log((t + 0.5) / (all_t - t + 0.5)) - np.log((c + 0.5) / (all_c - c + 0.5))
        good = np.flatnonzero((t >= s.support) & (odds >= TIERS[-1]))
        good = np.sort(good[np.argsort(-odds[good], kind="stable")[: s.entries]])
        return Lexicon(entry[good], odds[good])

    return {0: lexicon([0]), 1: lexicon([1]), None: lexicon([0, 1])}


def _learner(edges: np.ndarray, s: Settings):
    def learn(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("id", "ascending"), ("label", "ascending")])
        dense = np.array(table["dense"].to_pylist(), dtype=float)
        trees = boost(binned(dense, edges), table["label"].to_numpy().astype(float), s)
        flat = [trees.feature.tolist(), trees.last.tolist(), trees.value.tolist()]
        return pa.table(
            {
                "shard": [key[0].as_py()],
                "feature": [sum(flat[0], [])],
                "last": [sum(flat[1], [])],
                "value": [sum(flat[2], [])],
            }
        )

    return learn


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    id_col: str = "doc_id",
    text_col: str = "text",
    settings: Settings | None = None,
) -> Model:
    """Fit on at most ``max_rows`` rows of ``labels`` (id, 0/1 label) and their texts."""
    s = settings or Settings()
    chosen = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .where(F.col("id").isNotNull() & F.col("label").isin(0, 1))
        .orderBy(F.xxhash64("id"), "id", "label")
        .limit(s.max_rows)
    )
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    # At most max_rows rows of two numbers are broadcast.
    sample = stage_table(
        texts.join(F.broadcast(chosen), "id").select(
            F.col("id").cast("string").alias("id"),
            "text",
            "label",
            F.pmod(F.xxhash64(F.lit("half"), "id"), F.lit(2)).alias("half"),
        ),
        "toxicity-sample",
    )
    n, ones = sample.agg(F.count(F.lit(1)), F.sum("label")).first()
    share = (ones or 0) / n if n else 0.0
    empty = np.zeros(0)
    if share in (0.0, 1.0):
        nothing = Lexicon(empty.astype(np.uint64), empty)
        return Model(s, nothing, np.zeros((len(FEATURES), 0)), None, (empty, empty), share)
    lexicons = _mine(sample, s)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            half = _column(batch, "half")
            dense = np.zeros((batch.num_rows, len(FEATURES)))
            for start, part in _blocks(batch, "text"):
                here = half[start : start + len(part)]
                for h in (0, 1):
                    if (here == h).any():
                        values = features(part, lexicons[1 - h], s.near)
                        dense[start : start + len(part)][here == h] = values[here == h]
            out = {c: batch.column(batch.schema.names.index(c)) for c in ("id", "label")}
            yield pa.RecordBatch.from_pydict({**out, "dense": list(dense)})

    rows = stage_table(
        sample.mapInArrow(featurise, "id string, label int, dense array<double>")
        .withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(s.shards)))
        .repartition(s.shards, "shard"),
        "toxicity-features",
    )
    marks = [k / s.bins for k in range(1, s.bins)]
    found = rows.select(
        *[F.percentile(F.col("dense")[k], marks).alias(f"q{k}") for k in range(len(FEATURES))]
    ).first()
    edges = np.full((len(FEATURES), s.bins - 1), np.inf)
    for k, quantiles in enumerate(found):
        values = np.unique(quantiles)
        edges[k, : len(values)] = values
    # Trees of fixed number from each of a fixed number of shards.
    learned = rows.groupBy("shard").applyInArrow(
        _learner(edges, s), "shard long, feature array<long>, last array<long>, value array<double>"
    )
    parts: dict[int, Trees] = {}
    for r in learned.collect():
        shape = (s.trees, -1)
        parts[r["shard"]] = Trees(
            np.array(r["feature"]).reshape(shape), np.array(r["last"]).reshape(shape), np.array(r["value"]).reshape(shape)
        )

    def other_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dense = np.array(batch.column(batch.schema.names.index("dense")).to_pylist(), float)
            shard = _column(batch, "shard")
            bins = binned(dense.reshape(-1, len(FEATURES)), edges)
            each = {k: t.raw(bins) for k, t in parts.items()}
            whole = sum(each.values())
            own = np.array([each[k][i] for i, k in enumerate(shard)])
            mean = (whole - own) / max(len(parts) - 1, 1)
            label = batch.column(batch.schema.names.index("label"))
            yield pa.RecordBatch.from_pydict({"raw": mean, "label": label})

    # Two numbers per sampled row.
    pairs = rows.mapInArrow(other_shards, "raw double, label int").toPandas()
    pairs = pairs.sort_values(["raw", "label"])
    knots = isotonic(pairs["raw"].to_numpy(), pairs["label"].to_numpy(float))
    order = sorted(parts)
    trees = Trees(
        *[np.concatenate([getattr(parts[k], part) for k in order]) for part in ("feature", "last", "value")]
    )
    # The mean is over the shards that have rows.
    trees.value *= s.shards / len(parts)
    return Model(s, lexicons[None], edges, trees, knots, share)


def score(
    docs: DataFrame,
    model: Model,
    text_col: str = "text",
    score_col: str = "score",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``docs`` (all columns, or those of ``keep``) with the probability of label 1."""
    kept = [c for c in (docs.columns if keep is None else keep) if c != score_col]
    docs = docs.select(*dict.fromkeys([*kept, text_col]))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            dense = np.zeros((batch.num_rows, len(FEATURES)))
            if m.trees is not None:
                for start, part in _blocks(batch, text_col):
                    dense[start : start + len(part)] = features(part, m.lexicon, m.settings.near)
            columns = [batch.column(batch.schema.names.index(c)) for c in kept]
            out = pa.array(m.predict(dense))
            yield pa.RecordBatch.from_arrays([*columns, out], names=[*kept, score_col])

    schema = T.StructType([*docs.select(*kept).schema, T.StructField(score_col, T.DoubleType())])
    return docs.mapInArrow(run, schema)
