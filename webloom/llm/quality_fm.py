"""Quality classifier: a factorisation machine over words, structure and metadata.

Score of a text x (sparse features x_i, weights w_i, factors v_i):

    w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i (v_if x_i)^2)

so that all pairwise interactions cost time linear in the features. Features are
hashed words (counts, scaled to length 1), binned structure statistics of the
bytes, words and lines, and binned metadata columns.

Training reads a bounded sample of labelled rows (``Settings.max_rows``, those
with the smallest hash of their id). Its features are staged once; every round,
the shards of the sample run AdaGrad in parallel from the same model and the
results are averaged. Scoring is one pass over whole texts without a shuffle.

Defined results: a null text counts as empty; an empty text has statistics but
no words and is scored like any other; a null, missing or non-numeric metadata
value has a bin of its own; rows with a null id or label are not learned from;
repeated labels of one id are each learned from; without any labelled row every
score is 0.5. Rows and extra columns are never dropped; an existing column named
like the score is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.llm import words as W
from webloom.session import stage_table

BINS = 16
NEWLINE = np.zeros(256, dtype=bool)
NEWLINE[10] = True


@dataclass(frozen=True)
class Settings:
    """Sizes of the model and of its training; none depends on the corpus."""

    word_buckets: int = 1 << 15
    factors: int = 8
    max_rows: int = 24_000
    shards: int = 6
    rounds: int = 4
    batch: int = 64
    rate: float = 0.08
    decay: float = 2e-5
    metadata: tuple[str, ...] = ("n_chars",)


@dataclass
class Model:
    settings: Settings
    edges: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    trained: bool = True


@dataclass
class Features:
    """Sparse rows: row r has entries first[r] up to first[r + 1]."""

    index: np.ndarray
    value: np.ndarray
    first: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))


def _class_table() -> np.ndarray:
    """256 x classes: which byte counts as what."""
    rows = [
        range(65, 91),
        range(97, 123),
        range(48, 58),
        [b for b in range(33, 127) if not chr(b).isalnum()],
        [ord(c) for c in ".,;:?'\"-()"],
        [ord("!")],
        [ord("|")],
        [ord(c) for c in "#$%&*"],
        [ord(c) for c in "<>{}[]=/\\_@"],
        range(128, 256),
        range(192, 256),
        [10],
        [9, 11, 12, 13, 32],
    ]
    table = np.zeros((256, len(rows)))
    for k, members in enumerate(rows):
        table[list(members), k] = 1
    return table


CLASSES = _class_table()


def statistics(texts: W.Texts, words: W.Words, distinct: np.ndarray) -> np.ndarray:
    """Texts x statistics: shares of byte classes, word and line shapes."""
    n, sizes = len(texts), np.diff(texts.offsets)
    row = np.repeat(np.arange(n) * 256, sizes)
    counts = np.bincount(row + texts.data, minlength=n * 256).reshape(n, 256) @ CLASSES
    n_words = np.diff(words.first)
    lines = W.words_of(texts, space=NEWLINE)
    n_lines = np.diff(lines.first)
    line_row = np.repeat(np.arange(n), n_lines)
    order = np.lexsort((lines.hashes, line_row))
    same = (np.diff(line_row[order]) == 0) & (np.diff(lines.hashes[order]) == 0)
    repeats = np.bincount(line_row[order][1:][same], minlength=n)
    # Words whose last byte is neither a letter, a digit nor a full stop or comma.
    odd_end = CLASSES[:, [5, 6, 7, 8]].any(1)[texts.data[words.ends - 1]]
    short = words.ends - words.starts == 1
    word_row = np.repeat(np.arange(n), n_words)
    per_word = np.maximum(n_words, 1)
    return np.column_stack(
        [
            counts / np.maximum(sizes, 1)[:, None],
            np.log1p(sizes),
            np.log1p(n_words),
            (sizes - counts[:, 11] - counts[:, 12]) / per_word,
            distinct / per_word,
            n_words / np.maximum(n_lines, 1),
            repeats / np.maximum(n_lines, 1),
            np.bincount(word_row, odd_end, n) / per_word,
            np.bincount(word_row, short, n) / per_word,
        ]
    )


def _metadata(batch: pa.RecordBatch, columns: Sequence[str], sizes: np.ndarray) -> np.ndarray:
    """Rows x (log of the value, its ratio to the bytes); NaN where unknown."""
    out = np.full((batch.num_rows, 2 * len(columns)), np.nan)
    for k, name in enumerate(columns):
        if name not in batch.schema.names:
            continue
        kind = batch.schema.field(name).type
        if pa.types.is_integer(kind) or pa.types.is_floating(kind):
            column = batch.column(batch.schema.names.index(name)).cast(pa.float64(), safe=False)
            value = np.array(column.to_numpy(zero_copy_only=False), dtype=float)
            with np.errstate(all="ignore"):
                out[:, 2 * k] = np.log1p(np.abs(value))
                out[:, 2 * k + 1] = value / np.maximum(sizes, 1)
    out[~np.isfinite(out)] = np.nan
    return out


def word_features(words: W.Words, buckets: int) -> tuple[Features, np.ndarray]:
    """Distinct hashed words of each text, counts scaled to Euclidean length 1."""
    n, n_words = len(words.first) - 1, np.diff(words.first)
    row = np.repeat(np.arange(n), n_words)
    bucket = (words.hashes >> np.uint64(40)).astype(np.int64) % buckets
    keys, counts = np.unique(row * buckets + bucket, return_counts=True)
    row, index = keys // buckets, keys % buckets
    length = np.sqrt(np.bincount(row, counts.astype(float) ** 2, n))
    first = np.searchsorted(row, np.arange(n + 1))
    return Features(index, counts / length[row], first), np.diff(first)


def raw_features(
    batch: pa.RecordBatch, text_col: str, settings: Settings
) -> Iterator[tuple[int, Features, np.ndarray]]:
    """(first row, word features, statistics and metadata) block by block."""
    texts = W.texts_of(batch.column(batch.schema.names.index(text_col)))
    meta = _metadata(batch, settings.metadata, np.diff(texts.offsets))
    for start, part in W.blocks(texts):
        words = W.words_of(part)
        found, distinct = word_features(words, settings.word_buckets)
        stats = statistics(part, words, distinct)
        yield start, found, np.hstack([stats, meta[start : start + len(part)]])


def with_bins(found: Features, dense: np.ndarray, edges: np.ndarray, buckets: int) -> Features:
    """Add one entry of value 1 per statistic: its bin. edges: statistics x (BINS - 1)."""
    n, m = dense.shape
    bins = np.empty((n, m), np.int64)
    for k in range(m):
        bins[:, k] = np.where(
            np.isnan(dense[:, k]), BINS, np.searchsorted(edges[k], dense[:, k], "right")
        )
    bins += buckets + np.arange(m) * (BINS + 1)
    # The bins go in front of each row's words.
    index = np.insert(found.index, np.repeat(found.first[:-1], m), bins.ravel())
    value = np.insert(found.value, np.repeat(found.first[:-1], m), 1.0)
    return Features(index, value, found.first + np.arange(n + 1) * m)


def raw_scores(x: Features, bias: float, weights: np.ndarray, factors: np.ndarray):
    """(score before the sigmoid, sum of v x) per row; every row has entries."""
    heads = x.first[:-1]
    vx = factors[x.index] * x.value[:, None]
    sums = np.add.reduceat(vx, heads, axis=0)
    squares = np.add.reduceat((vx * vx).sum(1), heads)
    linear = np.add.reduceat(weights[x.index] * x.value, heads)
    return bias + linear + 0.5 * ((sums * sums).sum(1) - squares), sums


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _part(x: Features, rows: np.ndarray) -> Features:
    sizes = np.diff(x.first)[rows]
    first = np.concatenate([[0], np.cumsum(sizes)])
    take = np.repeat(x.first[rows] - first[:-1], sizes) + np.arange(first[-1])
    return Features(x.index[take], x.value[take], first)


def train_shard(
    x: Features, label: np.ndarray, state: dict[str, np.ndarray], s: Settings, seed: int
) -> dict[str, np.ndarray]:
    """One pass of AdaGrad over a shard, from ``state``; returns the new state."""
    w = np.concatenate([state["w"], state["b"]])
    v, gw, gv = state["v"].copy(), state["gw"].copy(), state["gv"].copy()
    size = len(v)
    order = np.random.default_rng(seed).permutation(len(label))
    for at in range(0, len(order), s.batch):
        rows = order[at : at + s.batch]
        part = _part(x, rows)
        z, sums = raw_scores(part, w[-1], w[:-1], v)
        g = (sigmoid(z) - label[rows]) / len(rows)
        used, where = np.unique(part.index, return_inverse=True)
        row = np.repeat(np.arange(len(rows)), np.diff(part.first))
        gx = g[row] * part.value
        dw = np.bincount(where, gx, len(used)) + s.decay * w[used]
        per_entry = gx[:, None] * (sums[row] - part.value[:, None] * v[part.index])
        dv = np.column_stack(
            [np.bincount(where, per_entry[:, f], len(used)) for f in range(v.shape[1])]
        )
        dv += s.decay * v[used]
        gw[used] += dw * dw
        gv[used] += dv * dv
        w[used] -= s.rate * dw / np.sqrt(gw[used] + 1e-6)
        v[used] -= s.rate * dv / np.sqrt(gv[used] + 1e-6)
        gw[size] += g.sum() ** 2
        w[size] -= s.rate * g.sum() / np.sqrt(gw[size] + 1e-6)
    return {"w": w[:-1], "b": w[-1:], "v": v, "gw": gw, "gv": gv}


def _pack(state: dict[str, np.ndarray]) -> bytes:
    return np.concatenate([state[k].ravel() for k in ("w", "b", "v", "gw", "gv")]).astype(
        np.float32
    ).tobytes()


def _unpack(flat: np.ndarray, size: int, k: int) -> dict[str, np.ndarray]:
    cut = np.cumsum([size, 1, size * k, size + 1])
    w, b, v, gw, gv = np.split(flat.astype(float), cut)
    return {"w": w, "b": b, "v": v.reshape(size, k), "gw": gw, "gv": gv.reshape(size, k)}


def _learner(start: bytes, turn: int, edges: np.ndarray, s: Settings):
    """Group function: one pass over a shard's staged features, from model ``start``."""

    def learn(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("id", "ascending"), ("label", "ascending")])
        index, value = table["index"].combine_chunks(), table["value"].combine_chunks()
        first = np.concatenate([[0], np.cumsum(index.value_lengths().to_numpy())])
        words = Features(index.flatten().to_numpy(), value.flatten().to_numpy(), first)
        dense = table["dense"].combine_chunks().flatten().to_numpy().reshape(len(first) - 1, -1)
        x = with_bins(words, dense, edges, s.word_buckets)
        size = s.word_buckets + len(edges) * (BINS + 1)
        state = _unpack(np.frombuffer(start, np.float32), size, s.factors)
        out = train_shard(x, table["label"].to_numpy(), state, s, 1000 * turn + key[0].as_py())
        return pa.table({"shard": [key[0].as_py()], "state": [_pack(out)]})

    return learn


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    settings: Settings | None = None,
) -> Model:
    """Fit on at most ``max_rows`` rows of ``labels`` (id, 0/1 label) and their texts."""
    s = settings or Settings()
    meta = [c for c in s.metadata if c in docs.columns]
    chosen = (
        labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("double").alias("_label"))
        .where(F.col("_id").isNotNull() & F.col("_label").isNotNull())
        .orderBy(F.xxhash64("_id"), "_id", "_label")
        .limit(s.max_rows)
    )
    # At most max_rows rows of two numbers, hence small enough to broadcast.
    sample = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *meta).join(
        F.broadcast(chosen), "_id"
    )

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels_of = batch.column(batch.schema.names.index("_label")).to_numpy()
            ids = batch.column(batch.schema.names.index("_id"))
            for start, found, dense in raw_features(batch, "_text", s):
                n = len(dense)
                yield pa.RecordBatch.from_pydict(
                    {
                        "id": ids.slice(start, n).cast(pa.string()),
                        "label": labels_of[start : start + n],
                        "index": pa.ListArray.from_arrays(
                            found.first.astype(np.int32), found.index.astype(np.int32)
                        ),
                        "value": pa.ListArray.from_arrays(
                            found.first.astype(np.int32), found.value.astype(np.float32)
                        ),
                        "dense": pa.FixedSizeListArray.from_arrays(
                            dense.ravel(), dense.shape[1]
                        ).cast(pa.list_(pa.float64())),
                    }
                )

    shape = "id string, label double, index array<int>, value array<float>, dense array<double>"
    rows = stage_table(
        sample.mapInArrow(featurise, shape)
        .withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(s.shards)))
        .repartition(s.shards, "shard"),
        "quality-sample",
    )
    # A few hundred quantiles in all.
    n_stats = CLASSES.shape[1] + 8 + 2 * len(s.metadata)
    marks = [k / BINS for k in range(1, BINS)]
    found = rows.select(
        *[
            F.percentile(F.nanvl(F.col("dense")[k], F.lit(None)), marks).alias(f"q{k}")
            for k in range(n_stats)
        ]
    ).first()
    edges = np.full((n_stats, BINS - 1), np.inf)
    for k, quantiles in enumerate(found):
        values = np.unique(quantiles or [])
        edges[k, : len(values)] = values
    size = s.word_buckets + n_stats * (BINS + 1)
    rng = np.random.default_rng(7)
    state = {
        "w": np.zeros(size),
        "b": np.zeros(1),
        "v": rng.normal(0, 0.02, (size, s.factors)),
        "gw": np.zeros(size + 1),
        "gv": np.zeros((size, s.factors)),
    }
    trained = found[0] is not None
    for turn in range(s.rounds if trained else 0):
        learn = _learner(_pack(state), turn, edges, s)
        # One model of fixed size from each of a fixed number of shards.
        parts = rows.groupBy("shard").applyInArrow(learn, "shard long, state binary").collect()
        parts = sorted(parts, key=lambda r: r["shard"])
        mean = np.mean([np.frombuffer(r["state"], np.float32) for r in parts], axis=0)
        state = _unpack(mean, size, s.factors)
    return Model(s, edges, float(state["b"][0]), state["w"], state["v"], trained)


def score(
    docs: DataFrame,
    model: Model,
    text_col: str = "text",
    score_col: str = "score",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``docs`` (all columns, or those of ``keep``) with the probability of label 1."""
    s = model.settings
    kept = [c for c in (docs.columns if keep is None else keep) if c != score_col]
    read = [*dict.fromkeys([*kept, text_col, *(c for c in s.metadata if c in docs.columns)])]
    docs = docs.select(*read)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            out = np.full(batch.num_rows, 0.5)
            for start, found, dense in raw_features(batch, text_col, s) if m.trained else ():
                x = with_bins(found, dense, m.edges, s.word_buckets)
                z, _ = raw_scores(x, m.bias, m.weights, m.factors)
                out[start : start + len(dense)] = sigmoid(z)
            columns = [batch.column(batch.schema.names.index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out)], names=[*kept, score_col])

    schema = T.StructType(
        [*docs.select(*kept).schema, T.StructField(score_col, T.DoubleType())]
    )
    return docs.mapInArrow(run, schema)
