"""Approximate nearest neighbours by cross-polytope hashing.

A vector is scaled to length 1, filled up with zeros to a power of two and turned
by three rounds of random signs and a fast Hadamard transform. Its code is the signed
axis it is nearest to; ``width`` such codes make the bucket of one table. Every vector
is filed in one bucket of each of ``tables`` tables; a query looks into the ``probes``
buckets per table whose axes it is nearest to. All vectors it meets are ranked by
their exact Euclidean distance, in double precision.

How wide the buckets are and how many a query looks into is measured, for each length of
vectors (``fit``): up to ``fit_queries`` distinct vectors out of a sample of ``fit_rows``
get their true neighbours by one pass over all rows, and of the ladder of settings that
find ``recall`` of these the one with the least work is taken: rows met, by their
share in the sample times the rows there are, plus buckets looked into, each of which
costs as much as ``bucket_rows`` rows. So buckets get narrower as the table grows. Where no setting finds enough, as with far more axes
than the ladder's probes or hardly any structure, every vector is met. Every row is filed,
whatever the sample.

Equal vectors are one class: it is filed once and carries its k + 1 smallest ids (the
most that one query can report), chosen inside every task before the shuffle. Of
a bucket a query keeps the k + 1 best classes, so what leaves a bucket is bounded. A
bucket with more than ``part_rows`` vectors is dealt out over several tasks, each of
which the queries visit, so no task's share grows with the table.

A query that meets fewer than k other vectors looks into every bucket of one table of
width 1, and so at all vectors: whoever has fewer than k results has no more candidates.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do rows without an id; rows that repeat id and vector
count once; vectors of different lengths are never compared; ties go to the
smaller id. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from webloom.session import stage_table


@dataclass(frozen=True)
class Settings:
    """``width`` and ``probes`` are measured where they are None; both or neither."""

    k: int = 10
    tables: int = 16
    probes: int | None = None
    width: int | None = None
    recall: float = 0.95
    part_rows: int = 20_000
    fit_rows: int = 4_000
    fit_queries: int = 64
    bucket_rows: int = 200
    seed: int = 11


# (width, probes per table) that a fit chooses from.
LADDER = ((1, 1), (1, 2), (1, 4), (1, 6), (1, 9), (1, 14), (1, 24), (1, 40), (1, 64),
          (2, 2), (2, 4), (2, 8), (2, 16), (2, 32), (2, 64), (2, 128))
# Probes of width 1 that look into every bucket.
ALL = 0


@dataclass(frozen=True)
class Plan:
    """How vectors of one length are filed and looked for; ``probes`` may be ALL."""

    width: int
    probes: int

    def of(self, s: Settings) -> Settings:
        return replace(s, width=self.width, probes=self.probes)


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows, without scaling."""
    rows, n = x.shape
    half = 1
    while half < n:
        x = x.reshape(rows, -1, 2, half)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(rows, n)
        half *= 2
    return x


def rotations(vectors: np.ndarray, s: Settings) -> Iterator[np.ndarray]:
    """The vectors under each of the tables' pseudo-rotations, ``width`` per table."""
    n = 1 << max(0, (vectors.shape[1] - 1).bit_length())
    # Scaled by the largest part first, so that no square overflows.
    unit = vectors / np.abs(vectors).max(1, keepdims=True)
    unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
    unit = np.pad(unit, ((0, 0), (0, n - vectors.shape[1])))
    rng = np.random.default_rng(s.seed)
    for _ in range(s.tables * s.width):
        turned = unit
        for _ in range(3):
            turned = hadamard(turned * rng.choice([-1.0, 1.0], n)) / np.sqrt(n)
        yield turned


def codes(vectors: np.ndarray, s: Settings) -> np.ndarray:
    """Vectors x tables: bucket numbers."""
    axes = []
    for turned in rotations(vectors, s):
        axis = np.abs(turned).argmax(1)
        axes.append(2 * axis + (turned[np.arange(len(turned)), axis] < 0))
    base = 2 * turned.shape[1]
    per_table = np.array(axes).reshape(s.tables, s.width, -1)
    return (per_table * base ** np.arange(s.width)[:, None]).sum(1).T


def probe_codes(vectors: np.ndarray, s: Settings, probes: int) -> np.ndarray:
    """Vectors x tables x probes: buckets by falling closeness of their axes."""
    out = []
    turns = list(rotations(vectors, s))
    base = 2 * turns[0].shape[1]
    for table in range(s.tables):
        total, number = np.zeros((len(vectors), 1)), np.zeros((len(vectors), 1), np.int64)
        for w, turned in enumerate(turns[table * s.width : (table + 1) * s.width]):
            signed = np.stack([turned, -turned], 2).reshape(len(vectors), base)
            best = np.argsort(-signed, 1, kind="stable")[:, :probes]
            close = np.take_along_axis(signed, best, 1)
            total = (total[:, :, None] + close[:, None]).reshape(len(vectors), -1)
            number = (number[:, :, None] + best[:, None] * base**w).reshape(len(vectors), -1)
            order = np.argsort(-total, 1, kind="stable")[:, :probes]
            total = np.take_along_axis(total, order, 1)
            number = np.take_along_axis(number, order, 1)
        out.append(number)
    return np.stack(out, 1)


def usable(vector: Column) -> Column:
    """Not null or empty, all parts finite, not all zero."""
    bad = F.exists(
        vector,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))),
    )
    return F.coalesce(
        (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False)
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    return flat.reshape(len(column), -1)


def _with_codes(kind: str, s: Settings, plans: Mapping[int, Plan], probing: bool):
    """Adds the buckets of each vector, or those it looks into, as lists per table in a row.

    Lengths without a plan of their own are met as a whole.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.names.index("vector"))
            sizes = column.value_lengths().to_numpy()
            for size in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == size))
                vectors = _matrix(part.column(part.schema.names.index("vector")))
                plan = plans.get(size, Plan(1, ALL))
                tables = s.tables if plan.probes != ALL else 1
                own = replace(plan.of(s), tables=tables)
                if probing:
                    every = 2 << max(0, (size - 1).bit_length())
                    found = probe_codes(vectors, own, plan.probes or every)
                else:
                    found = codes(vectors, own)
                found = found.reshape(len(vectors), -1).astype(np.int64)
                lists = pa.ListArray.from_arrays(
                    np.arange(len(found) + 1, dtype=np.int32) * found.shape[1], found.ravel()
                )
                each = pa.array(np.full(len(found), found.shape[1] // tables, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, lists, each], names=[*part.schema.names, kind, "each"]
                )

    return run


def classes_of(rows: DataFrame, k: int) -> DataFrame:
    """(rep, ids, vector, n_dims): distinct vectors with their k + 1 smallest ids."""
    order = Window.partitionBy("vector").orderBy("id")
    return (
        rows.distinct()
        .withColumn("_nth", F.row_number().over(order))
        .where(F.col("_nth") <= k + 1)
        .groupBy("vector")
        .agg(F.array_sort(F.collect_list("id")).alias("ids"))
        .select(F.col("ids")[0].alias("rep"), "ids", "vector", F.size("vector").alias("n_dims"))
    )


def _nearest(k: int):
    def run(key: tuple[pa.Scalar, ...], filed: pa.Table, asking: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if filed.num_rows and asking.num_rows:
            filed = filed.sort_by("rep")
            reps = filed["rep"].to_numpy()
            stock = _matrix(filed["vector"].combine_chunks())
            wanted = _matrix(asking["vector"].combine_chunks())
            for query, vector in zip(asking["rep"].to_numpy(), wanted):
                with np.errstate(over="ignore"):
                    distance = np.sqrt(((stock - vector) ** 2).sum(1))
                best = np.argsort(distance, kind="stable")[: k + 1]  # ties: smaller rep
                out.append((np.full(len(best), query), reps[best], distance[best]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [[], [], []]
        kinds = [pa.int64(), pa.int64(), pa.float64()]
        return pa.table(
            {n: pa.array(c, t) for n, c, t in zip(("query", "rep", "score"), columns, kinds)}
        )

    return run


def _true_neighbours(k: int, asking: Mapping[int, np.ndarray]):
    """Per batch the k nearest other vectors of each asking one, (n_dims, nth, score, vector)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch["n_dims"].to_numpy()
            for size in set(np.unique(sizes).tolist()) & asking.keys():
                part = batch.filter(pa.array(sizes == size))
                stock = _matrix(part["vector"])
                for nth, vector in enumerate(asking[size]):
                    with np.errstate(over="ignore"):
                        distance = np.sqrt(((stock - vector) ** 2).sum(1))
                    best = np.argsort(distance, kind="stable")
                    best = best[distance[best] > 0][:k]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(best), size, np.int32)),
                            pa.array(np.full(len(best), nth, np.int32)),
                            pa.array(distance[best]),
                            part["vector"].take(pa.array(best)),
                        ],
                        names=["n_dims", "nth", "score", "vector"],
                    )

    return run


def choose(
    asking: np.ndarray, near: list[np.ndarray], sample: np.ndarray, rows: int, s: Settings
) -> Plan:
    """The plan of least work that finds ``recall`` of the true neighbours ``near``."""
    axes = 2 << max(0, (asking.shape[1] - 1).bit_length())
    best, least = Plan(1, ALL), float(rows + s.bucket_rows * axes)
    owner = np.repeat(np.arange(len(near)), [len(n) for n in near])
    if not len(owner):
        return best
    found = np.concatenate([n for n in near if len(n)])
    for width in sorted({w for w, _ in LADDER}):
        steps = [p for w, p in LADDER if w == width and p <= axes**width]
        own = replace(s, width=width)
        looked = probe_codes(asking, own, max(steps))
        filed, target = codes(sample, own), codes(found, own)
        for probes in steps:
            into = looked[:, :, :probes]
            recall = (into[owner] == target[:, :, None]).any((1, 2)).mean()
            share = np.mean(
                [
                    np.any([np.isin(filed[:, t], q[t]) for t in range(s.tables)], axis=0).mean()
                    for q in into
                ]
            )
            work = share * rows + s.bucket_rows * s.tables * probes
            if recall >= s.recall and work < least:
                best, least = Plan(width, probes), work
    return best


def fit(classes: DataFrame, s: Settings) -> dict[int, Plan]:
    """A plan for each length of vectors that the sample holds.

    The sample is the ``fit_rows`` classes of lowest hash, at most that many rows on the
    driver; the true neighbours are k rows a query and come from one pass over all.
    """
    sample = (
        classes.select("n_dims", "vector")
        .orderBy(F.xxhash64("vector"), "vector")
        .limit(s.fit_rows)
        .toArrow()
    )
    by_size = {
        size: _matrix(
            sample.filter(pa.compute.equal(sample["n_dims"], size))["vector"].combine_chunks()
        )
        for size in sample["n_dims"].unique().to_pylist()
    }
    if not by_size:
        return {}
    asking = {size: rows[: s.fit_queries] for size, rows in by_size.items()}
    schema = f"n_dims int, nth int, score double, vector {classes.schema['vector'].dataType.simpleString()}"
    order = Window.partitionBy("n_dims", "nth").orderBy("score", "vector")
    near = (
        classes.select("n_dims", "vector")
        .mapInArrow(_true_neighbours(s.k, asking), schema)
        .withColumn("_at", F.row_number().over(order))
        .where(F.col("_at") <= s.k)
        .select("n_dims", "nth", "vector")
        .toArrow()
    )
    counts = dict(classes.where(F.col("n_dims").isin(list(by_size))).groupBy("n_dims").count().collect())
    plans = {}
    for size, rows in by_size.items():
        own = near.filter(pa.compute.equal(near["n_dims"], size))
        nth = own["nth"].to_numpy()
        found = _matrix(own["vector"].combine_chunks()) if len(own) else np.empty((0, size))
        true = [found[nth == n] for n in range(len(asking[size]))]
        plans[size] = choose(asking[size], true, rows, counts[size], s)
    return plans


def _met(classes: DataFrame, asking: DataFrame, s: Settings, plans: Mapping[int, Plan]) -> DataFrame:
    """(query, rep, score): the best classes of each bucket that a query looks into."""
    bucket = ["n_dims", "table", "code"]
    shape = f"rep long, vector {classes.schema['vector'].dataType.simpleString()}, n_dims int"
    narrow = ["rep", "vector", "n_dims"]
    coded = stage_table(
        classes.select(*narrow).mapInArrow(
            _with_codes("codes", s, plans, False), f"{shape}, codes array<long>, each int"
        ),
        "vector-codes",
    )
    filed = coded.select(*narrow, F.posexplode("codes").alias("table", "code"))
    large = stage_table(
        coded.select("n_dims", F.posexplode("codes").alias("table", "code"))
        .groupBy(*bucket)
        .count()
        .where(F.col("count") > s.part_rows)
        .select(*bucket, F.ceil(F.col("count") / F.lit(s.part_rows)).cast("int").alias("parts")),
        "large-buckets",
    )

    def parts(df: DataFrame) -> DataFrame:
        return df.join(large, bucket, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))

    looking = (
        asking.select(*narrow)
        .mapInArrow(
            _with_codes("looked", s, plans, True), f"{shape}, looked array<long>, each int"
        )
        .select(*narrow, "each", F.posexplode("looked").alias("nth", "code"))
        .withColumn("table", F.expr("cast(floor(nth / each) as int)"))
    )
    key = [*bucket, "part"]
    left = parts(filed).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    right = parts(looking).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    columns = [*key, "rep", "vector"]
    return (
        left.select(*columns)
        .groupBy(*key)
        .cogroup(right.select(*columns).groupBy(*key))
        .applyInArrow(_nearest(s.k), "query long, rep long, score double")
    )


def neighbours(
    table: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    settings: Settings | None = None,
) -> DataFrame:
    """(query_id, rank, id, score): each query's k nearest rows found, itself left out.

    ``is_query``: condition on the column ``id``.
    """
    s = settings or Settings()
    rows = table.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")
    ).where(F.col("id").isNotNull() & usable(F.col("vector")))
    classes = stage_table(classes_of(rows, s.k), "vector-classes")
    if s.probes is None:
        plans = fit(classes, s)
    else:
        sizes = classes.select("n_dims").distinct().collect()
        plans = {size: Plan(s.width or 1, s.probes) for (size,) in sizes}
    queries = stage_table(
        rows.where(is_query).distinct().join(classes.select("rep", "vector"), "vector").select(
            F.col("id").alias("query_id"), F.col("rep").alias("query")
        ),
        "vector-queries",
    )
    asking = classes.join(queries.select(F.col("query").alias("rep")).distinct(), "rep", "left_semi")
    met = stage_table(
        _met(classes, asking, s, plans)
        .groupBy("query", "rep")
        .agg(F.min("score").alias("score")),
        "vectors-met",
    )
    enough = met.groupBy("query").count().where(F.col("count") > s.k)
    short = asking.join(enough.select(F.col("query").alias("rep")), "rep", "left_anti")
    if not short.isEmpty():
        more = _met(classes, short, s, {})
        met = met.unionByName(more).groupBy("query", "rep").agg(F.min("score").alias("score"))
    best = Window.partitionBy("query").orderBy("score", "rep")
    nearest = (
        met.withColumn("_nth", F.row_number().over(best))
        .where(F.col("_nth") <= s.k + 1)
        .join(classes.select("rep", "ids"), "rep")
        .select("query", "score", F.explode("ids").alias("id"))
    )
    # At most (k + 1) squared rows for a distinct query vector.
    ranked = Window.partitionBy("query_id").orderBy("score", "id")
    return (
        queries.join(nearest, "query")
        .where("id != query_id")
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= s.k)
        .select("query_id", "rank", "id", "score")
    )
