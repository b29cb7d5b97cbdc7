"""Mixing to target weights with soft domain membership, in DataFrame functions only.

1. A labelled table (id, domain) trains a classifier: naive Bayes over hashed words,
   counted by Spark on at most ``max_rows`` labelled documents (those with the smallest
   hash of their id). The result is ``buckets`` x domains log-likelihoods.
2. Every document gets posteriors p over the domains: the softmax of its prior plus
   ``sharpness`` times the mean log-likelihood of its words, over its whole text.
3. Document d of n_d words has a rate r_d >= 0, at first 1. With T_k the target
   share of domain k times all words, projected gradient descent lowers

       1/2 sum_k (sum_d n_d p_dk r_d - T_k)^2 / M_kk,   M_kl = sum_d n_d p_dk p_dl

   in the metric that weighs a rate by its words: r <- max(0, r - step p.g). A round
   is one aggregate of as many numbers as domains. A rate is a function of
   the posteriors and the rounds' gradients, so no table is rewritten.
4. ``copies`` = floor(rate + u), u uniform in [0, 1) from a hash of the id: whole
   documents in the expected amount.

Defined results: a null or empty text has no words, the prior as posteriors and counts
for nothing in the totals; rows that repeat an id are answered one by one, and
``mixed`` gives them the largest of their copies; rows without an id share one u, and
``mixed`` leaves them as they are; null domains, and domains without a target, are
not learned; a target without a labelled document is left out and the others keep
their proportions; without any labelled document, or words, all rates are 1.
Extra columns are not read, and ``mixed`` keeps them.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.session import stage_table


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 12
    max_rows: int = 10_000
    sharpness: float = 12.0
    smoothing: float = 0.5
    max_rounds: int = 30
    tolerance: float = 1e-4


def codes(text: Column, buckets: int) -> Column:
    """Bucket of each word."""
    found = F.filter(
        F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda w: w != ""
    )
    return F.transform(found, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))


@dataclass
class Classifier:
    domains: list[str]
    priors: list[float]
    tables: list[list[float]]


def train(
    docs: DataFrame,
    labelled: DataFrame,
    domains: Sequence[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    settings: Settings | None = None,
) -> Classifier:
    """``labelled``: (id, domain). Counts come to the driver: ``buckets`` x domains."""
    s = settings or Settings()
    chosen = (
        labelled.select(F.col(id_col).alias("_id"), F.col("domain").alias("_domain"))
        .where(F.col("_id").isNotNull() & F.col("_domain").isin(*domains))
        .orderBy(F.xxhash64("_id"), "_id", "_domain")
        .limit(s.max_rows)
    )
    # At most max_rows rows, hence small enough to broadcast.
    sample = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(
        F.broadcast(chosen), "_id"
    )
    seen = sample.select("_domain", F.explode(codes(F.col("_text"), s.buckets)).alias("code"))
    counts = {(r[0], r[1]): r[2] for r in seen.groupBy("_domain", "code").count().collect()}
    per_domain = {r[0]: r[1] for r in sample.groupBy("_domain").count().collect()}
    known = [d for d in domains if per_domain.get(d)]
    total = sum(per_domain.get(d, 0) for d in known)
    tables, priors = [], []
    for d in known:
        words = sum(counts.get((d, b), 0) for b in range(s.buckets)) + s.smoothing * s.buckets
        tables.append(
            [math.log((counts.get((d, b), 0) + s.smoothing) / words) for b in range(s.buckets)]
        )
        priors.append(math.log(per_domain[d] / total))
    return Classifier(known, priors, tables)


def _literal(values: Sequence[float]) -> Column:
    """One constant array, folded by the optimizer."""
    return F.split(F.lit(",".join(f"{v:.17g}" for v in values)), ",").cast("array<double>")


def with_posteriors(
    docs: DataFrame, model: Classifier, text_col: str = "text", settings: Settings | None = None
) -> DataFrame:
    """``docs`` with n_tokens and posteriors (array in the model's order of domains)."""
    s = settings or Settings()
    coded = docs.withColumn("_codes", codes(F.col(text_col), s.buckets))
    n = F.size("_codes")

    def total(table: list[float]) -> Column:
        values = _literal(table)
        return F.aggregate("_codes", F.lit(0.0), lambda a, c: a + F.get(values, c))

    scored = coded.withColumns(
        {"n_tokens": n.cast("long")}
        | {f"_s{k}": total(t) for k, t in enumerate(model.tables)}
    )
    logits = [
        F.lit(p) + F.when(F.col("n_tokens") > 0, s.sharpness * F.col(f"_s{k}") / F.col("n_tokens"))
        .otherwise(F.lit(0.0))
        for k, p in enumerate(model.priors)
    ]
    names = [f"_l{k}" for k in range(len(logits))]
    with_logits = scored.withColumns(dict(zip(names, logits)))
    top = F.greatest(*names) if len(names) > 1 else F.col(names[0])
    parts = with_logits.withColumn("_top", top).withColumn(
        "_e", F.array(*[F.exp(F.col(c) - F.col("_top")) for c in names])
    )
    norm = F.aggregate("_e", F.lit(0.0), lambda a, e: a + e)
    return (
        parts.withColumn("_norm", norm)
        .withColumn("posteriors", F.transform("_e", lambda e: e / F.col("_norm")))
        .drop("_codes", "_e", "_norm", "_top", *names, *[f"_s{k}" for k in range(len(names))])
    )


def rate(posteriors: Column, gradients: Sequence[Sequence[float]]) -> Column:
    """The rate after these rounds."""
    if not gradients:
        return F.lit(1.0)
    rounds = F.array(*[F.array(*map(F.lit, map(float, g))) for g in gradients])
    k = len(gradients[0])

    def step(r: Column, g: Column) -> Column:
        move = sum((posteriors[i] * g[i] for i in range(1, k)), posteriors[0] * g[0])
        return F.greatest(F.lit(0.0), r - move)

    return F.aggregate(rounds, F.lit(1.0), step)


def fit(
    members: DataFrame, weights: Sequence[float], settings: Settings | None = None
) -> list[list[float]]:
    """Gradients, one list per round. ``members``: n_tokens, posteriors; read each round."""
    s = settings or Settings()
    k = len(weights)
    p, n = F.col("posteriors"), F.col("n_tokens")
    row = members.select(
        F.sum(n), *[F.sum(n * p[i] * p[j]) for i in range(k) for j in range(k)]
    ).first()
    words = row[0] or 0
    if not words or not k:
        return []
    m = [[row[1 + i * k + j] / words for j in range(k)] for i in range(k)]
    scale = [1 / m[i][i] if m[i][i] > 0 else 0.0 for i in range(k)]
    # Largest eigenvalue of the scaled matrix, by its largest row sum.
    step = 1 / max(1e-12, max(sum(scale[i] * m[i][j] for j in range(k)) for i in range(k)))
    gradients: list[list[float]] = []
    for _ in range(s.max_rounds):
        r = rate(p, gradients)
        sums = members.select(*[F.sum(n * p[i] * r) for i in range(k)]).first()
        gap = [sums[i] / words - weights[i] for i in range(k)]
        if max(map(abs, gap)) <= s.tolerance:
            break
        gradients.append([step * scale[i] * gap[i] for i in range(k)])
    return gradients


def uniform(id_col: str) -> Column:
    """In [0, 1), the same for an id at all times."""
    return F.shiftrightunsigned(F.xxhash64(F.lit("mixing"), id_col), 11) / F.lit(float(1 << 53))


def rates(
    docs: DataFrame,
    labelled: DataFrame,
    targets: Mapping[str, float],
    id_col: str = "doc_id",
    text_col: str = "text",
    settings: Settings | None = None,
) -> DataFrame:
    """(id, n_tokens, posteriors, rate, copies) of every row of ``docs``."""
    s = settings or Settings()
    source = docs.select(id_col, F.col(text_col).alias("_text"))
    model = train(docs, labelled, list(targets), id_col, text_col, s)
    if not model.domains:
        return source.select(
            id_col,
            F.size(codes(F.col("_text"), s.buckets)).cast("long").alias("n_tokens"),
            F.array().cast("array<double>").alias("posteriors"),
            F.lit(1.0).alias("rate"),
            F.lit(1).cast("long").alias("copies"),
        )
    wide = sum(targets[d] for d in model.domains) or 1.0
    weights = [targets[d] / wide for d in model.domains]
    # The numbers of all documents, read every round; texts are not written.
    members = stage_table(
        with_posteriors(source, model, "_text", s).select(id_col, "n_tokens", "posteriors"),
        "mixing-members",
    )
    gradients = fit(members, weights, s)
    return members.withColumn("rate", rate(F.col("posteriors"), gradients)).withColumn(
        "copies", F.floor(F.col("rate") + uniform(id_col)).cast("long")
    )


def mixed(
    docs: DataFrame,
    labelled: DataFrame,
    targets: Mapping[str, float],
    id_col: str = "doc_id",
    text_col: str = "text",
    settings: Settings | None = None,
) -> DataFrame:
    """``docs`` with every row as often as its rate says; the columns of ``docs``."""
    times = (
        rates(docs, labelled, targets, id_col, text_col, settings)
        .groupBy(id_col)
        .agg(F.max("copies").alias("_times"))
    )
    rows = docs.join(times, id_col, "left").withColumn("_times", F.coalesce("_times", F.lit(1)))
    repeated = rows.where(F.col("_times") > 0).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times")))
    )
    return repeated.select(*docs.columns)
