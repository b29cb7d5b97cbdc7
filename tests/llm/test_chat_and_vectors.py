"""Chat repair and nearest neighbours against brute force."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import helpers as H
from webloom.llm import chat_repair as C
from webloom.llm import neighbours as N
from webloom.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string"


def legal_path(state, to):
    for n in range(3):
        for path in itertools.product((1, 2, 3), repeat=n):
            if all(p in C.LEGAL for p in zip((state, *path), (*path, to))):
                return n
    return None


def least_cost(roles):
    best = None
    for finals in itertools.product((1, 2, 3), repeat=len(roles)):
        for merges in itertools.product((False, True), repeat=len(roles)):
            state, cost = 0, 0
            for role, to, merged in zip(roles, finals, merges):
                cost += 0 if role == to else C.NAME if role == 0 else C.RELABEL
                extra = legal_path(state, to)
                if merged and state != to or not merged and extra is None:
                    break
                cost += C.MERGE if merged else C.INSERT * extra
                state = to
            else:
                cost += C.end_cost(state)
                best = cost if best is None else min(best, cost)
    return best


def cost_of(roles, states):
    state, cost = 0, 0
    for role, to in zip(roles, states):
        cost += C.move(role, state, to)[0]
        state = to
    return cost + C.end_cost(state)


def test_walk_is_the_cheapest_and_parts_agree():
    rng = random.Random(1)
    for _ in range(250):
        roles = [rng.randrange(4) for _ in range(rng.randrange(1, 5))]
        least = least_cost(roles)
        assert cost_of(roles, C.walk(roles, C.START, None)) == least
        cut = sorted(rng.randrange(len(roles) + 1) for _ in range(2))
        parts = [p for p in (roles[: cut[0]], roles[cut[0] : cut[1]], roles[cut[1] :]) if p]
        states = []
        for part, (enter, leave) in zip(parts, C.border_states([C.stretch(p) for p in parts])):
            states += C.walk(part, enter, leave)
        assert cost_of(roles, states) == least


def check_conversation(rows):
    """A conversation's rows in order: legal, complete, cheapest."""
    turns = []
    for r in rows:
        state = C.ROLES.index(r.final_role) + 1
        if r.merged:
            assert turns and turns[-1] == state
        else:
            before = turns[-1] if turns else C.START
            path = C.inserted(before, state)
            assert len(path) == r.inserted_before
            turns += [*path, state]
    tail = C.closing(turns[-1])
    assert [r.inserted_after for r in rows] == [0] * (len(rows) - 1) + [len(tail)]
    turns += tail
    assert all(p in C.LEGAL for p in zip([0, *turns], turns)) and turns[-1] == C.ASSISTANT
    text = "".join(r.rendered for r in rows)
    assert text.count("<|end|>") == len(turns)
    assert [w for w in text.split("<|") if not w.startswith("end|>")][1:] and text.endswith("<|end|>\n")
    roles = [C.role_code(r.role) for r in rows]
    assert sum(r.cost for r in rows) == cost_of(roles, C.walk(roles, C.START, None))
    return text


def by_conversation(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: r.position):
        found.setdefault(r.conv_id, []).append(r)
    return found


@pytest.mark.parametrize("partitions", [1, 23])
def test_conversations(spark, partitions):
    rng = random.Random(partitions)
    names = ["user", "assistant", "system", "Human", " bot ", None, "tool", ""]
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 8)):
            rows.append((conv, turn, rng.choice(names), rng.choice(["hi", "", None, "a <|end|> b"])))
    rows += [(100, t, rng.choice(names), "long") for t in range(3_000)]  # spans many parts
    rows += [(None, t, "user", "x") for t in range(3)] + [(5, 0, "user", "again")] * 2
    rows += [(7, None, "user", "no turn")]
    turns = spark.createDataFrame(rows, SCHEMA).withColumn("position", F.lit(1))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = by_conversation(C.repair(turns))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(map(len, found.values())) == len(rows)
    for conv, given in found.items():
        check_conversation(given)
        order = [(r.turn is not None, r.turn) for r in given]
        assert order == sorted(order)


def test_rendering(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "human", "c"), (2, 0, "assistant", "x"), (3, 0, "system", None)]
    found = by_conversation(C.repair(spark.createDataFrame(rows, SCHEMA)))
    texts = {k: check_conversation(v) for k, v in found.items()}
    assert texts[1] == "<|user|>\na\nb\nc<|end|>\n<|assistant|>\n<|end|>\n"
    assert texts[2] == "<|user|>\n<|end|>\n<|assistant|>\nx<|end|>\n"
    assert texts[3] == "<|system|>\n<|end|>\n<|user|>\n<|end|>\n<|assistant|>\n<|end|>\n"
    assert C.repair(spark.createDataFrame([], SCHEMA)).collect() == []


def test_chat_query(spark):
    folder = "/root/testdata/sf0.001"
    found = by_conversation(queries.op9_chat_repair(spark, folder))
    given = queries.table(spark, folder, "conversations")
    assert sum(map(len, found.values())) == given.count()
    for rows in found.values():
        check_conversation(rows)


# Nearest neighbours


def test_pseudo_rotations_keep_lengths_and_cover_axes():
    x = np.random.default_rng(2).normal(size=(500, 48))
    s = N.Settings(tables=3, width=1)
    for turned in N.rotations(x, s):
        assert np.allclose(np.linalg.norm(turned, axis=1), 1) and turned.shape == (500, 64)
    filed = N.codes(x, s)
    assert filed.shape == (500, 3) and all(len(np.unique(c)) > 90 for c in filed.T)
    assert (N.probe_codes(x, s, 4)[:, :, 0] == filed).all()
    wide = N.Settings(tables=2, width=2)
    assert (N.probe_codes(x, wide, 5)[:, :, 0] == N.codes(x, wide)).all()
    assert (N.codes(x * 1e150, s) == filed).all()


def brute(ids, vectors, query, k=10):
    at = ids.index(query)
    with np.errstate(over="ignore"):
        far = np.sqrt(((vectors - vectors[at]) ** 2).sum(1))
    order = sorted((far[j], ids[j]) for j in range(len(ids)) if ids[j] != query)
    return order[:k]


def test_recall(spark):
    table = queries.table(spark, "/root/testdata/sf0.01", "embeddings")
    rows = table.select("vec_id", "embedding").orderBy("vec_id").collect()
    ids, vectors = [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)
    got = {}
    for r in N.neighbours(table, F.col("id") % 10 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.score, r.id))
    hits = 0
    for query in ids[::10]:
        found = sorted(got[query])
        assert [f[0] for f in found] == list(range(1, 11))
        assert [f[1:] for f in found] == sorted(f[1:] for f in found)
        want = brute(ids, vectors, query)
        exact = dict((i, d) for d, i in brute(ids, vectors, query, len(ids)))
        assert all(f[1] == pytest.approx(exact[f[2]], abs=1e-12) for f in found)
        hits += len({i for _, i in want} & {f[2] for f in found})
    assert hits >= 0.9 * 10 * len(got)


def test_odd_vectors(spark):
    rng = np.random.default_rng(4)
    same = rng.normal(size=8).tolist()
    rows = [(k, same) for k in range(0, 300)]  # one class of many
    rows += [(1000 + k, rng.normal(size=8).tolist()) for k in range(6)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 8), (2003, [1.0, None] + [0.0] * 6)]
    rows += [(2004, [float("nan")] * 8), (2005, [float("inf")] + [1.0] * 7), (None, same)]
    rows += [(2100 + k, [1.0, float(k)]) for k in range(3)] + [(1000, rows[300][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit(1))
    found = {}
    for r in N.neighbours(table, F.col("id") % 100 == 0).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.id, r.score))
    # Ties among equal vectors go to the smaller id; the query itself is left out.
    assert [x[1] for x in sorted(found[0])] == list(range(1, 11))
    assert [x[1] for x in sorted(found[100])] == list(range(10))
    assert {x[2] for x in found[0]} == {0.0}
    assert sorted(x[1] for x in found[2100]) == [2101, 2102]
    assert set(found) == {0, 100, 200, 1000, 2100} and len(found[1000]) == 10
    assert N.neighbours(table.limit(0), F.col("id") % 100 == 0).collect() == []
    few = table.where("vec_id between 1000 and 1005")
    ids = [r[0] for r in rows[300:306]]
    want = brute(ids, np.array([r[1] for r in rows[300:306]]), 1000)
    got = sorted((r.rank, r.score, r.id) for r in N.neighbours(few, F.col("id") == 1000).collect())
    assert [g[2] for g in got] == [i for _, i in want]


def test_large_buckets_are_dealt_out(spark):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=16)
    rows = [(k, (centre + 0.01 * rng.normal(size=16)).tolist()) for k in range(400)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    s = N.Settings(part_rows=20)
    got = {}
    for r in N.neighbours(table, F.col("id") % 50 == 0, settings=s).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.id))
    vectors = np.array([r[1] for r in rows])
    hits = 0
    for query in got:
        want = {i for _, i in brute(list(range(400)), vectors, query)}
        hits += len(want & {i for _, i in got[query]})
    assert len(got) == 8 and hits >= 0.9 * 80


def shaped(rng, n, dims, kind):
    """Groups of some twenty vectors around centres, or vectors without any structure."""
    if kind == "plain":
        return rng.normal(size=(n, dims))
    centres = rng.normal(size=(n // 20, dims))
    out = centres[rng.integers(0, len(centres), n)] + 0.6 * rng.normal(size=(n, dims))
    return out * rng.lognormal(0, 0.5, (n, 1)) if kind == "lengths" else out


@pytest.mark.parametrize(
    "dims, kind", [(16, "groups"), (64, "groups"), (64, "lengths"), (256, "groups"), (256, "plain")]
)
def test_recall_at_any_dimension(spark, dims, kind):
    """The default settings find nine tenths, whatever the dimension and the lengths."""
    vectors = shaped(np.random.default_rng(dims), 4_000, dims, kind)
    table = spark.createDataFrame(
        list(enumerate(vectors.tolist())),
        "vec_id long, embedding array<double>",
    )
    got = {}
    for r in N.neighbours(table, F.col("id") % 100 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.id)
    hits = 0
    for q in range(0, len(vectors), 100):
        distance = np.sqrt(((vectors - vectors[q]) ** 2).sum(1))
        distance[q] = np.inf
        hits += len(got[q] & set(np.argsort(distance, kind="stable")[:10].tolist()))
    assert hits / (10 * len(got)) >= 0.9


def test_share_met_falls_with_the_table():
    """With structure in the vectors a query meets few of a larger table."""
    rng = np.random.default_rng(5)
    s = N.Settings()
    vectors = shaped(rng, 40_000, 64, "groups")
    asking, sample = vectors[:32], vectors[:2_000]
    near = []
    for v in asking:
        distance = ((vectors - v) ** 2).sum(1)
        near.append(vectors[np.argsort(distance)[1:11]])
    assert N.choose(asking, near, sample, 10_000, s).width == 1
    plan = N.choose(asking, near, sample, 1_000_000, s)
    assert plan.width == 2
    own = plan.of(s)
    filed, looked = N.codes(vectors, own), N.probe_codes(asking, own, plan.probes)
    met = [np.any([np.isin(filed[:, t], q[t]) for t in range(s.tables)], axis=0).mean() for q in looked]
    assert np.mean(met) < 0.1
