"""Prefix trie of conversations against brute force."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.llm import helpers as H
from webloom.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile("[^\\x20\\x09-\\x0D]+")


def paths_of(rows):
    """{conversation: turns in order}; rows with equal turn numbers are equal or have other roles."""
    out = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            out[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(v)] for c, v in out.items()}


def rebuilt(paths):
    out = {}
    for c, own in paths.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(c - 20 * int(c / 20)) if c < 0 else c - c % 20
        out[c] = paths.get(base, [])[:h] + own[h:]
    return out


def brute(paths):
    """Rows of the query for whole conversations."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node in sorted(members, key=len, reverse=True):
        leaves[node] += not kids[node]
        if node:
            saved[node] += (len(members[node]) - 1) * len(WORD.findall(node[-1][1]))
            leaves[node[:-1]] += leaves[node]
            saved[node[:-1]] += saved[node]
    out = []
    for node, m in members.items():
        ended = ",".join(map(str, sorted(ends[node]))).encode()
        out.append(
            (
                min(m), len(node), min(members[node[:-1]]) if node else None, len(m), kids[node],
                leaves[node], saved[node], hashlib.sha256(ended).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def got(nodes):
    columns = ["conv_id", "d", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in nodes.select(*columns).collect()), key=repr)


def random_rows(seed, convs, length):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rng.randrange(1, length)):
            text = H.prose(rng, rng.randrange(3), 2) if rng.random() < 0.8 else H.prose(rng, 4)
            rows.append((c * 3, t * 2, rng.choice(["user", "assistant"]) if t % 2 else "user", text))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("members, band, queue", [(8, 6, 2), (500, 10, 3)])
def test_rounds_and_spills(spark, members, band, queue):
    rows = random_rows(1, 70, 12) + [(1, t, "user", f"x{t // 40}") for t in range(90)]
    rows += [(4, t, "user", f"x{t // 40}") for t in range(60)]
    turns = P.turn_rows(spark.createDataFrame(rows, SCHEMA))
    convs = P.conversations(turns)
    lengths = convs.select("c", F.col("n").alias("length"))
    nodes = P.trie(P.paths_of(turns, convs), lengths, P.Settings(members, band, queue))
    assert got(nodes) == brute(paths_of(rows))


def odd_rows():
    rows = random_rows(2, 60, 6)
    rows += [(c, None, "user", "hot start") for c in range(40, 200, 3)]
    rows += [(60, 0, None, None), (60, None, "user", ""), (80, 1, "user", "a b"), (80, 1, "user", "a b")]
    rows += [(None, 1, "user", "nobody"), (-7, 2, "", " \t\n"), (-20, 1, "user", "é ü x"), (-27, 0, None, "x")]
    rows += [(2**63 - 1, -(2**63), "system", "y" * 50_000), (-(2**63), 2**63 - 1, "system", "y z " * 9_000)]
    return rows


def query(spark, folder):
    found = entry.queries()["op13_prefix_trie"](spark, folder).withColumnRenamed("depth", "d")
    assert all(f.dataType.simpleString() == "bigint" for f in found.schema if f.name != "ends_sha256")
    return got(found)


def test_odd_rows(spark, tmp_path):
    rows = odd_rows()
    turns = spark.createDataFrame(rows, SCHEMA).withColumn("d", F.lit("x")).withColumn("words", F.lit(3))
    folder = H.write_tables(spark, str(tmp_path), conversations=turns.repartition(4))
    assert query(spark, folder) == brute(rebuilt(paths_of(rows)))


def test_empty_and_turnless(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    assert query(spark, H.write_tables(spark, str(tmp_path / "a"), conversations=none)) == []
    lost = [(None, 1, "user", "x")]
    folder = H.write_tables(spark, str(tmp_path / "b"), conversations=spark.createDataFrame(lost, SCHEMA))
    assert query(spark, folder) == []
    # Without their base, conversations shorter than their head end at the root.
    rows = [(c, 0, "user", "x") for c in range(1, 20)]
    folder = H.write_tables(spark, str(tmp_path / "c"), conversations=spark.createDataFrame(rows, SCHEMA))
    want = brute(rebuilt(paths_of(rows)))
    assert query(spark, folder) == want and len(want) == 2


def test_many_ends_in_pieces(spark):
    rows = [(c, 0, "user", "same") for c in range(9_000)]
    turns = P.turn_rows(spark.createDataFrame(rows, SCHEMA))
    convs = P.conversations(turns)
    nodes = P.trie(P.paths_of(turns, convs), convs.select("c", F.col("n").alias("length")))
    assert got(nodes) == brute(paths_of(rows))


def test_queue_spills_and_keeps_order():
    rng = random.Random(3)
    queue, sums = P.MessageQueue(7), defaultdict(int)
    for _ in range(500):
        key = (rng.randrange(-5, 0), rng.randrange(3), rng.randrange(3))
        queue.push(key, 1, 2)
        sums[key] += 1
    assert len(queue.runs) > 50
    for key in sorted(sums):
        assert queue.take(key) == (sums[key], 2 * sums[key])
    assert not queue.heap and not queue.runs
