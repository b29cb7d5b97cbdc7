"""Merkle manifest and ranks against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.llm import helpers as H
from webloom.llm import merkle as M
from webloom.llm.ordering import numbered, ranked


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def way(tree, i):
    """(sibling or None, is it on the left) for each level."""
    out = []
    for level in tree[:-1]:
        j = i ^ 1
        out.append((level[j] if j < len(level) else None, j < i))
        i >>= 1
    return out


def brute(rows):
    """Rows (doc_id, text, lang, source, n_chars) to sorted results of the query."""
    groups = defaultdict(list)
    for r in rows:
        i, text, lang, source, n = r
        claimed = n
        if i is not None and n is not None and zlib.crc32(str(i).encode()) % 7 == 0:
            claimed = n + 1
        pair = leaf(i, source, lang, n, text), leaf(i, source, lang, claimed, text)
        groups["" if lang is None else "=" + lang].append((i is not None, i or 0, *pair, i))
    names = sorted(groups, key=str.encode)
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: x[:3])
        trees[g] = levels([x[2] for x in groups[g]])
    top = levels([trees[g][-1][0] for g in names])
    out = []
    for at, g in enumerate(names):
        for k, (_, _, own, claim, i) in enumerate(groups[g]):
            path = way(trees[g], k) + way(top, at)
            node = claim
            for other, on_left in path:
                node = sha((other or "") + node if on_left else node + (other or ""))
            root = top[-1][0]
            proof = sha("".join(o for o, _ in path if o))
            out.append((i, own, trees[g][-1][0], root, proof, node, node == root))
    return sorted(out, key=repr)


def got(spark, folder):
    rows = entry.queries()["op11_merkle"](spark, folder).collect()
    return sorted((tuple(r) for r in rows), key=repr)


def test_odd_rows(spark, tmp_path):
    rows = H.odd_documents()
    rows += [(2**63 - 1, "x", "en", None, 2**63 - 1), (-(2**63), "y", "en", "s", None), (-1, None, "", "s", 0)]
    rows += [(7, "a", None, "s", 1), (7, "b", None, "s", 1), (7, "a", None, "s", 1), (0, "\0", "zz", "é", -5)]
    docs = spark.createDataFrame(rows, H.DOC_SCHEMA)
    docs = docs.withColumn("hash", F.lit("h")).withColumn("rank", F.lit(1)).withColumn("tree", F.lit("t"))
    folder = H.write_tables(spark, str(tmp_path), documents=docs)
    assert got(spark, folder) == brute(rows)


def test_several_rounds_and_hot_ids(spark, tmp_path):
    rng = random.Random(5)
    rows = [(rng.randrange(2**40), f"t{k}", "en", "s", k) for k in range(2_600)]
    rows += [(None, f"n{k % 3}", "en", "s", k % 2) for k in range(300)]
    rows += [(5, "same", "de", "s", 4)] * 200 + [(k, "x", f"l{k}", "s", 1) for k in range(9)]
    folder = H.write_tables(
        spark, str(tmp_path), documents=spark.createDataFrame(rows, H.DOC_SCHEMA).repartition(5)
    )
    assert got(spark, folder) == brute(rows)


def test_empty_and_single(spark, tmp_path):
    none = spark.createDataFrame([], H.DOC_SCHEMA)
    assert got(spark, H.write_tables(spark, str(tmp_path / "a"), documents=none)) == []
    assert M.build(none).root is None
    one = [(4, "only", None, None, None)]
    folder = H.write_tables(spark, str(tmp_path / "b"), documents=spark.createDataFrame(one, H.DOC_SCHEMA))
    assert got(spark, folder) == brute(one)


def test_groups_of_the_manifest(spark):
    rows = [(k, f"t{k}", "en" if k % 2 else None, "s", k) for k in range(11)]
    m = M.build(spark.createDataFrame(rows, H.DOC_SCHEMA))
    sizes = {r["group"]: r["n_leaves"] for r in m.groups.collect()}
    assert sizes == {None: 6, "en": 5}
    assert m.root == brute(rows)[0][3]


def test_a_changed_text_changes_its_proof(spark):
    rows = [(k, f"t{k}", "en", "s", k) for k in range(40)]
    m = M.build(spark.createDataFrame(rows, H.DOC_SCHEMA))
    rows[17] = (17, "other", "en", "s", 17)
    n = M.build(spark.createDataFrame(rows, H.DOC_SCHEMA))
    assert m.root != n.root
    other = n.leaves.select("id", F.col("hash").alias("now"))
    folded = M.proofs(m).join(other, "id").select(
        "id", (M.fold(F.col("now"), F.col("siblings"), F.col("left")) == F.col("root")).alias("ok")
    )
    assert [r["id"] for r in folded.where("not ok").collect()] == [17]


def test_ranked_and_numbered(spark):
    rng = random.Random(9)
    rows = []
    for u in range(3_000):
        kind = rng.randrange(4)
        key = [None, rng.randrange(50), rng.randrange(-(2**63), 2**63), rng.randrange(10**6)][kind]
        rows.append((rng.choice([None, "a", "b"]), key, rng.randrange(4), u))
    df = spark.createDataFrame(rows, "g string, k long, t long, u long")
    want, places = {}, {}
    for g in (None, "a", "b"):
        members = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        want.update({r[3]: (n, len(members)) for n, r in enumerate(members)})
    found = {r["u"]: (r["rank"], r["size"]) for r in ranked(df, ["g"], ["k", "t", "u"]).collect()}
    assert found == want
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[3]))
    places = {r[3]: n for n, r in enumerate(order)}
    assert {r["u"]: r["place"] for r in numbered(df, ["g", "u"]).collect()} == places
