"""Near-duplicate documents: Jaccard join of word 5-shingles by token combinations.

The tokens of a document are its distinct shingles, as 64-bit hashes. Two documents
link when their Jaccard similarity is at least ``percent`` / 100.

1. *Frequencies.* Every token's document frequency is counted (``block_exchange``)
   and comes back to the documents as a class, the number of bits of the count.
   Tokens of one document only are left out from here on. Documents with fewer
   shared tokens than a link needs are done.
2. *Classes of equal sets.* One representative of each set goes on, under a number of
   its own: a document is an id with a set, and neither is a key alone.
3. *Signatures.* The tokens of a document are put into one order, by class, then
   hash. A document of n tokens may miss e = n - ceil(0.8 n) of them in a partner.
   The prefix is extended until no partner could share too little of it: a rare
   token (class up to ``RARE``) counts 1; frequent tokens are dealt into groups
   by hash, and k of a group count 1 beyond the first k - 1, where k is 2, for
   very frequent ones 3. As soon as more than e is counted, a partner has a rare
   token of the prefix or k tokens of one of its groups. So rare tokens are indexed
   singly, frequent ones by all k-combinations inside their groups. The number
   of groups follows the document's size, in steps of 1.25; a document is indexed
   for its own step and the next, so two linked ones always meet in one step.
4. *Pairs.* Of the signatures with the same documents one is kept. Its pivot, the
   document whose tokens are the most common ones, as those of the original of many
   copies are, is compared with the others of the signature, not all with all.
   Verified links make components; signatures whose documents are all in one
   component are done. Of the rest, those with few documents (``SMALL_KEY``) compare
   all that are not yet connected, the others go on with their next pivot. What
   counts as few grows every round. After the first one, all signatures with the
   same pivot are one, so that a pair is asked for once, not once per signature. Each
   pair that shares a signature is compared or already connected, or ruled out by
   the bounds below: nothing is capped.
   What a set has in common with anybody at all, and with the first pivot, bounds what
   two sets can have in common; pairs that cannot link by that are not compared.
5. *Verification* intersects the whole sets of shared tokens.

Defined results: null and empty texts, and texts of white space, have no tokens
and link with nothing; fewer words than ``SHINGLE`` make one token; rows that repeat
an id are one document if their sets are equal, otherwise each is compared with all
others and has its own answer; rows without an id are compared too, and have the
smallest id of their component, null if it has none. Only the id and text columns are
read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.llm import block_exchange as X
from webloom.llm import words as W
from webloom.llm.components import components
from webloom.session import stage_table

SHINGLE = 5
PERCENT = 80
# Classes (bits of the document frequency): singles up to RARE, pairs up to
# FREQUENT, triples above. Sets below SMALL tokens use singles only.
RARE, FREQUENT, SMALL = 4, 11, 40
PAIR_GROUPS, TRIPLE_GROUPS = 0.10, 0.08
# From the second round on, keys of at most so many documents, eight times as many in
# every further round, are done by comparing all that are not yet connected.
SMALL_KEY = 32
# Bytes of a fingerprint sent for counting, behind the bucket's bits. Tokens that
# share them are counted together, which changes the order but not the result.
WIDTH = 4

_TERMS = [np.uint64(c | 1) for c in W.powers(0xD1342543DE82EF95, 9)[1:]]
_COUNT = np.uint64(0xA0761D6478BD642F)
_SECOND = np.uint64(0x589965CC75374CC3)


def shingles(texts: W.Texts, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out: list[np.ndarray] = []
    for _, part in W.blocks(texts):
        words = W.words_of(part, lower=True)
        h, n = words.hashes, len(words.hashes)
        grams = np.zeros(max(0, n - size + 1), np.uint64)
        for k in range(size):
            grams += h[k : k + len(grams)] * _TERMS[k]
        grams = W.mix(grams + np.uint64(size) * _COUNT)
        for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
            if b - a >= size:
                out.append(np.unique(grams[a : b - size + 1]))
            elif b > a:
                whole = sum((h[a + k] * _TERMS[k] for k in range(b - a)), np.uint64(0))
                out.append(W.mix(np.array([whole + np.uint64(b - a) * _COUNT])))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def allowed_misses(n: int, percent: int = PERCENT) -> int:
    """How many of n tokens a linked partner may lack."""
    return n - -(-percent * n // 100)


def _send_block(plan: X.Plan):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        with np.errstate(over="ignore"):
            sets = shingles(W.texts_of(table["text"]))
        tokens, counts = np.unique(np.concatenate(sets), return_counts=True)
        return X.send(key[0].as_py(), tokens, counts.astype("<u4"), plan, WIDTH)

    return run


def _frequency_class(group: np.ndarray, n: int, facts: np.ndarray) -> np.ndarray:
    """Bits of the summed count, 1 for a token of one document."""
    total = np.bincount(group, facts, n)
    return np.frexp(total)[1][group]


SETS = (
    "id long, text_hash long, n_tokens long, sum_a long, sum_b long, n_shared long, "
    "tokens binary, classes binary"
)


def _sets_block(plan: X.Plan, percent: int):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, answers: pa.Table) -> pa.Table:
        with np.errstate(over="ignore"):
            sets = shingles(W.texts_of(docs["text"])) if docs.num_rows else []
            every = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]))
            classes = X.received(answers, every, plan)
            rows: list[list] = [[], [], [], [], [], []]
            for tokens in sets:
                found = classes[np.searchsorted(every, tokens)]
                shared = found > 1
                n, count = len(tokens), int(shared.sum())
                near = count >= n - allowed_misses(n, percent) and n > 0
                values = (
                    n,
                    int(W.mix(tokens).sum().astype(np.int64)),
                    int(W.mix(tokens ^ _SECOND).sum().astype(np.int64)),
                    count,
                    tokens[shared].tobytes() if near else None,
                    found[shared].tobytes() if near else None,
                )
                for column, value in zip(rows, values):
                    column.append(value)
        kinds = [pa.int64()] * 4 + [pa.binary()] * 2
        names = ["n_tokens", "sum_a", "sum_b", "n_shared", "tokens", "classes"]
        arrays = [pa.array(c, k) for c, k in zip(rows, kinds)]
        return pa.Table.from_arrays(
            [docs["id"], docs["text_hash"], *arrays], names=["id", "text_hash", *names]
        )

    return run


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def token_sets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT
) -> DataFrame:
    """One row per document; the tokens it shares only where it may have a partner."""
    plan = X.plan_for(docs, text_col)
    blocks = X.in_blocks(docs, plan, id_col, text_col).withColumn("text_hash", text_hash(F.col("text")))
    sent = blocks.groupBy("block").applyInArrow(_send_block(plan), X.SENT)
    answers = X.answer(sent, plan, WIDTH, "<u4", _frequency_class)
    return stage_table(
        blocks.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(_sets_block(plan, percent), SETS),
        "token-sets",
    )


_STEPS = 1.25 ** np.arange(200)


def signatures(n: int, tokens: np.ndarray, classes: np.ndarray, percent: int) -> np.ndarray:
    """Keys under which a set is indexed; two linked sets have one in common."""
    need = allowed_misses(n, percent) - (n - len(tokens)) + 1
    order = np.lexsort((tokens, classes))
    tokens, classes = tokens[order], classes[order]
    step = int(np.searchsorted(_STEPS, n, "right")) - 1
    keys: list[np.ndarray] = []
    for level in (step, step + 1):
        size = _STEPS[level]
        if size < SMALL:
            keys.append(tokens[:need])
            continue
        singles = int(np.searchsorted(classes, RARE, "right"))
        keys.append(tokens[: min(singles, need)])
        left, at = need - singles, singles
        for k, last, share in ((2, FREQUENT, PAIR_GROUPS), (3, 255, TRIPLE_GROUPS)):
            if left <= 0:
                break
            end = int(np.searchsorted(classes, last, "right"))
            here = tokens[at:end]
            groups = W.mix(here ^ _SECOND) % np.uint64(max(1, round(share * size)))
            by_group = np.argsort(groups, kind="stable")
            marks = np.flatnonzero(np.diff(groups[by_group])) + 1
            parts = np.split(by_group, marks) if len(here) else []
            counted = np.zeros(len(here), np.int64)
            for part in parts:
                counted[part[k - 1 :]] = 1
            reached = np.cumsum(counted)
            stop = int(np.searchsorted(reached, left)) + 1  # all, if never reached
            left -= int(reached[-1]) if len(reached) else 0
            tag = np.uint64(level * 8 + k) * _COUNT
            for part in parts:
                part = part[part < stop]
                if len(part) >= k:
                    picks = np.array(list(combinations(here[part].tolist(), k)), np.uint64)
                    total = np.full(len(picks), tag)
                    for j in range(k):
                        total += picks[:, j] * _TERMS[j]
                    keys.append(W.mix(total))
            at = end
    return np.unique(np.concatenate(keys))


def _signature_rows(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, tokens, classes = (batch.column(k).to_pylist() for k in range(4))
            with np.errstate(over="ignore"):
                for doc, n, t, c in zip(ids, sizes, tokens, classes):
                    found = np.frombuffer(c, np.uint8)
                    keys = signatures(n, np.frombuffer(t, np.uint64), found, percent)
                    common = int(1000 * found.sum(dtype=np.int64) // n)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "key": keys.view(np.int64),
                            "id": np.full(len(keys), doc, np.int64),
                            "n": np.full(len(keys), n, np.int64),
                            "s": np.full(len(keys), len(found), np.int64),
                            "common": np.full(len(keys), common, np.int64),
                        }
                    )

    return run


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, t_a, t_b = (batch.column(k) for k in range(4))
        common = []
        for row in range(batch.num_rows):
            x = np.frombuffer(t_a[row].as_buffer(), np.uint64)
            y = np.frombuffer(t_b[row].as_buffer(), np.uint64)
            both = np.sort(np.concatenate([x, y]), kind="stable")
            common.append(int((both[1:] == both[:-1]).sum()))
        yield pa.RecordBatch.from_arrays(
            [a, b, pa.array(common, pa.int64())], names=["a", "b", "common"]
        )


def compare(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, common): how many tokens the sets of each pair have in common."""
    both = pairs
    for x in "ab":
        side = sets.select(F.col("id").alias(x), F.col("tokens").alias(f"t_{x}"))
        both = both.join(side, x)
    return both.select("a", "b", "t_a", "t_b").mapInArrow(
        _compared, "a long, b long, common long"
    )


# What is known of a set under a key: its tokens, those that other sets have at all,
# and those that the key's first pivot has.
_KNOWN = ("n", "s", "c")


def may_link(a: Sequence[Column], b: Sequence[Column], percent: int) -> Column:
    """Whether two sets, of which ``_KNOWN`` is known, can have enough in common.

    Common tokens are shared ones. Of a pivot's tokens they have no more in common than
    the one with fewer of them, and likewise outside the pivot.
    """
    (n_a, s_a, c_a), (n_b, s_b, c_b) = a, b
    by_pivot = F.least(c_a, c_b) + F.least(s_a - c_a, s_b - c_b)
    known = c_a.isNotNull() & c_b.isNotNull()
    most = F.least(s_a, s_b, F.when(known, by_pivot))
    return (100 + percent) * most >= percent * (n_a + n_b)


def link_components(sets: DataFrame, percent: int = PERCENT) -> DataFrame | None:
    """(id, component) of linked representatives; None if no two share a signature.

    ``sets``: id, n_tokens, tokens, classes.
    """
    every = stage_table(
        sets.select("id", "n_tokens", "tokens", "classes").mapInArrow(
            _signature_rows(percent), "key long, id long, n long, s long, common long"
        ),
        "signatures",
    )
    # Keys with the same documents ask for the same pairs; one of them goes on.
    members = every.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("id")).alias("x"),
        F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"),
    )
    chosen = members.where("n > 1").groupBy("n", "x", "y").agg(F.min("key").alias("key"))
    entries = every.join(chosen.select("key"), "key", "left_semi").withColumns(
        {"component": F.col("id"), "c": F.lit(None).cast("long")}
    )
    known = lambda prefix="", suffix="": [
        F.col(f"{prefix}{k}{suffix}") for k in _KNOWN
    ]
    links = labels = None
    turn, small = 0, 1
    while True:
        keys = entries.groupBy("key").agg(
            *[F.max_by(k, "common").alias(f"{k}_p") for k in ("id", "component", *_KNOWN)],
            F.count(F.lit(1)).alias("size"),
            F.min("component").alias("c_low"),
            F.max("component").alias("c_high"),
        ).where("c_low < c_high")
        opened = stage_table(entries.join(keys.drop("c_low", "c_high"), "key"), f"open-{turn}")
        if opened.limit(1).count() == 0:
            return labels
        large = opened.where(F.col("size") > small)
        pair = [F.least("id", "id_p").alias("a"), F.greatest("id", "id_p").alias("b")]
        pairs = large.where(
            F.expr("id != id_p AND component != component_p")
            & may_link(known(), known(suffix="_p"), percent)
        ).select(*pair)
        if turn:
            x, y = (opened.where(F.col("size") <= small).alias(side) for side in "xy")
            met = x.join(
                y,
                (F.col("x.key") == F.col("y.key"))
                & (F.col("x.id") < F.col("y.id"))
                & (F.col("x.component") != F.col("y.component"))
                & may_link(known("x."), known("y."), percent),
            ).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
            pairs = pairs.unionByName(met)
        compared = stage_table(compare(pairs.distinct(), sets), f"compared-{turn}")
        size = lambda x: sets.select(F.col("id").alias(x), F.col("n_tokens").alias(f"n_{x}"))
        found = (
            compared.join(size("a"), "a")
            .join(size("b"), "b")
            .where((100 + percent) * F.col("common") >= percent * (F.col("n_a") + F.col("n_b")))
            .select("a", "b")
        )
        found = stage_table(found, f"links-{turn}")
        if not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            labels = components(links)
        # Small keys are done, and the pivot has met everyone under its key.
        rest = large.where("id != id_p").select("key", "id", "id_p", *_KNOWN, "common")
        if turn == 0:
            with_pivot = compared.withColumnRenamed("common", "c")
            rest = rest.drop("c").select("*", *pair).join(with_pivot, ["a", "b"], "left")
            # Documents that met the same pivot are one group from here on, however many
            # keys they share.
            rest = rest.select(F.col("id_p").alias("key"), "id", *_KNOWN, "common").distinct()
        entries = rest.select("key", "id", *_KNOWN, "common").withColumn("component", F.col("id"))
        if labels is not None:
            entries = (
                entries.drop("component")
                .join(labels, "id", "left")
                .withColumn("component", F.coalesce("component", "id"))
            )
        turn, small = turn + 1, max(SMALL_KEY, 8 * small)


def _answered(docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """(id, text_hash, n_tokens, component_id, stays) for every row.

    ``stays``: whether a row is its component's document with the smallest id; of several
    sets under that id the one with the most tokens. Without any id: the smallest hash.
    """
    rows = token_sets(docs, id_col, text_col, percent)
    same = ["n_tokens", "sum_a", "sum_b"]
    classes = stage_table(
        rows.where("n_tokens > 0")
        .groupBy(*same)
        .agg(F.min("id").alias("low"), F.min("text_hash").alias("low_hash"))
        .withColumn("rep", F.monotonically_increasing_id()),
        "equal-sets",
    )
    reps = stage_table(
        rows.where("tokens IS NOT NULL")
        .join(classes, same)
        .where("id <=> low")
        .dropDuplicates(["rep"])
        .select(F.col("rep").alias("id"), "n_tokens", "tokens", "classes"),
        "representatives",
    )
    labels = link_components(reps, percent)
    answers = classes.withColumns({"component_id": F.col("low"), "first": F.col("rep")})
    if labels is not None:
        linked = classes.join(labels.withColumnRenamed("id", "rep"), "rep")
        order = F.struct(
            F.col("low").isNull(), "low", -F.col("n_tokens"), "sum_a", "sum_b", "rep"
        )
        firsts = linked.groupBy("component").agg(
            F.min("low").alias("component_id"), F.min(order)["rep"].alias("first")
        )
        found = labels.join(firsts, "component").select(
            F.col("id").alias("rep"), "component_id", "first"
        )
        answers = classes.join(found, "rep", "left").withColumns(
            {
                "component_id": F.when(F.col("first").isNull(), F.col("low")).otherwise(
                    F.col("component_id")
                ),
                "first": F.coalesce("first", "rep"),
            }
        )
    answers = answers.select(*same, "component_id", "low", "low_hash", "rep", "first")
    by_row = (F.col("rep") == F.col("first")) & F.col("id").eqNullSafe(F.col("low"))
    by_row &= F.col("low").isNotNull() | (F.col("text_hash") == F.col("low_hash"))
    return rows.join(answers, same, "left").select(
        "id",
        "text_hash",
        "n_tokens",
        F.coalesce("component_id", "id").alias("component_id"),
        (F.col("rep").isNull() | by_row).alias("stays"),
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT
) -> DataFrame:
    """(id, n_shingles, component_id): the smallest id reachable over links."""
    return _answered(docs, id_col, text_col, percent).select(
        "id", F.col("n_tokens").alias("n_shingles"), "component_id"
    )


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT
) -> DataFrame:
    """``docs`` without those that are linked, over others too, to a smaller id.

    Of texts under one id, and of texts without any, one of each component stays.
    """
    answers = _answered(docs, id_col, text_col, percent)
    dropped = answers.where("NOT stays").select("id", "text_hash").distinct()
    dropped = dropped.toDF("_gone_id", "_gone_hash")
    same = docs[id_col].cast("long").eqNullSafe(dropped["_gone_id"]) & (
        text_hash(docs[text_col]) == dropped["_gone_hash"]
    )
    return docs.join(dropped, same, "left_anti").select(*docs.columns)
