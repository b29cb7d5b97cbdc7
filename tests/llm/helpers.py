"""Brute-force versions of operators, and odd rows that every operator has to bear."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def odd_documents() -> list[tuple]:
    """Null, empty, blank, very long, tied and repeated rows."""
    rng = random.Random(3)
    base = prose(rng, 300)
    long = prose(rng, 30_000)
    words = base.split()
    near = " ".join(words[:150] + ["changed"] + words[151:])
    texts = [
        (1, base), (2, base), (3, base.upper()), (4, near), (5, None), (6, ""), (7, " \t\n "),
        (8, long), (9, long + " tail"), (10, "one"), (11, "One"), (12, "a b c d"), (13, "A b c d"),
        (14, "a b c d e"), (15, "x " * 2000), (16, "x " * 1990), (17, "Été ÉTÉ ß x"),
        (18, prose(rng, 60) + " " + " ".join(words[100:180]) + " " + prose(rng, 60)),
        (19, prose(rng, 500)), (20, "Released under the MIT License.\nother"),
        (21, "a" * 5_000), (22, "<|endoftext|> x<|startoftext|>y"), (None, "no id"),
        (None, base), (19, prose(random.Random(4), 40)),
    ]
    rows = [(i, t, "en" if (i or 0) % 3 else None, "s", None if t is None else len(t)) for i, t in texts]
    return rows + [rows[0], rows[0], rows[4]]


def near_groups(seed: int, groups: int = 12, copies: int = 6) -> list[tuple[int, str]]:
    """Families of texts with some words changed, on top of a common passage."""
    rng = random.Random(seed)
    common = prose(rng, 80)
    out, doc = [], 0
    for _ in range(groups):
        base = prose(rng, rng.choice([4, 6, 12, 60, 200, 400]), 5_000).split()
        if rng.random() < 0.5:
            base = common.split() + base
        for _ in range(rng.randrange(1, copies)):
            words = list(base)
            for _ in range(rng.randrange(0, 1 + len(words) // 30)):
                words[rng.randrange(len(words))] = f"c{rng.randrange(10**6)}"
            out.append((doc, " ".join(words)))
            doc += 1
    rng.shuffle(out)
    return out


def brute_near(rows, percent: int = 80) -> dict:
    """{id: (set size, smallest id reachable)}; ids are distinct."""
    sets = {}
    for i, text in rows:
        w = WORD.findall((text or "").encode().translate(LOWER))
        grams = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        sets[i] = frozenset(grams if len(w) >= 5 else [tuple(w)] if w else [])
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    ids = sorted(sets)
    df = Counter(g for s in sets.values() for g in s)
    having = defaultdict(list)
    for i in ids:
        s = sets[i]
        order = sorted(s, key=lambda g: (df[g], g))
        near = set()
        for g in order[: len(s) + percent * -len(s) // 100 + 1]:
            near.update(having[g])
            having[g].append(i)
        for j in near:
            common = len(s & sets[j])
            if 100 * common >= percent * (len(s) + len(sets[j]) - common):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def brute_repeats(rows, window: int = 50) -> dict:
    """{id: (words, removed, sha256 of what is left)}; ids are distinct."""
    docs = {i: WORD.findall((t or "").encode()) for i, t in rows}
    first: dict = {}
    for i in sorted(docs):
        for k in range(len(docs[i]) - window + 1):
            first.setdefault(tuple(docs[i][k : k + window]), i)
    out = {}
    for i, w in docs.items():
        gone = bytearray(len(w))
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = b"\1" * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def write_tables(spark, folder: str, **tables) -> str:
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return folder
