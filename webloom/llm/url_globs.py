"""URL filters: all wildcard rules at once in a multiword Shift-And automaton.

Every rule becomes a glob over the canonical URL, which is host + path: host with
A-Z lower-cased, path up to ``?`` or ``#``. In a glob

    ``*``   any bytes            ``+``   any bytes other than ``/`` (stays in the host)
    ``?``   any one byte         any other byte stands for itself

Each byte or ``?`` of a glob is one state, that is one bit; the bits of all globs
are packed into 64-bit words. A wildcard is a self-loop on the state before it.
One step of all globs for one byte c is

    next = ((state << 1) & follow & byte[c]) | (state & loop[c])

with the carry between words. The arrays have a row per URL, so a step advances
all URLs of a batch that are long enough. Cost: URL bytes x words of the rules.

Defined results: a null URL, or one without ``://``, has an empty host and path and
is matched as the empty string (only globs of wildcards fit); of several rules that
fit, the one with the most bytes wins, then the one listed first. Rows and extra
columns stay; result columns replace columns of the same name. Empty tables and
repeated rows need no rule. No shuffle takes place.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.llm.words import texts_of

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Rule:
    """``globs``: any of them fits. ``name`` is what the result shows."""

    name: str | None
    action: str
    globs: tuple[str, ...]
    weight: int


def site_rule(action: str, rule: str) -> Rule:
    """A host with its subdomains, and a path prefix, as in ``example.net/en/``."""
    return Rule(rule, action, (f"{rule}*", f"+.{rule}*"), len(rule.encode()))


def glob_rule(action: str, glob: str) -> Rule:
    """A plain wildcard rule; weighs less than any site rule and shows no name."""
    return Rule(None, action, (glob,), -1)


def after_scheme(url: Column) -> Column:
    """All behind the first ``://``, cut at ``?`` and ``#``; empty without one."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    return F.substring_index(F.substring_index(rest, "#", 1), "?", 1)


def host(url: Column) -> Column:
    return F.translate(F.substring_index(after_scheme(url), "/", 1), UPPER, UPPER.lower())


def path(url: Column) -> Column:
    rest = after_scheme(url)
    at = F.instr(rest, "/")
    return F.when(at > 0, F.substr(rest, at)).otherwise(F.lit(""))


class Automaton:
    """Masks of all globs; tables of 256 x words."""

    def __init__(self, globs: Sequence[str]):
        symbols: list[tuple[int | None, int]] = []  # byte or any, glob
        loops: dict[int, str] = {}
        heads, ends = [], []
        for number, glob in enumerate(globs):
            heads.append(len(symbols))
            symbols.append((-1, number))  # the state before the first byte
            for b in glob.encode():
                if b in b"*+":
                    here = len(symbols) - 1
                    loops[here] = "*" if b == 42 or loops.get(here) == "*" else "+"
                else:
                    symbols.append((None if b == 63 else b, number))
            ends.append(len(symbols) - 1)
        self.words = max(1, -(-len(symbols) // 64))
        self.accepts = np.array(ends, dtype=np.int64)
        self.byte = np.zeros((256, self.words), np.uint64)
        self.loop = np.zeros((256, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        for state, (symbol, _) in enumerate(symbols):
            word, bit = state // 64, np.uint64(1 << state % 64)
            if symbol is None:
                self.byte[:, word] |= bit
            elif symbol >= 0:
                self.byte[symbol, word] |= bit
            if state in loops:
                self.loop[:, word] |= bit
                if loops[state] == "+":
                    self.loop[47, word] &= ~bit
        for state in heads:
            self.start[state // 64] |= np.uint64(1 << state % 64)

    def step(self, state: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """One byte for each row. No byte leads into a first state, so the shift
        out of one glob's last state dies in the ``byte`` mask."""
        shifted = state << np.uint64(1)
        shifted[:, 1:] |= state[:, :-1] >> np.uint64(63)
        return (shifted & self.byte[byte]) | (state & self.loop[byte])

    def fits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Texts x globs: which globs fit the whole text."""
        sizes = np.diff(offsets)
        order = np.argsort(-sizes, kind="stable")
        state = np.repeat(self.start[None], len(sizes), axis=0)
        long_first, heads = sizes[order], offsets[:-1][order]
        live = len(order)
        for at in range(int(long_first[0]) if live else 0):
            while live and long_first[live - 1] <= at:
                live -= 1
            state[:live] = self.step(state[:live], data[heads[:live] + at])
        out = np.empty((len(sizes), len(self.accepts)), bool)
        word, bit = self.accepts // 64, (self.accepts % 64).astype(np.uint64)
        out[order] = (state[:, word] >> bit) & np.uint64(1) == 1
        return out


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    default: str = "allow",
    url_col: str = "url",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Columns of ``pages`` (or those of ``keep``) with host, path, rule and verdict."""
    results = ["host", "path", "rule", "verdict"]
    kept = [c for c in (pages.columns if keep is None else keep) if c not in results]
    urls = pages.select(
        *kept, host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path")
    )
    ranked = sorted(rules, key=lambda r: -r.weight)  # stable: then as listed
    globs = [(g, k) for k, r in enumerate(ranked) for g in r.globs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = Automaton([g for g, _ in globs])
        owner = np.array([k for _, k in globs], dtype=np.int64)
        names = pa.array([*(r.name for r in ranked), None], pa.string())
        actions = pa.array([*(r.action for r in ranked), default], pa.string())
        for batch in batches:
            texts = [texts_of(batch.column(batch.schema.names.index(c))) for c in results[:2]]
            canonical, offsets = _joined(*texts)
            fit = automaton.fits(canonical, offsets)
            best = np.where(fit, owner[None], len(ranked)).min(axis=1, initial=len(ranked))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, names.take(pa.array(best)), actions.take(pa.array(best))],
                names=[*batch.schema.names, *results[2:]],
            )

    schema = T.StructType([*urls.schema, *(T.StructField(c, T.StringType()) for c in results[2:])])
    return urls.mapInArrow(run, schema)


def _joined(a, b) -> tuple[np.ndarray, np.ndarray]:
    """Texts a[i] + b[i] in one array."""
    size_a, size_b = np.diff(a.offsets), np.diff(b.offsets)
    offsets = np.concatenate([[0], np.cumsum(size_a + size_b)])
    data = np.empty(offsets[-1], np.uint8)
    for texts, sizes, heads in ((a, size_a, offsets[:-1]), (b, size_b, offsets[:-1] + size_a)):
        data[np.repeat(heads - texts.offsets[:-1], sizes) + np.arange(len(texts.data))] = texts.data
    return data, offsets
