"""Words of many texts at once, as 64-bit hashes, without a Python object per word.

A word is a maximal run of bytes other than space and 0x09 to 0x0D. All
arithmetic is modulo 2**64 on whole arrays.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes hashed in one go; bounds the memory of the arrays below, except that a
# single longer text is always taken whole.
BLOCK_BYTES = 1 << 20

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers = {_BASE: np.ones(1, np.uint64), _BASE_INVERSE: np.ones(1, np.uint64)}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 … base**(n-1), kept and extended by doubling."""
    have = _powers.setdefault(base, np.ones(1, np.uint64))
    while len(have) < n:
        factor = np.uint64(pow(base, len(have), 1 << 64))
        have = np.concatenate([have, have * factor])
        _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits (one-to-one)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of values[start:end] for all spans, before mixing."""
    n = len(values)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(_BASE, n), out=total[1:])
    return (total[ends] - total[starts]) * powers(_BASE_INVERSE, n + 1)[starts]


@dataclass
class Texts:
    """Some texts' bytes in one array; text i is data[offsets[i]:offsets[i + 1]]."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Words:
    """Words of ``Texts`` in order; text i has words first[i] up to first[i + 1]."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray


def texts_of(column: pa.Array | pa.ChunkedArray) -> Texts:
    """The column's bytes; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    column = column.cast(pa.large_string()).fill_null("")
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64, len(column) + 1, column.offset * 8)
    low, high = int(offsets[0]), int(offsets[-1])
    raw = np.frombuffer(data, np.uint8, high - low, low) if high > low else np.zeros(0, np.uint8)
    return Texts(raw, offsets - low)


def blocks(texts: Texts, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, Texts]]:
    """Consecutive texts of together ``limit`` bytes, at least one each."""
    start, n = 0, len(texts)
    while start < n:
        stop = int(np.searchsorted(texts.offsets, texts.offsets[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), n)
        low, high = texts.offsets[start], texts.offsets[stop]
        yield start, Texts(texts.data[low:high], texts.offsets[start : stop + 1] - low)
        start = stop


def words_of(texts: Texts, lower: bool = False, space: np.ndarray = SPACE) -> Words:
    """Words of one block of texts; ``lower`` folds A-Z first."""
    data = LOWER[texts.data] if lower else texts.data
    n = len(data)
    inside = ~space[data]
    edge = np.zeros(n + 1, bool)
    edge[texts.offsets] = True
    before = np.ones(n, bool)
    after = np.ones(n, bool)
    before[1:] = ~inside[:-1]
    after[:-1] = ~inside[1:]
    starts = np.flatnonzero(inside & (before | edge[:-1]))
    ends = np.flatnonzero(inside & (after | edge[1:])) + 1
    sums = span_sums(data.astype(np.uint64) + np.uint64(1), starts, ends)
    lengths = (ends - starts).astype(np.uint64)
    return Words(starts, ends, mix(sums + lengths * _STEP), np.searchsorted(starts, texts.offsets))
