"""Words of whole texts as numpy arrays: offsets and 64-bit hashes, a bounded slice of rows at a time.

A word is a run of bytes other than space and ``\\t\\n\\v\\f\\r``. These are single bytes in UTF-8, so texts are split
and hashed as bytes. A null text has no words. Working memory is some forty times the bytes of a slice; a single text
longer than a slice forms one of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MASK = (1 << 64) - 1
_BASE = {"byte": 0x9E3779B97F4A7C15, "word": 0xD1342543DE82EF95}
_powers: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def _power(kind: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64 and of its inverse, at least ``n`` of each."""
    up, down = _powers.get(kind, (np.empty(0, np.uint64),) * 2)
    if len(up) < n:
        size = max(n, 1 << 16)
        base = _BASE[kind]
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            x = np.full(size, b, np.uint64)
            x[0] = 1
            out.append(np.multiply.accumulate(x))
        up, down = _powers[kind] = (out[0], out[1])
    return up, down


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Words of consecutive texts: byte offsets in ``data``, the text's index and a hash for each."""

    data: np.ndarray
    bounds: np.ndarray  # byte offsets of the texts in data, one more than texts
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.bincount(self.doc, minlength=len(self.bounds) - 1)

    def first(self) -> np.ndarray:
        """Index of each text's first word, one more than texts."""
        return np.concatenate(([0], np.cumsum(self.counts)))

    def text(self, i: int) -> bytes:
        return self.data[self.bounds[i] : self.bounds[i + 1]].tobytes()

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of every run of ``n`` words inside one text."""
        if len(self.hash) < n:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        up, down = _power("word", len(self.hash) + 1)
        total = np.zeros(len(self.hash) + 1, np.uint64)
        np.cumsum(self.hash * up[: len(self.hash)], out=total[1:])
        at = np.flatnonzero(self.doc[: len(self.doc) - n + 1] == self.doc[n - 1 :])
        return at, mix((total[at + n] - total[at]) * down[at])


def words_of(data: np.ndarray, bounds: np.ndarray, fold: bool = False) -> Words:
    """``data`` holds the texts' bytes, ``bounds`` their offsets; ``fold`` lowers A-Z first."""
    if fold:
        data = _FOLD[data]
    n = len(data)
    solid = ~_SPACE[data]
    before = np.zeros(n, bool)
    before[1:] = solid[:-1]
    edges = bounds[:-1][bounds[:-1] < n]
    before[edges] = False
    start = np.flatnonzero(solid & ~before)
    after = np.zeros(n, bool)
    after[:-1] = solid[1:]
    last = bounds[1:][bounds[1:] > 0] - 1
    after[last] = False
    end = np.flatnonzero(solid & ~after) + 1
    doc = np.searchsorted(bounds, start, side="right") - 1
    up, down = _power("byte", n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:n], out=total[1:])
    return Words(data, bounds, start, end, doc, mix((total[end] - total[start]) * down[start]))


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return bytes_[at[0] : at[-1]], at - at[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``lo`` to ``hi`` with their bytes and offsets, about ``limit`` bytes at a time."""
    data, at = raw(column)
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, side="right")) - 1)
        yield lo, hi, data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        lo = hi


def sliced_words(column: pa.Array, fold: bool = False, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    for lo, hi, data, bounds in slices(column, limit):
        yield lo, hi, words_of(data, bounds, fold)


def bytes_list(data: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    whole, at = data.tobytes(), bounds.tolist()
    return [whole[a:b] for a, b in zip(at, at[1:], strict=False)]
