"""Sets of 64-bit keys sent through a shuffle in few bytes: sorted, cut into buckets by their leading bits, as gaps.

A map task holds the keys of some million words, sends one row per bucket, and forgets them. A sorted gap takes some
three bytes where a row takes sixteen; gaps are laid by byte planes, so that the upper bytes, nearly all zero, are squeezed
out by the shuffle's own compression. Keys are cut to as many bits as the size of the input asks for, so a cut key only
proposes; what it proposes is checked on whole keys.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Layout:
    """``bits`` kept of a key, and how many of them choose the bucket."""

    bits: int
    bucket_bits: int

    def cut(self, keys: np.ndarray) -> np.ndarray:
        return keys >> np.uint64(64 - self.bits)

    def runs(self, cut: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Bucket, first and one past the last index of each run of sorted keys."""
        bucket = (cut >> np.uint64(self.bits - self.bucket_bits)).astype(np.int64)
        edges = np.flatnonzero(np.diff(bucket)) + 1
        for lo, hi in zip(np.r_[0, edges].tolist(), np.r_[edges, len(cut)].tolist(), strict=True):
            if hi > lo:
                yield int(bucket[lo]), lo, hi


def total_bytes(df: DataFrame, text: str = "text") -> int:
    return df.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0


def layout(n_bytes: int, slack: int = 10, bytes_per_bucket: int = 8 << 20) -> Layout:
    """So many bits that a chance match of a cut key is one in 2^``slack`` at most; buckets of like size at any scale."""
    bucket_bits = max(4, int(np.ceil(np.log2(max(1, n_bytes / bytes_per_bucket)))))
    return Layout(min(64, max(32, int(np.ceil(np.log2(max(2, n_bytes)))) + slack)), bucket_bits)


def encode(keys: np.ndarray) -> bytes:
    """Sorted keys as first key, gap width and gaps, all lowest bytes first."""
    if not len(keys):
        return b""
    gaps = np.diff(keys)
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8) if len(gaps) else 1
    wide = gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return int(keys[0]).to_bytes(8, "little") + bytes([width]) + wide.T.tobytes()


def decode(blob: bytes) -> np.ndarray:
    if not blob:
        return np.empty(0, np.uint64)
    width = blob[8]
    body = np.frombuffer(blob, np.uint8, offset=9).reshape(width, -1)
    out = np.zeros((body.shape[1] + 1, 8), np.uint8)
    out[1:, :width] = body.T
    keys = out.view("<u8").ravel()
    keys[0] = int.from_bytes(blob[:8], "little")
    return np.cumsum(keys, dtype=np.uint64)


def bits_to_bytes(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def bytes_to_bits(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, np.uint8), count=n).astype(bool)
