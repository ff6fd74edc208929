"""Plain versions of the operators, over Python lists."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def fold(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def repeats(texts: list[str | None], window: int) -> list[tuple[int, int, str]]:
    """Words, removed words and digest of the kept ones, of each text."""
    split = [words(t) for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    return out


def shingles(text: str | None, n: int) -> frozenset:
    w = words(fold(text or ""))
    if len(w) >= n:
        return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    return frozenset([tuple(w)] if w else [])


def groups(rows: list[tuple[int, str | None]], n: int, percent: int) -> dict[int, int]:
    """The smallest id reachable from each id (ids unique)."""
    sets = {i: shingles(t, n) for i, t in rows}
    top = {i: i for i in sets}

    def find(x: int) -> int:
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                top[y] = x
    return {i: find(i) for i in ids}


def tiled(a: list, b: list, least: int) -> int:
    """Elements of ``a`` under a greedy tiling."""
    free_a, free_b, covered = [True] * len(a), [True] * len(b), 0
    while True:
        best, found = 0, []
        for p in range(len(a)):
            for q in range(len(b)):
                k = 0
                while p + k < len(a) and q + k < len(b) and a[p + k] == b[q + k] and free_a[p + k] and free_b[q + k]:
                    k += 1
                if k > best:
                    best, found = k, []
                if k == best and k:
                    found.append((p, q))
        if best < least:
            return covered
        for p, q in found:
            if all(free_a[p : p + best]) and all(free_b[q : q + best]):
                free_a[p : p + best] = free_b[q : q + best] = [False] * best
                covered += best
