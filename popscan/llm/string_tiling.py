"""Benchmark decontamination by greedy string tiling.

Texts and items are compared as words: A-Z lowered, ASCII punctuation read as space. Runs of ``min_match`` words that a
document shares with an item are the seeds of a join; a pair whose seeds cannot cover ``min_coverage`` of the item is
dropped (no tile lies outside them). For the rest the longest common runs that do not overlap are marked again and
again, found by Karp-Rabin hashes of windows whose length shrinks to ``min_match``, and the share of the item's words
under tiles is its coverage. Tiles may stand in any order, so reordered passages count.

Seeds meet by an equi-join on their hash: the benchmark's, each with its place in an item, and those runs of the
documents that a filter of fixed size (:mod:`popscan.llm.sketch`) lets through. What a pair's seeds could cover is counted
from the join, and only pairs that can reach ``min_coverage`` bring their texts together. A benchmark of any size is a
table like the documents; equal items are tiled once and counted as often as they stand.

Defined results: null or empty texts hold nothing; an item of fewer than ``min_match`` words is matched as a whole run;
an item without words is never found; repeated items count once each; of items covered alike the smallest id is named,
null last; repeated documents keep their rows; with an empty benchmark nothing is contaminated; an empty table gives no
row; a text of any length is one piece, tiled in a task that holds it whole. Columns of the result's names are replaced,
others pass untouched, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popscan.llm.line_rules import row_key
from popscan.llm.sketch import screened, sent
from popscan.llm.storage import stored
from popscan.llm.textual import mix, slices, words_of

ADDED = ("item_id", "coverage", "n_items", "contaminated")
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
for _c in b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~":
    _PLAIN[_c] = 32
_BASE = np.uint64(0xD1342543DE82EF95)


def word_hashes(texts: list[str]) -> list[np.ndarray]:
    data = [t.encode() for t in texts]
    bounds = np.concatenate(([0], np.cumsum([len(x) for x in data]))).astype(np.int64)
    w = words_of(_PLAIN[np.frombuffer(b"".join(data), np.uint8)], bounds)
    first = w.first()
    return [w.hash[first[i] : first[i + 1]] for i in range(len(texts))]


def _windows(words: np.ndarray, free: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and Karp-Rabin hashes of the windows of ``size`` words of which none is marked."""
    if len(words) < size:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    taken = np.concatenate(([0], np.cumsum(~free)))
    at = np.flatnonzero(taken[size:] == taken[:-size])
    up = np.full(len(words), _BASE, np.uint64)
    up[0] = 1
    up = np.multiply.accumulate(up)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * up, dtype=np.uint64)))
    # scaled to one power for all, so that equal windows agree wherever they stand
    return at, (total[at + size] - total[at]) * up[len(words) - 1 - at] if len(at) else np.empty(0, np.uint64)


def _matches(a: np.ndarray, b: np.ndarray, fa: np.ndarray, fb: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """Maximal free common runs of at least ``size`` words: length, place in ``a``, place in ``b``."""
    n = max(len(a), len(b))
    pad = lambda x: np.concatenate((x, np.zeros(n - len(x), np.uint64)))
    free = lambda f: np.concatenate((f, np.zeros(n - len(f), bool)))
    pa_, ha = _windows(pad(a), free(fa), size)
    pb_, hb = _windows(pad(b), free(fb), size)
    hits = np.flatnonzero(np.isin(hb, ha))
    places: dict[int, list[int]] = {}
    for p, h in zip(pa_.tolist(), ha.tolist(), strict=True):
        places.setdefault(h, []).append(p)
    out, seen = [], set()
    for q, h in zip(pb_[hits].tolist(), hb[hits].tolist(), strict=True):
        for p in places[h]:
            if (p - 1, q - 1) in seen:  # inside the run found one place before
                seen.add((p, q))
                continue
            k = 0
            while p + k < len(a) and q + k < len(b) and fa[p + k] and fb[q + k] and a[p + k] == b[q + k]:
                k += 1
            if k >= size:
                out.append((k, p, q))
                seen.add((p, q))
    return out


def tiles(item: np.ndarray, text: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Greedy tiling: ``(length, place in item, place in text)`` of runs that do not overlap, longest first."""
    fa, fb = np.ones(len(item), bool), np.ones(len(text), bool)
    out: list[tuple[int, int, int]] = []
    size = max(min_match, min(len(item), len(text)))
    while True:
        found = _matches(item, text, fa, fb, size)
        marked = False
        longest = max((k for k, _, _ in found), default=0)  # shorter ones wait: a cut run may turn out longer than they
        for k, p, q in sorted(m for m in found if m[0] == longest):
            if fa[p : p + k].all() and fb[q : q + k].all():
                fa[p : p + k] = False
                fb[q : q + k] = False
                out.append((k, p, q))
                marked = True
        if marked:
            continue
        if size == min_match:
            return out
        size = max(min_match, size // 2)


def coverage(item: np.ndarray, text: np.ndarray, min_match: int) -> float:
    if not len(item):
        return 0.0
    return sum(k for k, _, _ in tiles(item, text, min(min_match, len(item)))) / len(item)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for k in range(n):
        out = out * _BASE + words[k : k + len(out)]
    return mix(out)


def _seed(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` words, told apart from those of other lengths."""
    return mix(gram_hashes(words, n) + np.uint64(n))


def _item_seeds(min_match: int):
    """Seeds of items: hash, length, the item, its place there and the item's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            item = np.asarray(batch.column("item"))
            columns = [[] for _ in range(5)]
            for i, words in enumerate(word_hashes(batch.column("text").to_pylist())):
                if not len(words):
                    continue
                n = min(min_match, len(words))
                key = _seed(words, n)
                whole = np.ones(len(key), np.int64)
                for c, v in zip(columns, (key.view(np.int64), whole * n, whole * item[i], np.arange(len(key)), whole * len(words)), strict=True):
                    c.append(v)
            arrays = [pa.array(np.concatenate(c) if c else np.empty(0, np.int64), pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, names=["seed", "n", "item", "place", "size"])

    return run


def _text_seeds(lengths: list[int], known: Broadcast):
    """Seeds of documents that may be an item's, each once in a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, _, data, bounds in slices(batch.column("text")):
                w = words_of(_PLAIN[data], bounds)
                seeds, docs = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
                for n in lengths:
                    key = _seed(w.hash, n)
                    at = np.flatnonzero(known.value.holds(key))
                    at = at[w.doc[at] == w.doc[at + n - 1]]
                    seeds.append(key[at])
                    docs.append(w.doc[at])
                seed, doc = np.concatenate(seeds), np.concatenate(docs)
                order = np.lexsort((seed, doc))
                seed, doc = seed[order], doc[order]
                new = np.ones(len(seed), bool)
                new[1:] = (seed[1:] != seed[:-1]) | (doc[1:] != doc[:-1])
                take = pa.array(lo + doc[new])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seed[new].view(np.int64)), batch.column("_id").take(take), batch.column("_row").take(take)],
                    names=["seed", "_id", "_row"],
                )

    return run


def _tiled(min_match: int, least: float):
    """Coverage of each pair's item, of pairs that reach ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                texts, items = (word_hashes(part.column(c).to_pylist()) for c in ("text", "item_text"))
                covered = np.array([coverage(x, t, min_match) for x, t in zip(items, texts, strict=True)])
                keep = pa.array(covered >= least)
                out = part.select(["_id", "_row", "item_id", "copies"]).append_column("coverage", pa.array(covered, pa.float64()))
                yield out.filter(keep)

    return run


def candidates(documents: DataFrame, items: DataFrame, min_match: int, min_coverage: float) -> DataFrame:
    """``_id, _row, item``: documents (``_id, _row, text``) and items whose common seeds could cover enough."""
    seeds = stored(
        items.select("item", "text").mapInArrow(_item_seeds(min_match), "seed long, n long, item long, place long, size long"), "seeds"
    )
    lengths = sorted(r["n"] for r in seeds.select("n").distinct().collect())  # min_match of them at most
    own = documents.select("text", "_id", "_row").mapInArrow(
        _text_seeds(lengths, sent(seeds, "seed")), "seed long, _id string, _row long"
    )
    under = F.transform("places", lambda p: F.sequence(p, p + F.col("n") - 1))
    return (
        own.join(seeds, "seed")
        .groupBy("_id", "_row", "item", "size", "n")
        .agg(F.collect_set("place").alias("places"))  # no more than the item has words
        .filter(F.size("places") * F.col("n") >= min_coverage * F.col("size"))
        .filter(F.size(F.array_distinct(F.flatten(under))) >= min_coverage * F.col("size"))
        .select("_id", "_row", "item")
    )


def contamination(documents: DataFrame, benchmark: DataFrame, min_match: int = 4, min_coverage: float = 0.6) -> DataFrame:
    """``documents`` with the best covered item (smallest id of equals), its coverage (0 below the threshold), the number
    of items found, and whether the document is contaminated."""
    documents = documents.drop(*ADDED)
    # the input's columns travel in one of their own, so none of ours can clash with them
    held = documents.select(F.struct("*").alias("_in"), F.col("text").cast("string").alias("text"), *row_key("text"))
    items = benchmark.filter(F.length("text") > 0).groupBy(F.col("item_id").cast("long").alias("item_id"), "text")
    items = stored(items.agg(F.count(F.lit(1)).alias("copies")).withColumn("item", F.xxhash64("item_id", "text")), "items")
    texts = held.select("text", "_id", "_row").filter(F.length("text") > 0)
    pairs = stored(candidates(texts, items, min_match, min_coverage), "pairs")
    row = F.xxhash64("_id", "_row")
    named = items.select("item", "item_id", F.col("text").alias("item_text"), "copies")
    paired = screened(texts, row, sent(pairs, row)).dropDuplicates(["_id", "_row"]).join(pairs, ["_id", "_row"]).join(named, "item")
    # written in between, as two Python steps in one task would be two workers
    paired = stored(paired.select("_id", "_row", "text", "item_id", "item_text", "copies"), "pair-texts")
    found = paired.mapInArrow(
        _tiled(min_match, min_coverage), "_id string, _row long, item_id long, copies long, coverage double"
    )
    best = F.min(F.struct((-F.col("coverage")).alias("c"), F.col("item_id").isNull().alias("lost"), "item_id"))
    found = found.groupBy("_id", "_row").agg(best.alias("b"), F.sum("copies").alias("n_items"))
    found = stored(found.select("_id", "_row", "b.item_id", (-F.col("b.c")).alias("coverage"), "n_items"), "found")
    hit = sent(found, row)
    out = ["_in.*", "item_id", "coverage", "n_items", (F.col("n_items") > 0).alias("contaminated")]
    nothing = {"item_id": F.lit(None).cast("long"), "coverage": F.lit(0.0), "n_items": F.lit(0).cast("long")}
    clear = screened(held.select("_in", "_id", "_row"), row, hit, inside=False).withColumns(nothing).select(*out)
    rest = screened(held.select("_in", "_id", "_row"), row, hit).join(found, ["_id", "_row"], "left")
    rest = rest.withColumns({"coverage": F.coalesce("coverage", F.lit(0.0)), "n_items": F.coalesce("n_items", F.lit(0).cast("long"))})
    return clear.unionByName(rest.select(*out))
