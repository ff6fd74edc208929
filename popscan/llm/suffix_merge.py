"""Repeated byte strings found by a suffix sort whose comparisons are by hash.

A string of ``length`` bytes that also starts in a document with a smaller id is removed from the later one. Suffixes are
sorted in buckets: every window of ``length`` bytes names the least hashed gram in it (its anchor), so equal windows of
any two documents meet in the bucket of one gram. Each anchor sends the text that its windows cover, its context. Equal
contexts are one; a bucket with several sorts the suffixes of all of them:

* windows whose hash nobody shares equal no other and stay out of the sort, the rest is sorted in pieces dealt by hash;
* prefix polynomial hashes of the bucket's text tell whether two substrings are equal; a binary search over their length
  finds the common extension of two suffixes, so a comparison takes a logarithmic number of steps;
* a bottom-up mergesort over these comparisons puts equal windows side by side, all buckets of a batch at once;
* collision verification: neighbours are compared byte by byte; a batch in which a hash has lied is sorted by its bytes.

The least document of a run of equal windows decides for all of them.

Around it: exact copies are resolved by their digests, and only the first copy is looked at. Anchors are first counted by
gram, and only those in two documents and more send their context; a filter of fixed size (:mod:`popscan.llm.sketch`)
carries them back, so larger inputs send some contexts in vain, which costs shuffle only. A gram with more than
``largest_bucket`` occurrences is not one task's work: its windows are grouped and joined back as rows, each by its bytes.

Defined results: null and empty texts have nothing to remove; a null id is neither smaller nor larger than any, so such
rows stay whole and remove nothing; rows with equal ids do not remove each other's strings, and repeated rows give equal
results; a string that starts twice in one document alone stays; an empty table gives no row; texts of any length are one
piece, so a task holds some hundred times a slice of half a MB or the longest text; other columns do not reach the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popscan.llm.sketch import screened, sketch
from popscan.llm.storage import stored
from popscan.llm.textual import _BYTE, _power, mix, slices

GRAM = 16
BATCH_ROWS = 1 << 14  # contexts judged together, unless one bucket has more
PIECE = 1 << 15  # windows sorted together
_CONTEXTS = 1 << 14  # contexts hashed together
_ROWS, _BYTES = 256, 1 << 19  # rows, and bytes of text, whose anchors are looked for together: some fifty times the bytes are held
_ROW = ["doc_id", "h"]


# ---- anchors -------------------------------------------------------------------------------------------------------


def anchors(data: np.ndarray, bounds: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Gram hash, first and last window start of each anchor, in order; equal windows have equal anchors.

    A window's anchor is its gram of least hash (upper 32 bits), the leftmost of equal ones.
    """
    none = (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))
    n = len(data)
    if n < length:
        return none
    up, down = _power("byte", n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:n], out=total[1:])
    key = mix((total[gram:] - total[:-gram]) * down[: n - gram + 1])
    low = key >> np.uint64(32) << np.uint64(32) | np.arange(len(key), dtype=np.uint64)
    span, width = 1, length - gram + 1
    while span < width:
        step = min(span, width - span)
        low = np.minimum(low[:-step], low[step:])
        span += step
    inside = np.ones(len(low), bool)
    for b in bounds[1:-1].tolist():
        inside[max(0, b - length + 1) : b] = False
    start = np.flatnonzero(inside)
    if not len(start):
        return none
    at = (low[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    edge = np.flatnonzero((at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1)) + 1
    first = np.r_[0, edge]
    return key[at[first]], start[first], start[np.r_[edge, len(start)] - 1]


def _read(batches: Iterator[pa.RecordBatch], skip: Broadcast | None, length: int, gram: int):
    """Slices of the texts that are not skipped: ids, hashes, bytes, bounds, and their anchors."""
    for batch in (whole.slice(lo, _ROWS) for whole in batches for lo in range(0, whole.num_rows, _ROWS)):
        if skip is not None:
            keep = ~skip.value.holds(np.asarray(batch.column("row")).view(np.uint64))
            batch = batch.filter(pa.array(keep))
        ids, h = np.asarray(batch.column("doc_id")), np.asarray(batch.column("h"))
        for lo, hi, data, bounds in slices(batch.column("text"), _BYTES):
            yield ids[lo:hi], h[lo:hi], data, bounds, anchors(data, bounds, length, gram)


def _counted(length: int, gram: int, skip: Broadcast | None):
    """Grams of anchors, how often and in how many documents of a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, _, bounds, (key, first, _) in _read(batches, skip, length, gram):
            doc = np.searchsorted(bounds, first, side="right") - 1
            order = np.lexsort((doc, key))
            key, doc = key[order], doc[order]
            new = np.r_[True, key[1:] != key[:-1]] if len(key) else np.empty(0, bool)
            at = np.flatnonzero(new)
            other = new | np.r_[False, doc[1:] != doc[:-1]] if len(key) else new
            docs = np.add.reduceat(other.astype(np.int64), at) if len(at) else np.empty(0, np.int64)
            n = np.diff(np.r_[at, len(key)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[at].view(np.int64)), pa.array(n), pa.array(docs)], names=["key", "n", "docs"]
            )

    return run


def _pieces(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> pa.Array:
    """Substrings as a binary column."""
    size = end - first
    offsets = np.concatenate(([0], np.cumsum(size)))
    at = np.repeat(first - offsets[:-1], size) + np.arange(offsets[-1])
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(first), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[at].tobytes())]
    ).cast(pa.binary())


def _contexts(length: int, gram: int, skip: Broadcast | None, shared: Broadcast, hot: Broadcast | None, windows: bool):
    """Contexts of anchors whose gram several documents have; of hot grams single windows, and only these with ``windows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, h, data, bounds, (key, first, last) in _read(batches, skip, length, gram):
            take = shared.value.holds(key)
            if hot is not None:
                take &= hot.value.holds(key) == windows
            key, first, last = key[take], first[take], last[take]
            if windows:
                n = last - first + 1
                key = np.repeat(key, n)
                first = np.repeat(first - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
                last = first
            doc = np.searchsorted(bounds, first, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key.view(np.int64)), _pieces(data, first, last + length), pa.array(ids[doc]), pa.array(h[doc]),
                    pa.array(first - bounds[doc]),
                ],
                names=["key", "context", "doc_id", "h", "start"],
            )

    return run


# ---- suffix sort ---------------------------------------------------------------------------------------------------


class Suffixes:
    """Suffixes of ``text`` at ``start``, told apart by their first ``length`` bytes."""

    def __init__(self, text: np.ndarray, start: np.ndarray, length: int):
        self.text, self.start, self.length = text, start, length
        up, self.down = _power("byte", len(text) + 1)
        self.total = np.zeros(len(text) + 1, np.uint64)
        np.cumsum(_BYTE[text] * up[: len(text)], out=self.total[1:])
        self.head = np.zeros(len(start), np.uint64)  # the first bytes as a number
        for i in range(min(8, length)):
            self.head = self.head << np.uint64(8) | text[start + i]

    def _hash(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (self.total[at + size] - self.total[at]) * self.down[at]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes at places ``a`` and ``b``, ``length`` at most."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.length)
        for _ in range(int(self.length).bit_length()):
            mid = (low + high + 1) >> 1
            same = self._hash(a, mid) == self._hash(b, mid)
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
            high = np.maximum(low, high)
        return low

    def compare(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 for pairs of suffixes: by their heads, then by the byte behind their common extension."""
        out = (self.head[x] > self.head[y]).astype(np.int8) - (self.head[x] < self.head[y])
        tied = np.flatnonzero(out == 0)
        a, b = self.start[x[tied]], self.start[y[tied]]
        n = self.common(a, b)
        apart = n < self.length
        left, right = self.text[a[apart] + n[apart]], self.text[b[apart] + n[apart]]
        out[tied[apart]] = (left > right).astype(np.int8) - (left < right)
        return out

    def whole(self) -> np.ndarray:
        """Hashes of the suffixes' first ``length`` bytes."""
        return self._hash(self.start, np.full(len(self.start), self.length))

    def _bytes(self, x: np.ndarray) -> np.ndarray:
        return self.text[self.start[x][:, None] + np.arange(self.length)]

    def sort(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes by group (ascending numbers) and content, and whether each differs from the one before it."""
        order = _merge_sort(group, self.compare)
        x, y, same_group = order[:-1], order[1:], group[order[1:]] == group[order[:-1]]
        new = np.ones(len(order), bool)
        ok = True
        for lo in range(0, len(x), 1 << 16):
            cut = slice(lo, lo + (1 << 16))
            left, right = self._bytes(x[cut]), self._bytes(y[cut])
            differ = left != right
            any_ = differ.any(axis=1)
            at = differ.argmax(axis=1)
            row = np.arange(len(at))
            ok &= bool((~same_group[cut] | ~any_ | (left[row, at] < right[row, at])).all())
            new[1:][cut] = any_ | ~same_group[cut]
        return (order, new) if ok else self._by_bytes(group)

    def _by_bytes(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The plain sort, for a batch in which two substrings share a hash."""
        whole = np.concatenate([group.astype(">u8").view(np.uint8).reshape(-1, 8), self._bytes(np.arange(len(group)))], axis=1)
        whole = np.ascontiguousarray(whole).view(f"V{whole.shape[1]}").ravel()
        as_bytes = np.array([x.tobytes() for x in whole], object)
        order = np.argsort(as_bytes, kind="stable")
        ordered = as_bytes[order]
        return order, np.r_[True, ordered[1:] != ordered[:-1]] if len(order) else np.empty(0, bool)


def _merge_sort(group: np.ndarray, compare) -> np.ndarray:
    """Bottom-up mergesort inside each group; both halves of every merge place their members by binary search."""
    order = np.argsort(group, kind="stable")
    if not len(order):
        return order
    sizes = np.bincount(group[order] - group.min())
    sizes = sizes[sizes > 0]
    begin = np.repeat(np.cumsum(sizes) - sizes, sizes)
    end = begin + np.repeat(sizes, sizes)
    place = np.arange(len(order))
    width = 1
    while width < sizes.max():
        run = (place - begin) // width
        own = begin + run * width
        other = np.where(run % 2 == 0, own + width, own - width)
        low, high = np.minimum(other, end), np.minimum(other + width, end)
        base = low.copy()
        todo = np.flatnonzero(low < high)
        while len(todo):
            mid = (low[todo] + high[todo]) >> 1
            sign = compare(order[mid], order[todo])  # sibling against own
            before = (sign < 0) | ((sign == 0) & (run[todo] % 2 == 1))  # the left half goes first
            low[todo] = np.where(before, mid + 1, low[todo])
            high[todo] = np.where(before, high[todo], mid)
            todo = todo[low[todo] < high[todo]]
        target = np.minimum(own, other) + (place - own) + (low - base)
        merged = np.empty_like(order)
        merged[target] = order
        order = merged
        width *= 2
    return order


# ---- verdicts ------------------------------------------------------------------------------------------------------


def _window_hashes(text: np.ndarray, begin: np.ndarray, count: np.ndarray, length: int) -> np.ndarray:
    """Hash of every window of the contexts that begin at ``begin``, some thousand contexts at a time."""
    out = []
    for lo in range(0, len(begin), _CONTEXTS):
        n = count[lo : lo + _CONTEXTS]
        base, end = begin[lo], begin[lo : lo + _CONTEXTS][-1] + n[-1] - 1 + length
        first = np.cumsum(n) - n
        at = np.repeat(begin[lo : lo + _CONTEXTS] - base - first, n) + np.arange(n.sum())
        out.append(Suffixes(text[base:end], at, length).whole())
    return np.concatenate(out)


def _least_of_equal(text: np.ndarray, start: np.ndarray, group: np.ndarray, key: np.ndarray, value: np.ndarray, length: int) -> None:
    """Lower ``value`` of each window to the least among equal windows.

    A window whose hash stands once equals no other. The others are dealt by hash into pieces that a task can hold, and
    each piece is sorted. A piece of one hash alone, however large, is compared with its first window.
    """
    order = np.argsort(key, kind="stable")
    fresh = np.r_[True, key[order[1:]] != key[order[:-1]]]
    edge = np.flatnonzero(fresh)
    size = np.diff(np.r_[edge, len(order)])
    order = order[np.repeat(size > 1, size)]
    size = size[size > 1]
    ends = np.cumsum(size)
    done = 0
    while done < len(order):
        stop = int(ends[max(np.searchsorted(ends, done + PIECE, side="right") - 1, np.searchsorted(ends, done, side="right"))])
        piece, done = order[done:stop], stop
        if len(piece) > PIECE:
            leader = text[start[piece[0]] : start[piece[0]] + length]
            parts = np.array_split(piece, -(-len(piece) // PIECE))
            if all((text[start[x][:, None] + np.arange(length)] == leader).all() for x in parts):
                value[piece] = value[piece].min()
                continue
        piece = piece[np.argsort(group[piece], kind="stable")]
        own = text[start[piece][:, None] + np.arange(length)].ravel()
        found, differs = Suffixes(own, np.arange(len(piece)) * length, length).sort(group[piece])
        least = np.minimum.reduceat(value[piece[found]], np.flatnonzero(differs))
        value[piece[found]] = least[np.cumsum(differs) - 1]


def _judge(t: pa.Table, length: int) -> pa.RecordBatch:
    """Removed intervals of whole buckets, sorted by key, context and document."""
    key, doc, h, start = (np.asarray(t.column(c).combine_chunks()) for c in ("key", "doc_id", "h", "start"))
    context = t.column("context").combine_chunks()
    context = pa.concat_arrays(context.chunks) if isinstance(context, pa.ChunkedArray) else context
    n = len(key)
    new = np.ones(n, bool)
    new[1:] = np.asarray(pc.not_equal(context[1:], context[:-1])) | (key[1:] != key[:-1])
    of = np.cumsum(new) - 1  # row -> distinct context
    at = np.flatnonzero(new)
    least = doc[at]
    size = np.asarray(pc.binary_length(context)).astype(np.int64)
    # per context and window the least document; a lone context has one for all its windows
    bucket = np.cumsum(np.r_[True, key[at][1:] != key[at][:-1]]) - 1
    shared = np.bincount(bucket)[bucket] > 1
    low, high = least.copy(), least.copy()  # over the windows of a context
    some = np.flatnonzero(shared)
    window_least = np.empty(0, np.int64)
    offset = np.zeros(len(at) + 1, np.int64)
    if len(some):
        text = np.frombuffer(b"".join(context.take(pa.array(at[some])).to_pylist()), np.uint8)
        sizes = size[at[some]]
        count = sizes - length + 1
        begin = np.cumsum(sizes) - sizes
        first = np.cumsum(count) - count
        starts = np.repeat(begin - first, count) + np.arange(count.sum())
        window_least = np.repeat(least[some], count)
        hashes = _window_hashes(text, begin, count, length)
        _least_of_equal(text, starts, np.repeat(bucket[some], count), hashes, window_least, length)
        low[some], high[some] = np.minimum.reduceat(window_least, first), np.maximum.reduceat(window_least, first)
        offset[some] = first
    whole = np.flatnonzero(doc > high[of])
    rows, begins, ends = [whole], [start[whole]], [start[whole] + size[whole]]
    part = np.flatnonzero((doc > low[of]) & (doc <= high[of]))
    for lo in range(0, len(part), 1 << 14):
        some_rows = part[lo : lo + (1 << 14)]
        count = size[some_rows] - length + 1
        first = np.cumsum(count) - count
        member = np.repeat(some_rows, count)
        inner = np.arange(count.sum()) - np.repeat(first, count)
        gone = window_least[offset[of[member]] + inner] < doc[member]
        member, inner = member[gone], inner[gone]
        edge = np.r_[True, (member[1:] != member[:-1]) | (inner[1:] != inner[:-1] + 1)]
        f, e = np.flatnonzero(edge), np.r_[np.flatnonzero(edge)[1:], len(member)] - 1
        rows.append(member[f])
        begins.append(start[member[f]] + inner[f])
        ends.append(start[member[f]] + inner[e] + length)
    row = np.concatenate(rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(doc[row]), pa.array(h[row]), pa.array(np.concatenate(begins)), pa.array(np.concatenate(ends))],
        names=["doc_id", "h", "start", "end"],
    )


def _verdicts(length: int):
    """Buckets stream by in order; some ten thousand rows of whole buckets are judged together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if rows >= BATCH_ROWS:
                key = np.asarray(batch.column("key"))
                before = held[-1].column("key")[-1].as_py()
                same = int(np.argmax(key != before)) if (key != before).any() else len(key)
                if same:
                    held.append(batch.slice(0, same))
                    rows += same
                batch = batch.slice(same)
                if not batch.num_rows:
                    continue
                yield _judge(pa.Table.from_batches(held), length)
                held, rows = [], 0
            held.append(batch)
            rows += batch.num_rows
        if held:
            yield _judge(pa.Table.from_batches(held), length)

    return run


# ---- the operator --------------------------------------------------------------------------------------------------


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text without its intervals, and the maximal removed spans."""
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in (whole.slice(lo, 256) for whole in batches for lo in range(0, whole.num_rows, 256)):
        ids, texts, gone = (batch.column(c).to_pylist() for c in ("doc_id", "text", "gone"))
        kept, spans = [], []
        for text, intervals in zip(texts, gone, strict=True):
            data, out, rest, at = (text or "").encode(), [], [], 0
            for x in sorted(((i["start"], i["end"]) for i in intervals or ())):
                if out and x[0] <= out[-1][1]:
                    out[-1][1] = max(out[-1][1], x[1])
                else:
                    out.append([*x])
            for a, b in out:
                rest.append(data[at:a])
                at = b
            rest.append(data[at:])
            kept.append(b"".join(rest))
            spans.append([{"start": a, "end": b} for a, b in out])
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), batch.column("text"), pa.array(kept, pa.binary()), pa.array(spans, span)],
            names=["doc_id", "text", "kept", "spans"],
        )


def remove_repeats(documents: DataFrame, length: int = 50, gram: int = GRAM, largest_bucket: int = 1 << 19) -> DataFrame:
    """``doc_id, text, kept`` (binary) ``, spans`` (removed byte intervals) of each document."""
    if not 0 < gram <= length:
        raise ValueError("a gram must fit into the strings looked for")
    spark = documents.sparkSession
    broadcast = spark.sparkContext.broadcast
    text = F.col("text").cast("string")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("h"))
    docs = docs.withColumn("row", F.xxhash64("doc_id", "h"))
    able = docs.filter(F.col("doc_id").isNotNull() & (F.octet_length("text") >= length))

    # copies behind the first one go whole
    digests = able.select("doc_id", "h", "row", F.unhex(F.sha2("text", 256)).alias("digest"), F.octet_length("text").cast("long").alias("end"))
    firsts = digests.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last")
    copies = stored(digests.join(firsts, "digest").filter("doc_id > first").select("doc_id", "h", "row", "end"), "copies")
    skip = broadcast(sketch(copies, "row"))
    spared = screened(able, "row", skip).join(copies.select(*_ROW), _ROW, "left_anti")
    spared = stored(spared.select("doc_id", "text", "h", "row"), "spared")  # proposed by the filter, but no copies

    def over(make, schema: str) -> DataFrame:
        return able.mapInArrow(make(skip), schema).unionByName(spared.mapInArrow(make(None), schema))

    counts = over(lambda s: _counted(length, gram, s), "key long, n long, docs long")
    grams = stored(counts.groupBy("key").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).filter("docs > 1"), "grams")
    shared = broadcast(sketch(grams))
    large = grams.filter(F.col("n") > largest_bucket)
    hot = None if large.isEmpty() else broadcast(sketch(large))
    schema = "key long, context binary, doc_id long, h long, start long"
    contexts = over(lambda s: _contexts(length, gram, s, shared, hot, False), schema)
    ordered = contexts.repartition("key").sortWithinPartitions("key", "context", "doc_id")
    gone = ordered.mapInArrow(_verdicts(length), "doc_id long, h long, start long, end long")
    if hot is not None:
        windows = over(lambda s: _contexts(length, gram, s, shared, hot, True), schema).drop("key")
        first = windows.groupBy("context").agg(F.min("doc_id").alias("first"))
        later = windows.join(first, "context").filter("doc_id > first")
        gone = gone.unionByName(later.select(*_ROW, "start", (F.col("start") + length).alias("end")))
    gone = gone.unionByName(copies.select(*_ROW, F.lit(0).cast("long").alias("start"), "end"))
    gone = stored(gone.groupBy(*_ROW).agg(F.collect_list(F.struct("start", "end")).alias("gone")), "gone")

    touched = broadcast(sketch(gone.select(F.xxhash64(*_ROW).alias("key"))))
    whole = screened(docs, "row", touched, inside=False)
    cut = screened(docs, "row", touched).join(gone, _ROW, "left").select("doc_id", "text", "gone")
    no_spans = F.array().cast("array<struct<start:long,end:long>>")
    whole = whole.select("doc_id", "text", F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("kept"), no_spans.alias("spans"))
    return whole.unionByName(cut.mapInArrow(_cut, "doc_id long, text string, kept binary, spans array<struct<start:long,end:long>>"))
