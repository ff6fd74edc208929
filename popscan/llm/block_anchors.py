"""Substring dedup by fixed-block anchors.

Every document is cut into reference blocks that do not overlap, short enough (``(window + 1) // 2`` words) that each
window of ``window`` words holds a whole one. The blocks are the index; every rolling run of a block's length, of every
document, probes it. A block that is found anywhere else is an anchor. Around anchors the hits are extended: each window
of ``window`` words that holds an anchor is looked up by its content, and those with a second start are the repeats;
where such windows follow each other they make up the maximal exact repeats, whose words are removed. Windows are judged
on the input, the first occurrence included.

Probes and windows are sent as packed sorted keys (:mod:`popscan.llm.packed`), once per task and bucket, so a passage
that stands in a third of all documents is one entry per task there. Which blocks are anchors goes back by a join on the
key, which adaptive execution splits where a key is hot. For the windows, an answer is one bit for each key asked, in
the order asked. Block keys may be cut short, as a false anchor only asks for more windows; window keys have 64 bits,
so two among a billion distinct candidate windows agree by chance with a probability under one in 30.

Defined results: null and empty texts have no words and keep the empty text; texts below the window's length keep all;
repeated rows are documents like any other (and so repeat each other) and each keeps its own row, ids null or equal
included. Columns other than ``doc_id`` and ``text`` do not reach the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popscan.llm.packed import Layout, bits_to_bytes, bytes_to_bits, decode, encode, layout, total_bytes
from popscan.llm.storage import stored
from popscan.llm.textual import raw, sliced_words

PACKED_WORDS = 2 << 20  # keys that a task holds before it sends them
BLOCK_TEXT_BYTES = 2 << 20  # text of the documents that ask for windows together


def _blocks_of(w, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and keys of all runs of a block's length, and which of them are reference blocks."""
    at, key = w.grams(size)
    inside = at - w.first()[w.doc[at]] if len(at) else at
    return at, key, inside % size == 0


def _probe(column: str, size: int, lay: Layout):
    """Packed keys of all rolling runs: bucket, keys, which are reference blocks, which stand twice in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        flags: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            key, flag = np.concatenate(keys), np.concatenate(flags)
            order = np.argsort(key)
            key, flag = key[order], flag[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            block = np.logical_or.reduceat(flag, first)
            twice = np.diff(np.r_[first, len(key)]) > 1
            key = key[first]
            rows = [
                (b, encode(key[lo:hi]), bits_to_bytes(block[lo:hi]), bits_to_bytes(twice[lo:hi]))
                for b, lo, hi in lay.runs(key)
            ]
            keys.clear()
            flags.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c) for c in zip(*rows, strict=True)], names=["bucket", "keys", "blocks", "twice"]
            )

        for batch in batches:
            for _, _, w in sliced_words(batch.column(column)):
                _, key, block = _blocks_of(w, size)
                if len(key):
                    keys.append(lay.cut(key))
                    flags.append(block)
                    held += len(key)
                if held >= PACKED_WORDS:
                    yield flush()
                    held = 0
        if held:
            yield flush()

    return run


def _found_blocks(table: pa.Table) -> pa.Table:
    """Keys of one bucket that are a reference block somewhere and stand in two places."""
    parts = [decode(x.as_py()) for x in table.column("keys")]
    key = np.concatenate(parts)
    n = [len(p) for p in parts]
    block = np.concatenate([bytes_to_bits(x.as_py(), k) for x, k in zip(table.column("blocks"), n, strict=True)])
    twice = np.concatenate([bytes_to_bits(x.as_py(), k) for x, k in zip(table.column("twice"), n, strict=True)])
    order = np.argsort(key)
    key, block, twice = key[order], block[order], twice[order]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    hit = np.logical_or.reduceat(block, first) & ((np.diff(np.r_[first, len(key)]) > 1) | np.logical_or.reduceat(twice, first))
    return pa.table({"key": pa.array(key[first[hit]].astype(np.int64))})


def _reference(size: int, lay: Layout):
    """Reference blocks as rows: key, row of the document, number of the block in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = np.asarray(batch.column("_row"))
            for lo, _, w in sliced_words(batch.column("text")):
                at, key, block = _blocks_of(w, size)
                at, key = at[block], key[block]
                number = (at - w.first()[w.doc[at]]) // size
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(lay.cut(key).astype(np.int64)), pa.array(row[lo + w.doc[at]]),
                        pa.array(number.astype(np.int32)),
                    ],
                    names=["key", "_row", "number"],
                )

    return run


def _windows(w, doc: int, first: np.ndarray, anchors: np.ndarray, size: int, window: int) -> np.ndarray:
    """Starts (words of the document) of the windows that hold an anchor."""
    n = int(first[doc + 1] - first[doc])
    change = np.zeros(n + 2, np.int64)
    at = anchors.astype(np.int64) * size
    np.add.at(change, np.maximum(0, at + size - window), 1)
    np.add.at(change, at + 1, -1)
    start = np.flatnonzero(np.cumsum(change[:n]) > 0)
    return start[start + window <= n]


def _kept(data: bytes, n: int, gone: np.ndarray | None) -> tuple[int, int, str]:
    words = data.split()
    removed = 0
    if gone is not None:
        removed = int(gone.sum())
        words = list(compress(words, (~gone).tolist()))
    return n, removed, hashlib.sha256(b" ".join(words)).hexdigest()


_DONE = "doc_id long, n_words long, n_removed long, kept_sha256 string"
_PACKED = _DONE + ", block long, ids array<long>, texts array<string>, anchors array<array<int>>"


def _sort_out(size: int, window: int):
    """Documents without a window to ask for are done; the others are put together in blocks of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = 0
        part = TaskContext.get().partitionId()
        schema = pa.schema(
            [
                ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
                ("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("texts", pa.list_(pa.string())),
                ("anchors", pa.list_(pa.list_(pa.int32()))),
            ]
        )
        for batch in batches:
            column, ids = batch.column(batch.schema.names.index("text")), batch.column("doc_id").to_pylist()
            anchors = batch.column("anchors").to_pylist()
            for lo, hi, w in sliced_words(column, limit=BLOCK_TEXT_BYTES):
                n, rows, ask = w.counts.tolist(), [], ([], [], [])
                for i in range(hi - lo):
                    text = w.text(i)
                    if anchors[lo + i] and n[i] >= window:
                        for x, v in zip(ask, (ids[lo + i], text.decode(), anchors[lo + i]), strict=True):
                            x.append(v)
                    else:
                        rows.append((ids[lo + i], *_kept(text, n[i], None), None, None, None, None))
                if ask[0]:
                    rows.append((None, None, None, None, (part << 32) + count, *ask))
                    count += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
                )

    return run


def _asked(texts: list[str], anchors: list[list[int]], size: int, window: int):
    """Words of a block's documents and the windows they ask for: places (of the first word) and keys, sorted by key."""
    data, bounds = raw(pa.array(texts, pa.string()))
    from popscan.llm.textual import words_of

    w = words_of(data, bounds)
    first = w.first()
    at, key = w.grams(window)
    want = [
        first[i] + _windows(w, i, first, np.unique(np.array(a)), size, window) for i, a in enumerate(anchors)
    ]
    want = np.concatenate(want) if want else np.empty(0, np.int64)
    key = key[np.searchsorted(at, want)]
    order = np.argsort(key, kind="stable")
    return w, first, want[order], key[order]


def _ask(size: int, window: int, lay: Layout):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.column("block")[i].as_py()
                _, _, _, key = _asked(batch.column("texts")[i].as_py(), batch.column("anchors")[i].as_py(), size, window)
                first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
                twice = np.diff(np.r_[first, len(key)]) > 1
                unique = key[first]
                rows = [(b, block, encode(unique[lo:hi]), bits_to_bytes(twice[lo:hi])) for b, lo, hi in lay.runs(unique)]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in zip(*rows, strict=True)], names=["bucket", "block", "keys", "twice"]
                    )

    return run


def _answer(table: pa.Table) -> pa.Table:
    """For each block that asked in this bucket, one bit per key: does it have a second start?"""
    parts = [decode(x.as_py()) for x in table.column("keys")]
    key = np.concatenate(parts)
    twice = np.concatenate([bytes_to_bits(x.as_py(), len(p)) for x, p in zip(table.column("twice"), parts, strict=True)])
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    times = np.diff(np.r_[first, len(key)])
    again = (times > 1) | np.logical_or.reduceat(twice[order], first)
    bits = np.empty(len(key), bool)
    bits[order] = np.repeat(again, times)
    edges = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    return pa.table(
        {
            "block": table.column("block").combine_chunks(),
            "bucket": table.column("bucket").combine_chunks(),
            "bits": pa.array([bits_to_bytes(bits[a:b]) for a, b in zip(edges, edges[1:], strict=False)], pa.binary()),
        }
    )


def _remove(size: int, window: int, lay: Layout):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, texts = batch.column("ids")[i].as_py(), batch.column("texts")[i].as_py()
                w, first, want, key = _asked(texts, batch.column("anchors")[i].as_py(), size, window)
                answers = {a["bucket"]: a["bits"] for a in batch.column("answers")[i].as_py() or ()}
                edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
                unique = key[edge]
                again = np.zeros(len(unique), bool)
                for b, lo, hi in lay.runs(unique):
                    again[lo:hi] = bytes_to_bits(answers[b], hi - lo)
                repeat = want[np.repeat(again, np.diff(np.r_[edge, len(key)]))]
                change = np.zeros(len(w.hash) + 1, np.int64)
                np.add.at(change, repeat, 1)
                np.add.at(change, repeat + window, -1)
                gone = np.cumsum(change[:-1]) > 0
                rows = [
                    (ids[d], *_kept(w.text(d), int(first[d + 1] - first[d]), gone[first[d] : first[d + 1]]))
                    for d in range(len(ids))
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(c, k)
                        for c, k in zip(zip(*rows, strict=True), (pa.int64(),) * 3 + (pa.string(),), strict=True)
                    ],
                    names=["doc_id", "n_words", "n_removed", "kept_sha256"],
                )

    return run


def anchors_of(documents: DataFrame, window: int, n_bytes: int) -> DataFrame:
    """``_row, anchors``: the reference blocks of each document that are found anywhere else."""
    size = (window + 1) // 2
    lay = layout(n_bytes)
    probes = documents.select("text").mapInArrow(
        _probe("text", size, lay), "bucket long, keys binary, blocks binary, twice binary"
    )
    found = probes.groupBy("bucket").applyInArrow(_found_blocks, "key long")
    blocks = documents.select("_row", "text").mapInArrow(_reference(size, lay), "key long, _row long, number int")
    return blocks.join(found, "key").groupBy("_row").agg(F.collect_list("number").alias("anchors"))


def remove_repeats(documents: DataFrame, window: int = 35) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of each document, without the words of repeated windows."""
    size = (window + 1) // 2
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("doc_id", "text").alias("_row")
    )  # equal rows share a row key: their anchors are the same
    n_bytes = total_bytes(docs)
    anchors = anchors_of(docs, window, n_bytes).select(
        F.col("_row"), F.array_distinct("anchors").alias("anchors")
    )
    sorted_out = stored(
        docs.join(anchors, "_row", "left").select("doc_id", "text", "anchors").mapInArrow(_sort_out(size, window), _PACKED),
        "anchored",
    )
    lay = Layout(64, layout(n_bytes).bucket_bits)
    asking = sorted_out.filter("block IS NOT NULL").select("block", "ids", "texts", "anchors")
    asked = asking.select("block", "texts", "anchors").mapInArrow(
        _ask(size, window, lay), "bucket long, block long, keys binary, twice binary"
    )
    answered = asked.groupBy("bucket").applyInArrow(_answer, "block long, bucket long, bits binary")
    by_block = answered.groupBy("block").agg(F.collect_list(F.struct("bucket", "bits")).alias("answers"))
    cut = asking.join(by_block, "block", "left").mapInArrow(_remove(size, window, lay), _DONE)
    done = sorted_out.filter("block IS NULL").select("doc_id", "n_words", "n_removed", "kept_sha256")
    return done.unionByName(cut)
