"""Stupid-backoff scores of all documents under n-gram counts of the same corpus.

The corpus is cut into blocks of documents. Each block explodes its n-grams of every order up to ``order``, adds up
equal ones, and sends them to the count tables, which are partitioned by the n-gram's hash: a partition adds the blocks'
counts and joins the totals back to the blocks that asked, where several did; else the block's own count is the total. A block then scores each word (the highest order whose
n-gram has at least ``min_count`` occurrences, each step down costing ``alpha``) and sums logarithms per document.

An n-gram crosses the shuffle once per block, packed (:mod:`popscan.llm.packed`), so a word or word pair that makes up
a third of the corpus is one entry per block, and its partition holds no more rows than others. Keys keep 20 bits more
than the corpus size has, so an n-gram shares its counter with another with a probability under one in a million.

Defined results: a null or empty text has no words and the sum 0; the first words of a text are scored by the orders
they have room for; rows that repeat count as often as they stand, ids null or equal included; other columns do not
reach the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popscan.llm.packed import Layout, bits_to_bytes, bytes_to_bits, decode, encode, layout, total_bytes
from popscan.llm.storage import stored_by
from popscan.llm.textual import Words, bytes_list, mix, raw, slices, words_of

BLOCK_BYTES = 4 << 20
_BLOCKS = "block long, ids array<long>, texts array<string>"


def blocks(documents: DataFrame, size: int = BLOCK_BYTES) -> DataFrame:
    """Documents put together in rows of about ``size`` bytes of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, part = 0, TaskContext.get().partitionId()
        schema = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("texts", pa.list_(pa.string()))])
        ids: list = []
        texts: list[str] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal count, held
            row = {"block": (part << 32) + count, "ids": list(ids), "texts": list(texts)}
            count += 1
            ids.clear()
            texts.clear()
            held = 0
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for lo, hi, data, bounds in slices(batch.column("text"), size // 4):
                ids += names[lo:hi]
                texts += [t.decode() for t in bytes_list(data, bounds)]
                held += len(data)
                if held >= size:
                    yield flush()
        if ids:
            yield flush()

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _BLOCKS)


def narrow(counts: np.ndarray) -> bytes:
    """Counts in a byte each, those of 255 and more behind them."""
    large = counts[counts >= 255].astype("<u8")
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + large.tobytes()


def widen(blob: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(blob, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(blob, "<u8", offset=n).astype(np.int64)
    return out


def _block_grams(texts: list[str], order: int, lay: Layout) -> tuple[Words, list, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a block; for each order the places and the index of their key; the distinct keys and their counts."""
    w = words_of(*raw(pa.array(texts, pa.string())))
    places, keys = [], []
    for n in range(1, order + 1):
        at, key = w.grams(n)
        places.append(at)
        keys.append(lay.cut(mix(key + np.uint64(n))))
    unique, index, counts = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
    edges = np.cumsum([len(k) for k in keys])[:-1]
    return w, list(zip(places, np.split(index, edges), strict=True)), unique, counts, index


def _ask(order: int, lay: Layout):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.column("block")[i].as_py()
                _, _, key, count, _ = _block_grams(batch.column("texts")[i].as_py(), order, lay)
                rows = [(b, block, encode(key[lo:hi]), narrow(count[lo:hi])) for b, lo, hi in lay.runs(key)]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in zip(*rows, strict=True)], names=["bucket", "block", "keys", "counts"]
                    )

    return run


def _tables(table: pa.Table) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
    parts = [decode(x.as_py()) for x in table.column("keys")]
    counts = [widen(x.as_py(), len(p)) for x, p in zip(table.column("counts"), parts, strict=True)]
    key, index = np.unique(np.concatenate(parts), return_inverse=True)
    return [len(p) for p in parts], key, np.bincount(index, np.concatenate(counts)).astype(np.int64), index


def _join(table: pa.Table) -> pa.Table:
    """Totals of a bucket's n-grams that several blocks sent, for each block as flags and counts in the order in which it asked."""
    sizes, _, total, index = _tables(table)
    edges = np.concatenate(([0], np.cumsum(sizes)))
    answer, shared = total[index], np.bincount(index)[index] > 1
    told = [bits_to_bytes(shared[a:b]) + narrow(answer[a:b][shared[a:b]]) for a, b in zip(edges, edges[1:], strict=False)]
    return pa.table(
        {
            "block": table.column("block").combine_chunks(),
            "bucket": table.column("bucket").combine_chunks(),
            "totals": pa.array(told, pa.binary()),
        }
    )


def _score(order: int, lay: Layout, n_words: int, min_count: int, alpha: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, texts = batch.column("ids")[i].as_py(), batch.column("texts")[i].as_py()
                w, orders, key, own, _ = _block_grams(texts, order, lay)
                total = own.astype(np.int64)
                given = {a["bucket"]: a["totals"] for a in batch.column("answers")[i].as_py() or ()}
                for b, lo, hi in lay.runs(key):
                    split = (hi - lo + 7) // 8
                    at = lo + np.flatnonzero(bytes_to_bits(given[b][:split], hi - lo))
                    if len(at):
                        total[at] = widen(given[b][split:], len(at))
                logs = np.zeros(len(w.hash))
                done = np.zeros(len(w.hash), bool)
                place = np.arange(len(w.hash)) - w.first()[w.doc]
                for n in range(order, 0, -1):
                    at, index = orders[n - 1]
                    last = at + n - 1  # the word that an n-gram scores
                    count = total[index]
                    use = ~done[last] & ((count >= min_count) if n > 1 else np.ones(len(at), bool))
                    last, at, count = last[use], at[use], count[use]
                    if n > 1:
                        before = np.zeros(len(w.hash), np.int64)
                        before[orders[n - 2][0]] = total[orders[n - 2][1]]
                        ratio = count / before[at]
                    else:
                        ratio = count / n_words
                    steps = np.minimum(order, place[last] + 1) - n
                    logs[last] = np.log(ratio) + steps * np.log(alpha)
                    done[last] = True
                sums = np.bincount(w.doc, logs, minlength=len(ids)).astype(float)  # without words it counts integers
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(w.counts.astype(np.int64)), pa.array(sums)],
                    names=["doc_id", "n_words", "log_score"],
                )

    return run


def count_table(documents: DataFrame, order: int = 2) -> DataFrame:
    """``bucket, n_grams, occurrences``: sizes of the count tables' partitions."""
    lay = layout(total_bytes(documents), slack=20)

    def sizes(table: pa.Table) -> pa.Table:
        _, key, total, _ = _tables(table)
        return pa.table({"bucket": table.column("bucket")[:1].combine_chunks(), "n_grams": [len(key)], "occurrences": [int(total.sum())]})

    asked = blocks(documents).select("block", "texts").mapInArrow(_ask(order, lay), "bucket long, block long, keys binary, counts binary")
    return asked.groupBy("bucket").applyInArrow(sizes, "bucket long, n_grams long, occurrences long")


def score(documents: DataFrame, order: int = 2, min_count: int = 2, alpha: float = 0.4) -> DataFrame:
    """``doc_id, n_words, log_score`` of each document: the sum of its words' logarithmic scores."""
    lay = layout(total_bytes(documents), slack=20)
    held = stored_by(blocks(documents), "blocks", "block")  # so texts are not shuffled to meet their answers
    asked = held.select("block", "texts").mapInArrow(_ask(order, lay), "bucket long, block long, keys binary, counts binary")
    answered = asked.groupBy("bucket").applyInArrow(_join, "block long, bucket long, totals binary")
    answers = answered.groupBy("block").agg(F.collect_list(F.struct("bucket", "totals")).alias("answers"))
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    n_words = documents.agg(F.sum(words).alias("n")).first()["n"] or 0
    return held.join(answers, "block", "left").mapInArrow(
        _score(order, lay, n_words, min_count, alpha), "doc_id long, n_words long, log_score double"
    )


#: Rows in DuckDB with order 3, as the query registers it, and the other options of :func:`score`.
ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
word AS (
  SELECT doc_id, i, w[i] AS word, CASE WHEN i > 1 THEN w[i - 1] END AS prev, CASE WHEN i > 2 THEN w[i - 2] END AS before
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM w)),
one AS (SELECT word, count(*) AS n FROM word GROUP BY 1),
two AS (SELECT prev, word, count(*) AS n FROM word WHERE i > 1 GROUP BY 1, 2),
three AS (SELECT before, prev, word, count(*) AS n FROM word WHERE i > 2 GROUP BY 1, 2, 3),
scored AS (
  SELECT doc_id, CASE
    WHEN three.n >= 2 THEN ln(three.n / pair.n)
    WHEN two.n >= 2 THEN ln(two.n / p.n) + CASE WHEN i > 2 THEN ln(0.4) ELSE 0 END
    ELSE ln(one.n / (SELECT count(*) FROM word)) + least(i - 1, 2) * ln(0.4) END AS s
  FROM word JOIN one ON one.word = word.word LEFT JOIN one p ON p.word = word.prev
  LEFT JOIN two ON two.prev = word.prev AND two.word = word.word
  LEFT JOIN two pair ON pair.prev = word.before AND pair.word = word.prev
  LEFT JOIN three ON three.before = word.before AND three.prev = word.prev AND three.word = word.word)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, round(coalesce(s, 0), 4) AS log_score
FROM w LEFT JOIN (SELECT doc_id, sum(s) AS s FROM scored GROUP BY 1) USING (doc_id)
"""
