"""Quality classifier: a byte-level convolutional network in numpy.

A text's bytes are read at every second position by learned filters, six bytes wide. Activations are max-pooled over
overlapping chunks (two neighbouring blocks of 128 bytes) that cover the whole document; the chunk maxima are averaged
and max-pooled over the document, and a logistic layer turns both into one probability. Training runs on the driver
over a bounded sample of labelled rows (``max_documents`` rows of at most ``max_bytes`` each, drawn by a hash of the
id); scoring runs in Arrow batches over every whole text.

Defined results: a null or empty text has no chunk and gets the probability of the bias alone; rows are scored one by
one, so repeated rows, repeated ids and null ids keep their row; labels that are null are not learned from; with one
class (or none) to learn from, every row gets the share of label 1 (0.5 without any). Other columns pass untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from popscan.llm.textual import raw, slices

WIDTH, STEP, BLOCK = 6, 2, 64  # bytes of a filter, bytes between positions, positions of a block
_LOW = np.float32(-1e9)


@dataclass
class Network:
    taps: np.ndarray  # (WIDTH, 256, filters)
    weights: np.ndarray  # (2 * filters): of the mean and of the maximum over chunks
    bias: float


@dataclass
class _Laid:
    """Texts laid out in whole blocks: each begins on a block of its own."""

    data: np.ndarray  # padded bytes
    live: np.ndarray  # positions inside a text
    first: np.ndarray  # first block of each non-empty text, one more than these
    texts: np.ndarray  # index of each non-empty text


def _lay(data: np.ndarray, bounds: np.ndarray) -> _Laid:
    sizes = np.diff(bounds)
    texts = np.flatnonzero(sizes)
    sizes = sizes[texts]
    span = BLOCK * STEP
    blocks = -(-sizes // span)
    first = np.concatenate(([0], np.cumsum(blocks)))
    out = np.zeros(int(first[-1]) * span + WIDTH, np.uint8)
    shift = first[:-1] * span - bounds[:-1][texts]
    at = np.arange(len(data)) + np.repeat(shift, sizes)
    out[at] = data
    live = np.zeros(len(out), bool)
    live[at] = True
    return _Laid(out, live[: int(first[-1]) * span : STEP], first, texts)


def _pairs(taps: np.ndarray) -> list[np.ndarray]:
    """Tables over two bytes at once: half the look-ups."""
    return [
        np.ascontiguousarray((taps[j][:, None, :] + taps[j + 1][None, :, :]).reshape(65536, -1), np.float32)
        for j in range(0, WIDTH, 2)
    ]


def _activations(laid: _Laid, tables: list[np.ndarray]) -> np.ndarray:
    n = len(laid.live)
    code = laid.data[:-1].astype(np.int32) * 256 + laid.data[1:]
    out = tables[0][code[0 : n * STEP : STEP]]
    for k in range(1, WIDTH // 2):
        out += tables[k][code[2 * k : 2 * k + n * STEP : STEP]]
    out[~laid.live] = _LOW
    return out


def _chunks(laid: _Laid) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Both blocks of each chunk, and the first chunk of each text (one more than texts)."""
    blocks = np.diff(laid.first)
    chunks = np.maximum(1, blocks - 1)
    first = np.concatenate(([0], np.cumsum(chunks)))
    left = np.arange(first[-1]) + np.repeat(laid.first[:-1] - first[:-1], chunks)
    return left, left + np.repeat((blocks > 1).astype(np.int64), chunks), first


def _forward(net: Network, laid: _Laid, tables: list[np.ndarray]) -> np.ndarray:
    act = _activations(laid, tables)
    block = np.maximum(act.reshape(-1, BLOCK, act.shape[1]).max(1), 0)
    left, right, first = _chunks(laid)
    chunk = np.maximum(block[left], block[right])
    mean = np.add.reduceat(chunk, first[:-1], axis=0) / np.diff(first)[:, None]
    return np.hstack([mean, np.maximum.reduceat(chunk, first[:-1], axis=0)]) @ net.weights + net.bias


def probabilities(net: Network, data: np.ndarray, bounds: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
    logits = np.full(len(bounds) - 1, net.bias, np.float64)
    laid = _lay(data, bounds)
    if len(laid.texts):
        logits[laid.texts] = _forward(net, laid, tables)
    return 1 / (1 + np.exp(-np.clip(logits, -50, 50)))


def _gradients(net: Network, laid: _Laid, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    act = _activations(laid, _pairs(net.taps))
    k = act.shape[1]
    by_block = act.reshape(-1, BLOCK, k)
    where = by_block.argmax(1)
    block = np.maximum(np.take_along_axis(by_block, where[:, None, :], 1)[:, 0], 0)
    left, right, first = _chunks(laid)
    take = block[left] >= block[right]
    chunk = np.where(take, block[left], block[right])
    n = np.diff(first)
    mean = np.add.reduceat(chunk, first[:-1], axis=0) / n[:, None]
    top = np.maximum.reduceat(chunk, first[:-1], axis=0)
    feats = np.hstack([mean, top])
    p = 1 / (1 + np.exp(-np.clip(feats @ net.weights + net.bias, -50, 50)))
    error = (p - y) * weight / len(y)
    g_chunk = np.repeat(error / n, n)[:, None] * net.weights[:k]
    is_top = chunk == np.repeat(top, n, axis=0)
    ties = np.add.reduceat(is_top, first[:-1], axis=0)
    g_chunk = g_chunk + is_top * np.repeat(error[:, None] * net.weights[k:] / ties, n, axis=0)
    g_block = np.zeros_like(block)
    np.add.at(g_block, left, np.where(take, g_chunk, 0))
    np.add.at(g_block, right, np.where(take, 0, g_chunk))
    g_block[block <= 0] = 0
    rows, cols = np.nonzero(g_block)
    at = (rows * BLOCK + where[rows, cols]) * STEP
    taps = np.zeros_like(net.taps)
    for j in range(WIDTH):
        np.add.at(taps[j], (laid.data[at + j], cols), g_block[rows, cols])
    return taps, feats.T @ error, float(error.sum())


def fit(
    texts: list[bytes], labels: np.ndarray, filters: int = 12, epochs: int = 14, batch: int = 128, rate: float = 0.02,
    decay: float = 1e-4, seed: int = 7,
) -> Network:
    """Train by Adam on the log loss; both classes weigh the same in a step, the bias then restores their share."""
    rng = np.random.default_rng(seed)
    y = np.asarray(labels, np.float64)
    share = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    prior = float(np.log(share / (1 - share)))
    net = Network(rng.normal(0, 0.05, (WIDTH, 256, filters)).astype(np.float32), rng.normal(0, 0.3, 2 * filters), 0.0)
    if len(set(y.tolist())) < 2:
        return Network(np.zeros_like(net.taps), np.zeros(2 * filters), prior if len(y) else 0.0)
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (net.taps, net.weights, np.zeros(1))]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for lo in range(0, len(texts), batch):
            pick = [i for i in order[lo : lo + batch].tolist() if texts[i]]
            if not pick:
                continue
            bounds = np.concatenate(([0], np.cumsum([len(texts[i]) for i in pick])))
            laid = _lay(np.frombuffer(b"".join(texts[i] for i in pick), np.uint8), bounds)
            taps, weights, bias = _gradients(net, laid, y[pick], weight[pick])
            step += 1
            now = rate * (1 - epoch / epochs)
            for x, g, (m, v) in zip((net.taps, net.weights), (taps, weights), state, strict=False):
                g = g + decay * x
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                x -= (now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(x.dtype)
            net.bias -= now * bias
    return Network(net.taps, net.weights, net.bias + prior)


def sample(
    documents: DataFrame, labels: DataFrame, label: str, max_documents: int, max_bytes: int
) -> tuple[list[bytes], np.ndarray]:
    """At most ``max_documents`` labelled texts, half of them of each label where there are enough, by a hash of the id."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).alias("y"))
    spread = F.xxhash64(F.col("doc_id").cast("string"))
    picked = [
        known.filter(F.col("y") == y).dropDuplicates(["doc_id"]).orderBy(spread, "doc_id").limit(max_documents // 2)
        for y in (0, 1)
    ]
    ids = F.broadcast(picked[0].unionByName(picked[1]))  # max_documents rows at most
    fits = documents.filter(F.octet_length("text") <= max_bytes).select("doc_id", "text")
    rows = fits.join(ids, "doc_id").select("doc_id", "text", "y").toPandas().sort_values(["doc_id", "text"])
    return [t.encode() for t in rows["text"]], rows["y"].to_numpy()


def train(
    documents: DataFrame, labels: DataFrame, label: str = "quality", max_documents: int = 1600,
    max_bytes: int = 16384, **options,
) -> Network:
    texts, y = sample(documents, labels, label, max_documents, max_bytes)
    return fit(texts, y, **options)


def score(documents: DataFrame, net: Network, into: str = "score") -> DataFrame:
    """``documents`` with column ``into``: the probability of label 1 of each whole text; replaces a column of that name."""
    documents = documents.drop(into)
    at = documents.columns.index("text")
    schema = StructType([*documents.schema.fields, StructField(into, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _pairs(net.taps)
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for lo, hi, data, bounds in slices(batch.column(at), 1 << 20):
                out[lo:hi] = probabilities(net, data, bounds, tables)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out)], names=[*(f.name for f in batch.schema), into]
            )

    return documents.mapInArrow(run, schema)


__all__ = ["Network", "fit", "probabilities", "raw", "sample", "score", "train"]
