"""Which 64-bit keys may be in a set: a Bloom filter of fixed size, built by Spark and tested in Arrow batches.

A filter only proposes: a key of the set always passes, others pass now and then, and whoever uses it looks at the
proposed rows exactly. Its size is the same at any input, so beyond some millions of keys more of the others pass; that
costs shuffle, never a result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_BITS = 26  # 8 MB
_SLICE = 256  # rows that are passed on together
_SHIFTS = (0, 19, 38)  # where a key's three positions begin


@dataclass(frozen=True)
class Sketch:
    words: np.ndarray  # 64 bits each

    def holds(self, keys: np.ndarray) -> np.ndarray:
        """``keys``: uint64, evenly spread over all bits."""
        out = np.ones(len(keys), bool)
        for shift in _SHIFTS:
            at = (keys >> np.uint64(shift)) & np.uint64((1 << LOG_BITS) - 1)
            out &= (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return out


def sketch(keys: DataFrame, column: str = "key") -> Sketch:
    """The filter of a long column; what reaches the driver is 2^20 words at most."""
    positions = F.array(*[F.shiftrightunsigned(column, s).bitwiseAND(F.lit((1 << LOG_BITS) - 1)) for s in _SHIFTS])
    bits = keys.filter(F.col(column).isNotNull()).select(F.explode(positions).alias("at"))
    words = bits.groupBy(F.shiftright("at", 6).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(at & 63 AS int))")).alias("bits")
    )
    table = words.toArrow()
    out = np.zeros(1 << (LOG_BITS - 6), np.uint64)
    out[np.asarray(table.column("word"))] = np.asarray(table.column("bits")).view(np.uint64)
    return Sketch(out)


def sent(keys: DataFrame, key: Column | str = "key") -> Broadcast:
    """The filter of ``key`` (evenly spread over 64 bits), sent to all tasks."""
    column = F.col(key) if isinstance(key, str) else key
    return keys.sparkSession.sparkContext.broadcast(sketch(keys.select(column.alias("key"))))


def screened(df: DataFrame, key: Column | str, known: Broadcast, inside: bool = True) -> DataFrame:
    """Rows whose ``key`` may be in the filter, or with ``inside`` false those that are certainly not; no shuffle."""
    column = F.col(key) if isinstance(key, str) else key
    keyed = df.withColumn("_sketched", column)
    at = len(df.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, _SLICE):  # so that neither side holds a second copy of a batch
                batch = whole.slice(lo, _SLICE)
                keep = known.value.holds(np.asarray(batch.column(at)).view(np.uint64)) == inside
                if keep.any():
                    yield batch.filter(pa.array(keep))

    return keyed.mapInArrow(run, keyed.schema).drop("_sketched")
