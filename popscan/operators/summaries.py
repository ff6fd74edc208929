"""Mergeable approximate summaries: sketches per stratum and month, merged over any span of months.

An option beside the exact analyses, never their default: a store of monthly sketches answers "how many persons" and
"which quantiles" for any months and any coarser strata without going back to the facts, and months that arrive later
are added by merging. Distinct persons are HyperLogLog sketches, values KLL sketches; both are built by Spark's own
aggregates, with one partial sketch per stratum and task crossing the shuffle.

Stated errors, which :func:`person_error` and :func:`rank_error` return and the registered queries hold every stratum to:
three standard errors of a merged HyperLogLog sketch with 2^bits registers, 3.12 / sqrt(2^bits); and twice the rank error
that a KLL sketch of size k keeps with 99 % confidence, 2 * 2.296 / k^0.9021 (2.6 % at k = 200). Sketches of few persons or
values are exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 12
KLL_SIZE = 200
PROBABILITIES = (0.1, 0.25, 0.5, 0.75, 0.9)


def person_error(bits: int = BITS) -> float:
    """Largest relative error that a merged person sketch is held to."""
    return 3 * 1.04 / math.sqrt(2**bits)


def rank_error(size: int = KLL_SIZE) -> float:
    """Largest difference between the rank asked for and that of the value returned, as a fraction."""
    return 2 * 2.296 / size**0.9021


def summarise(
    df: DataFrame, keys: Sequence[str], month: str, weight: str | None = None, person: str | None = None,
    value: str | None = None, bits: int = BITS, size: int = KLL_SIZE,
) -> DataFrame:
    """``keys, month, records`` and, where asked for, ``persons`` and ``quantiles`` as sketches.

    Null persons and null values enter no sketch; a month without any has an empty one.
    """
    records = F.count(F.lit(1)) if weight is None else F.coalesce(F.sum(weight), F.lit(0)).cast("long")
    out = [records.alias("records")]
    if person:
        out.append(F.hll_sketch_agg(person, bits).alias("persons"))
    if value:
        out.append(F.kll_sketch_agg_double(F.col(value).cast("double"), size).alias("quantiles"))
    return df.groupBy(*keys, F.col(month).alias("month")).agg(*out)


def merged(summaries: DataFrame, keys: Sequence[str | Column], first: int | None = None, last: int | None = None) -> DataFrame:
    """Monthly summaries put together by ``keys``, over the months ``first`` to ``last`` (``yyyymm``, both included).

    ``records`` are exact. What the result holds are sketches again, so it can be merged further.
    """
    if first is not None:
        summaries = summaries.filter(F.col("month") >= first)
    if last is not None:
        summaries = summaries.filter(F.col("month") <= last)
    out = [F.sum("records").alias("records")]
    if "persons" in summaries.columns:
        out.append(F.hll_union_agg("persons").alias("persons"))
    if "quantiles" in summaries.columns:
        out.append(F.kll_merge_agg_double("quantiles").alias("quantiles"))
    return summaries.groupBy(*keys).agg(*out)


def person_estimate(sketch: str = "persons") -> Column:
    return F.hll_sketch_estimate(sketch)


def quantile_estimates(probabilities: Sequence[float] = PROBABILITIES, sketch: str = "quantiles") -> Column:
    """The values at the given ranks, in their order; null where no value was seen."""
    ranks = F.array(*[F.lit(p) for p in probabilities])
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, ranks))


def ranks_held(
    values: DataFrame, keys: Sequence[str], value: str, estimates: DataFrame, probabilities: Sequence[float] = PROBABILITIES,
    error: float | None = None,
) -> DataFrame:
    """``keys, n, within``: do all estimates (``keys, estimates``) lie within the stated error of their rank?

    The rank of a value is an interval, from the share of smaller values to the share of values not larger.
    """
    error = rank_error() if error is None else error
    rows = values.filter(F.col(value).isNotNull()).join(estimates, list(keys))
    n = F.count(F.lit(1))
    held = F.lit(True)
    for i, p in enumerate(probabilities):
        estimate = F.element_at("estimates", i + 1)
        below, upto = F.count_if(F.col(value) < estimate), F.count_if(F.col(value) <= estimate)
        held = held & (below <= n * (p + error)) & (upto >= n * (p - error))
    return rows.groupBy(*keys).agg(n.alias("n"), held.alias("within"))
