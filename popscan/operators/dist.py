"""Distributions: count, min, max, mean, sample deviation and exact quantiles per stratum.

Both quantile rules read the value at a rank:

* cumulative: the smallest value whose cumulative count reaches q*N, rank
  ceil(q*N);
* legacy: the largest value whose row number is at most q*(N+1), rank
  floor(q*(N+1)), and -9999 where no row qualifies.

Rows are never ranked. For values from a small range (ages, days, counts) they
are reduced to a histogram (stratum, value, n) with map-side combine, and ranks
are read off its running sum. For free numbers (costs, lab values) a histogram
is as large as the input, so ranks are located in two steps, at any size of the
input: order-keeping buckets, which combine on the map side, then the values of
the at most five buckets that hold a rank. Only their rows are shuffled, and no
task sees more than one bucket's values, however large the stratum.

NaN sorts behind infinity and before NULL, counts in N like any value, and is
the largest value where it occurs. Mean and deviation follow IEEE arithmetic:
NaN with a NaN value; with an infinite one the mean is infinite (NaN for both
signs) and the deviation NaN.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

QUANTILES = (10, 25, 50, 75, 90)
NAMES = {10: "p10_value", 25: "p25_value", 50: "median_value", 75: "p75_value", 90: "p90_value"}
STATISTICS = (
    "min_value", "max_value", "avg_value", "stdev_value",
    "median_value", "p10_value", "p25_value", "p75_value", "p90_value",
)
SENTINEL = -9999.0  # fixed value: legacy quantile without a qualifying row

_LOG_STEPS = 32.0  # buckets per e-fold: more of them combine less on the map side, fewer hold more values
_LOG_SCALE = 1024.0  # values below 1/1024 share buckets
_LARGE = 1e300  # finite values beyond it share buckets
_INFINITE = 1 << 29  # bucket of infinity; NaN has the next one


def _int_rank(q: int, total: str, legacy: bool) -> Column:
    """The rank in integer arithmetic, free of rounding."""
    return F.expr(f"({q} * ({total} + 1)) div 100" if legacy else f"({q} * {total} + 99) div 100")


def _finish_quantile(value: Column, rank: Column, total: Column, top: Column, legacy: bool) -> Column:
    """Turn the value found at a rank into the reported quantile.

    NULL values sort last and count in N; a rank that falls on them yields the
    largest value. The legacy rule takes a maximum over qualifying rows and
    sentinels, so a lower value gives way to the sentinel as long as some row
    does not qualify.
    """
    reached = F.coalesce(value, top)
    if not legacy:
        return reached
    return (
        F.when(total.isNull(), None)
        .when(rank < 1, F.lit(SENTINEL))
        .when(rank >= total, reached)
        .otherwise(F.greatest(reached, F.lit(SENTINEL)))
    )


def histogram(df: DataFrame, strata: Sequence[str], value: str, weight: str | None = None) -> DataFrame:
    """``strata, v, n``: how often each value occurs."""
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(*strata, F.col(value).cast("double").alias("v")).agg(n.alias("n"))


def _same(strata: Sequence[str], left: str, right: str) -> Column:
    pairs = [F.col(f"{left}.{s}").eqNullSafe(F.col(f"{right}.{s}")) for s in strata]
    return reduce(lambda a, b: a & b, pairs, F.lit(True))


def _equal(strata: Sequence[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{s}") == F.col(f"{right}.{s}") for s in strata], F.lit(True))


def _from_window(hist: DataFrame, strata: Sequence[str], legacy: bool) -> DataFrame:
    """One running sum per stratum over its histogram."""
    stratum = W.partitionBy(*strata)
    running = stratum.orderBy(F.col("v").asc_nulls_last()).rowsBetween(W.unboundedPreceding, W.currentRow)
    known = F.when(F.col("v").isNotNull(), F.col("n")).otherwise(0)
    ranked = hist.select(
        *strata, "v", "n",
        F.sum("n").over(running).alias("cum"),
        F.sum("n").over(stratum).alias("total"),
        F.sum(known).over(stratum).alias("known"),
        (F.sum(F.col("v") * F.col("n")).over(stratum)).alias("vsum"),
    )
    mean = F.col("vsum") / F.nullif(F.col("known"), F.lit(0))
    ranked = ranked.withColumn("dev", F.col("n") * (F.col("v") - mean) * (F.col("v") - mean))
    found = [
        F.min(F.when(F.col("cum") >= _int_rank(q, "total", legacy), F.col("v"))).alias(f"at{q}")
        for q in QUANTILES
    ]
    return ranked.groupBy(*strata).agg(
        F.max("total").alias("total"),
        F.max("known").alias("known"),
        F.min("v").alias("min_value"),
        F.max("v").alias("max_value"),
        F.max(mean).alias("avg_value"),
        F.sum("dev").alias("dev"),
        *found,
    )


def _bucket(v: Column) -> Column:
    """An order-keeping bucket number: even steps of the logarithm, sign kept; infinities and NaN have their own."""
    size = F.least(F.abs(v), F.lit(_LARGE))
    return (
        F.when(F.isnan(v), F.lit(_INFINITE + 1))
        .when(F.abs(v) == float("inf"), F.signum(v).cast("int") * _INFINITE)
        .otherwise((F.signum(v) * F.lit(_LOG_STEPS) * F.log1p(size * F.lit(_LOG_SCALE))).cast("int"))
    )


def _located(ranges: DataFrame, ranks: Column) -> DataFrame:
    """Explode the ranks that fall into each range; ranges carry ``cum`` and ``n``."""
    before = F.col("cum") - F.col("n")
    return (
        ranges.withColumn("q", F.explode(ranks))
        .filter((F.col("q.rank") > before) & (F.col("q.rank") <= F.col("cum")))
        .withColumn("rest", F.col("q.rank") - before)
        .withColumn("q", F.col("q.q"))
        .drop("cum", "n")
    )


def _from_buckets(rows: DataFrame, strata: Sequence[str], legacy: bool, weighted: bool) -> DataFrame:
    """Locate each rank by bucket and value; see the module text. ``rows`` hold ``strata, v`` and, if weighted, ``n``."""
    values, rows = rows, rows.withColumn("b", _bucket(F.col("v")))
    if weighted:
        # deviations from a fixed point in the bucket stay accurate for large values
        finite = F.abs(F.col("b")) < _INFINITE
        point = F.when(
            finite, F.signum(F.col("b")) * F.expm1(F.abs(F.col("b")) / F.lit(_LOG_STEPS)) / F.lit(_LOG_SCALE)
        ).otherwise(F.when(F.col("b").isNotNull(), 0.0))
        off = F.col("v") - point
        n, known = F.sum("n"), F.sum(F.when(F.col("v").isNotNull(), F.col("n")).otherwise(0))
        s1 = F.sum(off * F.col("n"))
        m2 = F.sum(off * off * F.col("n")) - s1 * s1 / F.nullif(known, F.lit(0))
    else:  # deviations from the running mean are as accurate, and each row is spared the point
        n, known, point, s1 = F.count(F.lit(1)), F.count("v"), F.lit(0.0), F.sum("v")
        m2 = F.var_pop("v") * known
    measures = {"n": n, "known": known, "low": F.min("v"), "high": F.max("v"), "s1": s1, "m2": m2}
    buckets = rows.groupBy(*strata, "b").agg(*[c.alias(name) for name, c in measures.items()])
    # statistics and ranks each need some of the measures: gathered whole, both read one pass over the rows and its
    # exchange, where each would have a pass of its own without the measures it leaves out
    whole = F.collect_list(F.struct("b", *measures)).alias("buckets")
    buckets = buckets.groupBy(*strata).agg(whole).select(*strata, F.inline("buckets"))
    by_bucket = W.partitionBy(*strata)
    running = by_bucket.orderBy(F.col("b").asc_nulls_last()).rowsBetween(W.unboundedPreceding, W.currentRow)
    centre = point * F.col("known") + F.col("s1")
    buckets = buckets.select(
        *strata, "b", "n", "known", "low", "high", "s1", "m2",
        F.sum("n").over(running).alias("cum"),
        F.sum("n").over(by_bucket).alias("total"),
        (F.sum(centre).over(by_bucket) / F.nullif(F.sum("known").over(by_bucket), F.lit(0))).alias("mean"),
    )
    shift = F.col("mean") - point - F.col("s1") / F.nullif(F.col("known"), F.lit(0))
    dev = F.col("m2") + F.col("known") * shift * shift
    stats = buckets.groupBy(*strata).agg(
        F.max("total").alias("total"),
        F.sum("known").alias("known"),
        F.min("low").alias("min_value"),
        F.max("high").alias("max_value"),
        F.max("mean").alias("avg_value"),
        F.sum(dev).alias("dev"),
    )
    ranks = F.array(
        *[F.struct(F.lit(q).alias("q"), _int_rank(q, "total", legacy).alias("rank")) for q in QUANTILES]
    )
    found = buckets.filter(F.col("b").isNotNull()).select(*strata, "b", "low", "high", "n", "cum", "total")
    in_bucket = _located(found, ranks)

    keys = [*strata, "b"]
    # strata without null need no null-safe comparison, which would double the keys that every row is looked up by
    same = _same if legacy else _equal
    wanted = in_bucket.groupBy(*keys).agg(
        F.first("low").alias("low"), F.first("high").alias("high"),
        F.collect_list(F.struct("q", F.col("rest").alias("rank"))).alias("ranks"),  # at most five
    )
    # five rows a stratum at most, no more than the result has: held against the rows where they lie; a bucket keeps the
    # order, so its lowest and highest value tell its rows, and only those are given their bucket again
    reach = F.col("h.v").between(F.col("p.low"), F.col("p.high"))
    near = (
        values.alias("h")
        .join(F.broadcast(wanted.select(*strata, "low", "high")).alias("p"), same(strata, "h", "p") & reach, "left_semi")
        .withColumn("b", _bucket(F.col("v")))
    )
    hist = histogram(near, keys, "v", "n" if weighted else None)
    in_reach = (
        hist.alias("h")
        .join(wanted.alias("p"), same(keys, "h", "p"))
        .select(*[F.col(f"h.{k}") for k in keys], "h.v", "h.n", "p.ranks")
    )
    running = W.partitionBy(*keys).orderBy("v").rowsBetween(W.unboundedPreceding, W.currentRow)
    hits = (
        in_reach.withColumn("cum", F.sum("n").over(running))
        .withColumn("q", F.explode("ranks"))
        .filter((F.col("q.rank") > F.col("cum") - F.col("n")) & (F.col("q.rank") <= F.col("cum")))
    )
    found = hits.groupBy(*strata).agg(
        *[F.max(F.when(F.col("q.q") == q, F.col("v"))).alias(f"at{q}") for q in QUANTILES]
    )
    return (
        stats.alias("s")
        .join(found.alias("f"), _same(strata, "s", "f"), "left")
        .select("s.*", *[F.col(f"f.at{q}") for q in QUANTILES])
    )


def distribution(
    df: DataFrame,
    strata: Sequence[str],
    value: str,
    *,
    weight: str | None = None,
    legacy: bool = False,
    bounded: bool = True,
) -> DataFrame:
    """``strata, count_value`` and the statistics of ``value``.

    ``bounded`` states that the values come from a small range, so that a
    stratum's histogram fits a task; otherwise ranks are located by buckets.
    NULL strata are dropped under the cumulative rule and kept under the legacy
    rule; the legacy count leaves NULL values out.
    """
    if not legacy:
        for s in strata:
            df = df.filter(F.col(s).isNotNull())
    if bounded:
        stats = _from_window(histogram(df, strata, value, weight), strata, legacy)
    else:
        counted = [] if weight is None else [F.col(weight).alias("n")]
        rows = df.select(*strata, F.col(value).cast("double").alias("v"), *counted)
        stats = _from_buckets(rows, strata, legacy, weight is not None)
    if not strata and not legacy:
        stats = stats.filter(F.col("total") > 0)
    deviation = F.when(F.col("known") > 1, F.sqrt(F.greatest(F.col("dev"), F.lit(0.0)) / (F.col("known") - 1)))
    total = F.coalesce(F.col("total"), F.lit(0))
    quantiles = {
        NAMES[q]: _finish_quantile(
            F.col(f"at{q}"), _int_rank(q, "total", legacy), F.col("total"), F.col("max_value"), legacy
        )
        for q in QUANTILES
    }
    columns = {
        "min_value": F.col("min_value"),
        "max_value": F.col("max_value"),
        "avg_value": F.col("avg_value"),
        "stdev_value": deviation,
        **quantiles,
    }
    return stats.select(
        *strata,
        (F.col("known") if legacy else total).cast("long").alias("count_value"),
        *[columns[name].cast("double").alias(name) for name in STATISTICS],
    )
