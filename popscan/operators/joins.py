"""Equi-joins on keys of which a few hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARE = 0.01
TRACKED = 4096


def heavy_keys(df: DataFrame, key: str, share: float = SHARE) -> Column:
    """Keys that hold ``share`` of the rows or more, as an array: a scalar subquery of the plan it is used in.

    Found by a mergeable top-k (a frequent-items sketch per task), so no row is shuffled for it. There are at most
    ``1 / share`` such keys; counts are estimates with an error below a thousandth of the rows, so a key near the limit
    may fall on either side, which changes how it is joined and never what comes out.
    """
    most = int(1 / share) + 1
    found = df.filter(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k({key}, {most}, {max(TRACKED, 2 * most)})").alias("top"), F.count(F.lit(1)).alias("n")
    )
    large = F.filter("top", lambda t: t["count"] >= F.lit(share) * F.col("n"))
    return found.select(F.transform(large, lambda t: t["item"]).alias("keys")).scalar()


def spread_join(left: DataFrame, right: DataFrame, key: str, share: float = SHARE, salts: int | None = None) -> DataFrame:
    """Inner join of ``left`` and ``right`` on ``key`` in which no key of ``left`` is one task's work.

    Rows of heavy keys are numbered through and dealt over ``salts`` slots (twenty for each shuffle partition unless
    given), to which their partners are copied; all other keys have one slot. Heavy keys without any partner go before
    the shuffle. ``right`` should not be heavy on the same keys: each of their rows is copied ``salts`` times.
    """
    spark = left.sparkSession
    slots = salts or 20 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    heavy = heavy_keys(left, key, share)
    partners = right.filter(F.array_contains(heavy, F.col(key))).agg(F.collect_set(key).alias("keys")).scalar()
    is_heavy = F.coalesce(F.array_contains(heavy, F.col(key)), F.lit(False))
    dealt = left.filter(F.col(key).isNotNull() & (~is_heavy | F.array_contains(partners, F.col(key))))
    # numbering by position keeps a task's rows of one key on different slots
    dealt = dealt.withColumn("_slot", F.when(is_heavy, F.monotonically_increasing_id() % slots).otherwise(0).cast("int"))
    copied = right.withColumn("_slot", F.explode(F.when(is_heavy, F.sequence(F.lit(0), F.lit(slots - 1))).otherwise(F.array(F.lit(0)))))
    return dealt.join(copied, [key, "_slot"]).drop("_slot")
