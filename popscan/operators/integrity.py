"""Integrity checks: orphans, events outside observation, inverted dates, missing values.

Single checks are functions of one table. :func:`check_all` answers all checks of a fact table from one scan of it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from popscan.operators.counts import COUNT


def _total(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.coalesce(F.sum(column), F.lit(0)).cast("long").alias(COUNT))


def orphans(
    facts: DataFrame,
    fk: str,
    dimension: DataFrame,
    pk: str,
    weight: Column,
    keep_null_fk: bool = False,
) -> DataFrame:
    """Records whose foreign key has no parent row.

    Facts are counted per key first; the anti join then needs no further
    shuffle of the facts (the aggregation already partitions by the key) and a
    key shared by very many facts, NULL included, is a single row.
    ``keep_null_fk`` also counts records without a key.
    """
    if not keep_null_fk:
        facts = facts.filter(F.col(fk).isNotNull())
    per_key = facts.groupBy(F.col(fk).alias("fk")).agg(F.sum(weight).alias("n"))
    parents = dimension.select(F.col(pk).alias("fk"))
    return _total(per_key.join(parents, "fk", "left_anti"), "n")


def outside_period(
    events: DataFrame, date: str, periods: DataFrame, start: str, end: str
) -> DataFrame:
    """Events that fall into none of their person's periods.

    An event on day d is covered exactly when some period with start <= d ends
    on d or later, that is, when the latest end among the periods started so
    far is >= d. So periods and events are merged per person in date order and
    a running maximum answers every event in one pass: linear after the sort,
    where a range join compares each event with each period. Before that,
    events are counted per (person, day) and periods reduced to the latest end
    per (person, start), which bounds what one person can put into a task by
    the number of days.
    """
    pts = (
        events.filter(F.col("person_id").isNotNull())
        .groupBy("person_id", F.col(date).alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("person_id", "day", F.lit(1).alias("is_event"), "n", F.lit(None).cast("date").alias("until"))
    )
    spans = (
        periods.filter(
            F.col("person_id").isNotNull() & F.col(start).isNotNull() & F.col(end).isNotNull()
        )
        .groupBy("person_id", F.col(start).alias("day"))
        .agg(F.max(end).alias("until"))
        .select("person_id", "day", F.lit(0).alias("is_event"), F.lit(0).cast("long").alias("n"), "until")
    )
    # a period starting on the day of an event counts: periods sort before events
    so_far = (
        W.partitionBy("person_id").orderBy("day", "is_event").rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    merged = pts.unionByName(spans).withColumn("covered_until", F.max("until").over(so_far))
    outside = merged.filter(
        (F.col("is_event") == 1)
        & (F.col("day").isNull() | F.col("covered_until").isNull() | (F.col("covered_until") < F.col("day")))
    )
    return _total(outside, "n")


def outside_period_clustered(days: DataFrame, periods: DataFrame, start: str, end: str) -> DataFrame:
    """The same count over tables clustered by person: ``person_id, day, n`` and periods.

    Nothing is merged in date order, which would take an exchange: each person's periods, few of them, meet the person's
    days where both lie.
    """
    dated = periods.filter(F.col("person_id").isNotNull() & F.col(start).isNotNull() & F.col(end).isNotNull())
    held = dated.groupBy("person_id").agg(F.collect_set(F.struct(F.col(start).alias("first"), F.col(end).alias("last"))).alias("periods"))
    joined = days.filter(F.col("person_id").isNotNull()).join(held, "person_id", "left")
    covered = F.exists("periods", lambda p: F.col("day").between(p["first"], p["last"]))
    return _total(joined.filter(~F.coalesce(covered, F.lit(False))), "n")


def inverted_dates(df: DataFrame, start: str, end: str, counted: str = "person_id") -> DataFrame:
    """Records that end before they start; a missing date is no inversion."""
    return df.filter(F.col(end) < F.col(start)).agg(F.count(counted).alias(COUNT))


def no_value(df: DataFrame, columns: list[str], counted: str = "person_id") -> DataFrame:
    """Records in which all the given value columns are missing."""
    missing = F.lit(True)
    for c in columns:
        missing = missing & F.col(c).isNull()
    return df.filter(missing).agg(F.count(counted).alias(COUNT))


@dataclass(frozen=True)
class Check:
    """One check of a fact table: rows that meet ``failing`` and have a value in ``counted``.

    With ``parent`` (table and column) only those rows fail whose ``key`` it lacks. Rows without a key then count as
    failing only under ``keep_null_key``.
    """

    counted: str
    failing: str = "true"
    key: str | None = None
    parent: tuple[str, str] | None = None
    keep_null_key: bool = False


def orphan_check(key: str, parent: str, parent_key: str, counted: str = "person_id", keep_null_key: bool = False) -> Check:
    return Check(counted, key=key, parent=(parent, parent_key), keep_null_key=keep_null_key)


def inverted_check(start: str, end: str, counted: str = "person_id") -> Check:
    return Check(counted, f"{end} < {start}")


def no_value_check(columns: list[str], counted: str = "person_id") -> Check:
    return Check(counted, " AND ".join(f"{c} IS NULL" for c in columns))


def check_all(facts: DataFrame, checks: Mapping[int, Check], tables: Mapping[str, DataFrame]) -> DataFrame:
    """``analysis_id, count_value`` of all checks of one fact table.

    Each row is unpivoted to (parent table, key) for every check that it may fail, and counted by these before it is
    shuffled, so a key shared by very many facts is a row per task. The parents' keys are rows of the same aggregation:
    facts and parents cross one exchange, nothing is sorted, and keys that have a parent row fall out. Checks without a
    parent have a number and no key of their own, hence none that could exist.
    """
    parents = sorted({c.parent for c in checks.values() if c.parent})
    lanes: list[list[int]] = [[i for i, c in checks.items() if c.parent == p] for p in parents]
    lanes += [[i] for i, c in checks.items() if not c.parent]
    place = {i: (lane, slot) for lane, of in enumerate(lanes) for slot, i in enumerate(of)}
    slots = max((len(of) for of in lanes), default=1)

    keys, failing = [], []
    for c in checks.values():
        key = F.lit(None).cast("long") if c.key is None else F.col(c.key).cast("long")
        fails = F.expr(c.failing) & F.col(c.counted).isNotNull()
        if c.parent and not c.keep_null_key:
            fails = fails & key.isNotNull()
        keys.append(key)
        failing.append(F.coalesce(fails, F.lit(False)))
    # plain arrays by position: one of structs would be boxed for every row
    failed = facts.select(F.array(*failing).alias("failing"), F.posexplode(F.array(*keys)).alias("at", "key"))
    failed = failed.filter(F.get("failing", F.col("at"))).select(
        F.get(F.array(*[F.lit(place[i][0]) for i in checks]), F.col("at")).alias("lane"),
        F.get(F.array(*[F.lit(place[i][1]) for i in checks]), F.col("at")).alias("slot"),
        "key",
    )
    known = [
        tables[t].select(F.lit(lane).alias("lane"), F.lit(None).cast("int").alias("slot"), F.col(pk).cast("long").alias("key"))
        for lane, (t, pk) in enumerate(parents)
    ]
    rows = reduce(DataFrame.unionByName, [failed, *[k.filter("key IS NOT NULL") for k in known]])
    counts = [F.sum(F.when(F.col("slot") == s, 1).otherwise(0)).alias(f"n{s}") for s in range(slots)]
    per_key = rows.groupBy("lane", "key").agg(F.bool_or(F.col("slot").isNull()).alias("exists"), *counts)
    added = per_key.filter("NOT exists").groupBy("lane").agg(*[F.sum(f"n{s}").alias(f"n{s}") for s in range(slots)])
    of_lane = F.posexplode(F.array(*[f"n{s}" for s in range(slots)])).alias("slot", "n")
    numbers = F.array(*[F.lit(i).cast("int") for of in lanes for i in [*of, *[None] * (slots - len(of))]])
    found = added.select("lane", of_lane).select(F.get(numbers, F.col("lane") * slots + F.col("slot")).alias("analysis_id"), "n")
    # every check has a row, also one that finds nothing
    every = facts.sparkSession.createDataFrame([(i, 0) for i in checks], "analysis_id int, n long")
    return found.filter("analysis_id IS NOT NULL").unionByName(every).groupBy("analysis_id").agg(F.sum("n").alias(COUNT))
