"""Calendar coverage by differences: how many persons are covered in each calendar year or month.

The plain form is a range join of all periods with a calendar followed by a distinct count, which multiplies every
period by the units it spans. Here each person's units are first merged into disjoint ranges. A range is +1 at its first
unit and -1 after its last; the differences are added up per unit, where at most one row per unit and task is left, and
the running sum over the units is the number of persons covered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from popscan.functions import month_index, month_key_of_index
from popscan.operators.counts import COUNT


def _unit(date: Column, unit: str) -> Column:
    return F.year(date) if unit == "year" else month_index(date)


def _bounds(start: Column, end: Column, unit: str, mode: str) -> tuple[Column, Column]:
    """First and last unit a period covers."""
    first, last = _unit(start, unit), _unit(end, unit)
    if mode == "overlap":
        return first, last
    opens = F.trunc(start, unit) == start  # starts on the first day of its unit
    next_open = F.date_add(end, 1)
    closes = F.trunc(next_open, unit) == next_open  # ends on the last day of its unit
    return F.when(opens, first).otherwise(first + 1), F.when(closes, last).otherwise(last - 1)


def disjoint_segments(spans: DataFrame) -> DataFrame:
    """Per person, replace overlapping [lo, hi] unit ranges by disjoint ones.

    Ranges are first reduced to the longest per (person, lo), so that one
    person contributes at most one row per calendar unit.
    """
    longest = spans.groupBy("person_id", "lo").agg(F.max("hi").alias("hi"))
    earlier = W.partitionBy("person_id").orderBy("lo").rowsBetween(W.unboundedPreceding, -1)
    reached = F.max("hi").over(earlier)
    fresh = F.when(reached.isNull(), F.col("lo")).otherwise(F.greatest(F.col("lo"), reached + 1))
    return (
        longest.withColumn("fresh", fresh)
        .filter(F.col("fresh") <= F.col("hi"))
        .select("person_id", F.col("fresh").alias("lo"), "hi")
    )


def differences(segments: DataFrame, attributes: Sequence[str] = ()) -> DataFrame:
    """``u, change`` [and attributes]: +1 where a range begins, -1 behind its end, not yet added up."""
    edges = segments.select(*attributes, F.col("lo").alias("1"), (F.col("hi") + 1).alias("-1"))
    return edges.unpivot(list(attributes), ["1", "-1"], "edge", "u").select(
        *attributes, "u", F.col("edge").cast("long").alias("change")
    )


def calendar_coverage(
    periods: DataFrame,
    start: str,
    end: str,
    unit: str,
    mode: str,
    persons: DataFrame | None = None,
    attributes: Sequence[str] = (),
) -> DataFrame:
    """Distinct persons per calendar unit [and person attributes].

    ``mode="contain"`` asks for one period that spans the whole unit,
    ``"overlap"`` for a period that touches it. The calendar consists of the
    units in which some period starts, no others. ``persons`` restricts the
    count to known persons and supplies ``attributes``.
    Returns ``unit`` (year, or yyyymm), the attributes and ``count_value``.
    """
    lo, hi = _bounds(F.col(start), F.col(end), unit, mode)
    dated = periods.filter(F.col(start).isNotNull())
    opened = dated.select(_unit(F.col(start), unit).alias("u"))
    spans = (
        dated.filter(F.col("person_id").isNotNull() & F.col(end).isNotNull())
        .select("person_id", lo.alias("lo"), hi.alias("hi"))
        .filter(F.col("lo") <= F.col("hi"))
    )
    segments = disjoint_segments(spans)
    if persons is not None:
        # rows are clustered by person here, so the distinct needs no shuffle; it
        # keeps the count exact should the person table repeat an id
        segments = segments.join(persons.select("person_id", *attributes), "person_id").distinct()
    changes = differences(segments, attributes)
    count = F.sum("change").over(W.partitionBy(*attributes).orderBy("u"))
    if attributes:
        # the running count of each group holds up to its next change; the calendar's units in between are its rows
        added = changes.groupBy("u", *attributes).agg(F.sum("change").alias("change"))
        upto = F.lead("u").over(W.partitionBy(*attributes).orderBy("u"))
        held = added.select("u", upto.alias("upto"), *attributes, count.alias(COUNT)).filter(F.col(COUNT) > 0)
        calendar = opened.agg(F.array_sort(F.collect_set("u")).alias("calendar")).scalar()
        within = F.filter("calendar", lambda u: (u >= F.col("since")) & (u < F.col("upto")))
        held = held.withColumnRenamed("u", "since").withColumn("calendar", calendar)
        rows = held.select(F.explode(within).alias("u"), *attributes, COUNT)
    else:
        # units of the calendar join the differences as rows that change nothing; what is left for the
        # running sum is a row per unit
        marked = changes.select("u", "change", F.lit(False).alias("opens")).unionByName(
            opened.select("u", F.lit(0).cast("long").alias("change"), F.lit(True).alias("opens"))
        )
        added = marked.groupBy("u").agg(F.sum("change").alias("change"), F.bool_or("opens").alias("opens"))
        rows = added.select("u", "opens", count.alias(COUNT)).filter(F.col("opens") & (F.col(COUNT) > 0))
    key = F.col("u") if unit == "year" else month_key_of_index(F.col("u"))
    return rows.select(key.cast("int").alias("unit"), *attributes, COUNT)
