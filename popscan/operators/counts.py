"""Counting operators: records, distinct persons, counts of counts, first events.

All of them aggregate before they shuffle: Spark combines on the map side, and
a join to the person table only ever sees rows already reduced to one per
person and key. A person or concept holding a large share of the rows thus
shrinks before it meets a partition of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popscan.functions import age_decile

COUNT = "count_value"


def count_where(df: DataFrame, column: str = "person_id", condition: Column | None = None) -> DataFrame:
    """One row: how many rows (with a non-null ``column``) satisfy ``condition``."""
    if condition is not None:
        df = df.filter(condition)
    return df.agg(F.count(column).alias(COUNT))


def count_records(df: DataFrame, keys: Sequence[str], weight: str = "n") -> DataFrame:
    """Records per key. ``weight`` holds the records each row stands for."""
    return df.groupBy(*keys).agg(F.coalesce(F.sum(weight), F.lit(0)).cast("long").alias(COUNT))


def count_rows(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Rows with a non-null ``column`` per key."""
    return df.groupBy(*keys).agg(F.count(column).alias(COUNT))


def count_distinct(df: DataFrame, keys: Sequence[str], column: str = "person_id") -> DataFrame:
    """Exact distinct ids per key.

    Plans as two hash aggregations, first on (key, id), so one frequent key is
    spread over all partitions. Distinct counts do not add up over finer keys,
    hence every analysis counts on its own keys.
    """
    return df.groupBy(*keys).agg(F.countDistinct(column).alias(COUNT))


def count_of_counts(df: DataFrame, id_col: str, counted: str, alias: str) -> DataFrame:
    """Ids per number of rows they have."""
    per_id = df.groupBy(id_col).agg(F.count(counted).alias(alias))
    return per_id.groupBy(alias).agg(F.count(id_col).alias(COUNT))


def first_period(df: DataFrame, start: str, end: str, id_col: str) -> DataFrame:
    """Each person's earliest period as ``person_id, start_date, end_date``.

    A minimum over (start, end, id) instead of a numbered window: it combines
    on the map side, so no person's periods are gathered in one task. Periods
    without a start come last; ties go to the earlier end, then the lower id.
    """
    order = F.struct(
        F.col(start).isNull().alias("no_start"),
        F.col(start).alias("start_date"),
        F.col(end).isNull().alias("no_end"),
        F.col(end).alias("end_date"),
        F.col(id_col).alias("id"),
    )
    first = df.groupBy("person_id").agg(F.min(order).alias("p"))
    return first.select("person_id", "p.start_date", "p.end_date")


def by_demographics(
    events: DataFrame, persons: DataFrame, keys: Sequence[str] = ("concept_id",)
) -> DataFrame:
    """Distinct persons per [key,] year, gender and age decile at the event.

    ``events`` needs ``person_id`` and an integer ``year`` besides ``keys``.
    Events are reduced to one row per (person, key, year) before the join. The
    person table is reduced to one row per id with all its genders and births,
    so the count stays exact should it repeat an id, and the joined rows need
    no further distinct: their strata are counted as they come.
    """
    seen = events.select("person_id", *keys, "year").distinct()
    strata = [*keys, "year", "gender_concept_id", "age_decile"]
    facts = F.struct("gender_concept_id", "year_of_birth")
    known = persons.filter(F.col("person_id").isNotNull()).groupBy("person_id").agg(F.collect_set(facts).alias("known"))
    shown = F.array_distinct(
        F.transform(
            "known",
            lambda p: F.struct(p["gender_concept_id"], age_decile(F.col("year"), p["year_of_birth"]).alias("age_decile")),
        )
    )
    joined = seen.join(known, "person_id").select(*keys, "year", F.inline(shown))
    return joined.groupBy(*strata).agg(F.count(F.lit(1)).alias(COUNT))


def count_via(
    facts: DataFrame, fk: str, dimension: DataFrame, pk: str, attribute: Column, name: str, partial: Column
) -> DataFrame:
    """Count facts by an attribute of the dimension they point to.

    Facts are first counted per foreign key (``partial``), so the join sees one
    row per key however often it occurs. Facts without a key and keys without
    the attribute drop out.
    """
    counted = facts.filter(F.col(fk).isNotNull()).groupBy(fk).agg(partial.alias("partial_count"))
    lookup = dimension.select(F.col(pk).alias(fk), attribute.alias(name)).filter(F.col(name).isNotNull())
    return counted.join(lookup, fk).groupBy(name).agg(F.sum("partial_count").alias(COUNT))
