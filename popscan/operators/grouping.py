"""Many groupings of one event table from a single pass: ``GROUPING SETS`` with exact distinct persons.

Every analysis that counts records or persons by some columns is one grouping set. Sets that count persons carry the
person as a further grouping column, so the pass leaves one row per person and group; a second, much smaller aggregation
counts those rows and adds up their records. Sets that only count records leave the person out and are final after the
pass. ``grouping_id`` tells which set a row belongs to, and the set which analyses it answers.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popscan.operators.counts import COUNT

PERSONS, RECORDS = "persons", "records"


@dataclass(frozen=True)
class Stratum:
    """A count of ``persons`` or ``records`` by ``keys`` (columns of the event table)."""

    keys: tuple[str, ...]
    measure: str = RECORDS


def grouping_number(columns: tuple[str, ...], kept: tuple[str, ...]) -> int:
    """What ``grouping_id`` says of a set: a bit for each of ``columns``, the first one highest, set where left out."""
    return sum(1 << i for i, c in enumerate(reversed(columns)) if c not in kept)


def stratify(
    events: DataFrame, wanted: Mapping[int, Stratum], person: str = "person_id", weight: str = "n"
) -> DataFrame:
    """``analysis_id, stratum_1.., count_value`` of all ``wanted`` analyses.

    A null in a grouping column is a group of its own, told apart from a column left out by the grouping number. Rows
    without a person count as no person; ``weight`` holds the records a row stands for.
    """
    if not wanted:
        raise ValueError("no analysis is asked for")
    keys = tuple(dict.fromkeys(k for s in wanted.values() for k in s.keys))
    columns = (*keys, person)
    sets: dict[tuple[str, ...], list[tuple[int, Stratum]]] = {}
    with_persons = {frozenset(s.keys) for s in wanted.values() if s.measure == PERSONS}
    for number, s in wanted.items():
        ordered = tuple(k for k in keys if k in s.keys)
        sets.setdefault((*ordered, person) if frozenset(s.keys) in with_persons else ordered, []).append((number, s))

    per_person = events.groupingSets([[F.col(c) for c in kept] for kept in sets], *columns).agg(
        F.sum(weight).alias("n"), F.grouping_id().alias("set")
    )
    counted = per_person.groupBy("set", *keys).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias(RECORDS), F.count(person).alias(PERSONS)
    )
    width = max(len(s.keys) for s in wanted.values())

    def row(number: int, s: Stratum):
        strata = [F.col(k).cast("string") for k in s.keys] + [F.lit(None).cast("string")] * (width - len(s.keys))
        named = [c.alias(f"stratum_{i}") for i, c in enumerate(strata, 1)]
        return F.struct(F.lit(number).alias("analysis_id"), *named, F.col(s.measure).cast("long").alias(COUNT))

    answers = F.lit(None)
    for kept, asked in sets.items():
        of_set = F.array(*[row(number, s) for number, s in asked])
        answers = F.when(F.col("set") == grouping_number(columns, kept), of_set).otherwise(answers)
    return counted.select(F.inline(answers))
