"""Analyses every event table has: counts by concept, month, demographics, ages, integrity.

Numbers follow the domain's base: +0 persons, +1 records, +2 persons by month,
+3 concepts per person, +4 demographics, +5 types, +6 ages, +20 records by month.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popscan import catalogue
from popscan.analyses.names import DOMAIN_NAMES
from popscan.catalogue import DIST, RESULTS, Analysis
from popscan.cdm import Cdm, Domain
from popscan.operators import (
    PERSONS,
    RECORDS,
    Check,
    Stratum,
    by_demographics,
    count_distinct,
    count_records,
    distribution,
    inverted_check,
    inverted_dates,
    no_value,
    no_value_check,
    orphan_check,
    orphans,
    outside_period,
    outside_period_clustered,
)

VISIT = Domain("visit_occurrence", "visit_concept_id", "visit_start_date", "visit_end_date")
CONDITION = Domain(
    "condition_occurrence", "condition_concept_id", "condition_start_date", "condition_end_date",
    type="condition_type_concept_id",
)
PROCEDURE = Domain(
    "procedure_occurrence", "procedure_concept_id", "procedure_date", type="procedure_type_concept_id"
)
DRUG = Domain(
    "drug_exposure", "drug_concept_id", "drug_exposure_start_date", "drug_exposure_end_date",
    type="drug_type_concept_id",
)
OBSERVATION = Domain(
    "observation", "observation_concept_id", "observation_date", type="observation_type_concept_id",
    unit="unit_concept_id",
)
DRUG_ERA = Domain("drug_era", "drug_concept_id", "drug_era_start_date", "drug_era_end_date")
CONDITION_ERA = Domain(
    "condition_era", "condition_concept_id", "condition_era_start_date", "condition_era_end_date"
)
MEASUREMENT = Domain(
    "measurement", "measurement_concept_id", "measurement_date", type="measurement_type_concept_id",
    unit="unit_concept_id",
)

# Numbers whose builders read ``Cdm.events`` and hence profit from a rollup.
FROM_EVENTS: dict[int, Domain] = {}


def _register(
    number: int,
    name: str,
    strata: tuple[str, ...],
    family: str,
    build: Callable[[Cdm], DataFrame],
    kind: str = RESULTS,
    versions: tuple[str, ...] = ("v4", "v5"),
    grouping: tuple[Domain, Stratum] | None = None,
    check: tuple[str, Check] | None = None,
) -> None:
    catalogue.register(
        Analysis(number, name, strata, family, kind, build, versions=versions, grouping=grouping, check=check)
    )


def _age_at_first(cdm: Cdm, d: Domain) -> DataFrame:
    first = cdm.events(d).groupBy("person_id", "concept_id").agg(F.min("month").alias("month"))
    ages = first.join(cdm.persons(), "person_id").select(
        "concept_id", "gender_concept_id", (F.floor(F.col("month") / 100) - F.col("year_of_birth")).alias("age")
    )
    return distribution(ages, ["concept_id", "gender_concept_id"], "age", legacy=cdm.legacy)


def _concepts_per_person(cdm: Cdm, d: Domain) -> DataFrame:
    per_person = cdm.events(d).groupBy("person_id").agg(F.countDistinct("concept_id").alias("concepts"))
    return distribution(per_person, [], "concepts", legacy=cdm.legacy)


def _demographics(cdm: Cdm, d: Domain) -> DataFrame:
    events = cdm.events(d).withColumn("year", F.floor(F.col("month") / 100).cast("int"))
    return by_demographics(events, cdm.persons())


def _common(base: int, d: Domain, versions: tuple[str, ...] = ("v4", "v5")) -> None:
    """Register the numbers relative to ``base``."""
    c = d.concept

    def add(offset, strata, family, build, kind=RESULTS, grouping=None):
        FROM_EVENTS[base + offset] = d
        _register(base + offset, DOMAIN_NAMES[base + offset], strata, family, build, kind, versions, grouping)

    def count(offset, strata, keys, measure):
        def build(cdm: Cdm) -> DataFrame:
            return (count_distinct if measure == PERSONS else count_records)(cdm.events(d), keys)

        add(offset, strata, "COUNT", build, grouping=(d, Stratum(tuple(keys), measure)))

    count(0, (c,), ["concept_id"], PERSONS)
    count(1, (c,), ["concept_id"], RECORDS)
    count(2, (c, "calendar month"), ["concept_id", "month"], PERSONS)
    add(3, (), "DIST", lambda cdm: _concepts_per_person(cdm, d), DIST)
    add(4, (c, "calendar year", "gender_concept_id", "age decile"), "DEMOG", lambda cdm: _demographics(cdm, d))
    if d.type:
        count(5, (c, d.type), ["concept_id", "type_id"], RECORDS)
    add(6, (c, "gender_concept_id"), "DIST", lambda cdm: _age_at_first(cdm, d), DIST)
    if d.unit:
        count(7, (c, "unit_concept_id"), ["concept_id", "unit_id"], RECORDS)
    count(20, ("calendar month",), ["month"], RECORDS)


def _outside(cdm: Cdm, d: Domain) -> DataFrame:
    span = (cdm["observation_period"], "observation_period_start_date", "observation_period_end_date")
    if d.table in cdm.days:
        return outside_period_clustered(cdm.days[d.table], *span)
    return outside_period(cdm[d.table], d.start, *span)


def _checks(
    d: Domain, person: int, outside: int, inverted: int | None = None,
    keys: tuple[tuple[int, str, str, str], ...] = (), versions: tuple[str, ...] = ("v4", "v5"),
) -> None:
    """Register the integrity checks of a domain.

    ``keys`` lists further foreign keys: number, column, parent table and parent key.
    """
    _register(
        person, DOMAIN_NAMES[person], (), "ORPHAN",
        lambda cdm: orphans(cdm.events(d), "person_id", cdm["person"], "person_id", F.col("n")),
        versions=versions, check=(d.table, orphan_check("person_id", "person", "person_id")),
    )
    FROM_EVENTS[person] = d
    _register(outside, DOMAIN_NAMES[outside], (), "OUTSIDE", lambda cdm: _outside(cdm, d), versions=versions)
    if inverted is not None:
        _register(
            inverted, DOMAIN_NAMES[inverted], (), "INVERT", lambda cdm: inverted_dates(cdm[d.table], d.start, d.end),
            versions=versions, check=(d.table, inverted_check(d.start, d.end)),
        )

    def add_key(number: int, column: str, parent: str, pk: str) -> None:
        def build(cdm: Cdm) -> DataFrame:
            has_person = F.when(F.col("person_id").isNotNull(), 1).otherwise(0)
            return orphans(cdm[d.table], column, cdm[parent], pk, has_person)

        _register(
            number, DOMAIN_NAMES[number], (), "ORPHAN", build, versions=versions,
            check=(d.table, orphan_check(column, parent, pk)),
        )

    for key in keys:
        add_key(*key)


def _provider(number: int):
    return (number, "provider_id", "provider", "provider_id")


def _visit(number: int):
    return (number, "visit_occurrence_id", "visit_occurrence", "visit_occurrence_id")


_common(200, VISIT)
_checks(VISIT, 207, 208, 209, ((210, "care_site_id", "care_site", "care_site_id"),))
_common(400, CONDITION)
_checks(CONDITION, 409, 410, 411, (_provider(412), _visit(413)))
_common(600, PROCEDURE)
_checks(PROCEDURE, 609, 610, None, (_provider(612), _visit(613)))
_common(700, DRUG)
_checks(DRUG, 709, 710, 711, (_provider(712), _visit(713)))
_common(800, OBSERVATION)
_checks(OBSERVATION, 809, 810, None, (_provider(812), _visit(813)))
_common(900, DRUG_ERA)
_checks(DRUG_ERA, 908, 909, 910)
_common(1000, CONDITION_ERA)
_checks(CONDITION_ERA, 1008, 1009, 1010)
_common(1800, MEASUREMENT, versions=("v5",))
_checks(MEASUREMENT, 1809, 1810, None, (_provider(1812), _visit(1813)), versions=("v5",))


_OBSERVED = ["value_as_number", "value_as_string", "value_as_concept_id"]
_MEASURED = ["value_as_number", "value_as_concept_id"]


@catalogue.analysis(
    814, "Number of observation records with no value (numeric, string, or concept)", family="NOVALUE",
    check=("observation", no_value_check(_OBSERVED)),
)
def observations_without_value(cdm: Cdm) -> DataFrame:
    return no_value(cdm["observation"], _OBSERVED)


@catalogue.analysis(
    1814,
    "Number of measurement records with no value (numeric, string, or concept)",
    family="NOVALUE",
    versions=("v5",),
    check=("measurement", no_value_check(_MEASURED)),
)
def measurements_without_value(cdm: Cdm) -> DataFrame:
    return no_value(cdm["measurement"], _MEASURED)
