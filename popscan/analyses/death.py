"""Analyses of the death table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popscan.analyses.periods import END, START
from popscan.catalogue import DIST, analysis
from popscan.cdm import Cdm
from popscan.functions import month_key
from popscan.operators import (
    by_demographics,
    count_distinct,
    count_rows,
    distribution,
    orphans,
    outside_period,
)

CAUSE = "cause_of_death_concept_id"


@analysis(500, "Number of persons with death, by cause_of_death_concept_id", (CAUSE,))
def persons_by_cause(cdm: Cdm) -> DataFrame:
    return count_distinct(cdm["death"], ["cause_concept_id"])


@analysis(501, "Number of records of death, by cause_of_death_concept_id", (CAUSE,))
def records_by_cause(cdm: Cdm) -> DataFrame:
    return count_rows(cdm["death"], ["cause_concept_id"], "person_id")


@analysis(502, "Number of persons by death month", ("calendar month",))
def persons_by_month(cdm: Cdm) -> DataFrame:
    months = cdm["death"].select("person_id", month_key(F.col("death_date")).alias("month"))
    return count_distinct(months, ["month"])


@analysis(
    504, "Number of persons with a death, by calendar year by gender by age decile",
    ("calendar year", "gender_concept_id", "age decile"), "DEMOG",
)
def persons_by_demographics(cdm: Cdm) -> DataFrame:
    return by_demographics(cdm["death"].withColumn("year", F.year("death_date")), cdm.persons(), [])


@analysis(505, "Number of death records, by death_type_concept_id", ("death_type_concept_id",))
def records_by_type(cdm: Cdm) -> DataFrame:
    return count_rows(cdm["death"], ["death_type_concept_id"], "person_id")


@analysis(506, "Distribution of age at death by gender", ("gender_concept_id",), "DIST", DIST)
def age_at_death(cdm: Cdm) -> DataFrame:
    first = cdm["death"].groupBy("person_id").agg(F.min(F.year("death_date")).alias("year"))
    ages = first.join(cdm.persons(), "person_id").withColumn("age", F.col("year") - F.col("year_of_birth"))
    return distribution(ages, ["gender_concept_id"], "age", legacy=cdm.legacy)


@analysis(509, "Number of death records with invalid person_id", family="ORPHAN")
def invalid_person(cdm: Cdm) -> DataFrame:
    return orphans(cdm["death"], "person_id", cdm["person"], "person_id", F.lit(1))


@analysis(510, "Number of death records outside valid observation period", family="OUTSIDE")
def outside(cdm: Cdm) -> DataFrame:
    return outside_period(cdm["death"], "death_date", cdm["observation_period"], START, END)


def _days_to_last(cdm: Cdm, table: str, date: str, legacy: bool) -> DataFrame:
    """Days from death to a person's last event; positive when events follow death."""
    last = cdm[table].groupBy("person_id").agg(F.max(date).alias("last_date"))
    days = cdm["death"].join(last, "person_id").select(F.datediff("last_date", "death_date").alias("days"))
    return distribution(days, [], "days", legacy=legacy)


@analysis(511, "Distribution of time from death to last condition", family="DISTLEG", kind=DIST)
def to_last_condition(cdm: Cdm) -> DataFrame:
    # this one uses the legacy quantile in every version
    return _days_to_last(cdm, "condition_occurrence", "condition_start_date", legacy=True)


@analysis(512, "Distribution of time from death to last drug", family="DIST", kind=DIST)
def to_last_drug(cdm: Cdm) -> DataFrame:
    return _days_to_last(cdm, "drug_exposure", "drug_exposure_start_date", cdm.legacy)


@analysis(513, "Distribution of time from death to last visit", family="DIST", kind=DIST)
def to_last_visit(cdm: Cdm) -> DataFrame:
    return _days_to_last(cdm, "visit_occurrence", "visit_start_date", cdm.legacy)


@analysis(514, "Distribution of time from death to last procedure", family="DIST", kind=DIST)
def to_last_procedure(cdm: Cdm) -> DataFrame:
    return _days_to_last(cdm, "procedure_occurrence", "procedure_date", cdm.legacy)


@analysis(515, "Distribution of time from death to last observation", family="DIST", kind=DIST)
def to_last_observation(cdm: Cdm) -> DataFrame:
    return _days_to_last(cdm, "observation", "observation_date", cdm.legacy)
