"""Analyses of the observation period table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popscan.catalogue import DIST, analysis
from popscan.cdm import Cdm
from popscan.functions import age_decile, month_key
from popscan.operators import (
    calendar_coverage,
    count_distinct,
    count_of_counts,
    count_rows,
    distribution,
    first_period,
    inverted_dates,
    orphans,
)
from popscan.operators.counts import COUNT

START, END = "observation_period_start_date", "observation_period_end_date"


def first_year_age(cdm: Cdm, table: str, start: str) -> DataFrame:
    """Persons with the year their first period starts and their age then."""
    first = cdm[table].groupBy("person_id").agg(F.min(start).alias("index_date"))
    year = F.year("index_date")
    return first.join(cdm.persons(), "person_id").select(
        "person_id", "gender_concept_id", "year_of_birth", year.alias("first_year"),
        (year - F.col("year_of_birth")).alias("age"),
    )


def first_lengths(cdm: Cdm, table: str, start: str, end: str, key: str) -> DataFrame:
    """Known persons with the length in days of their first period."""
    first = first_period(cdm[table], start, end, key)
    return first.join(cdm.persons(), "person_id").select(
        "person_id",
        "gender_concept_id",
        age_decile(F.year("start_date"), F.col("year_of_birth")).alias("age_decile"),
        F.datediff("end_date", "start_date").alias("days"),
    )


def length_in_months(lengths: DataFrame) -> DataFrame:
    return count_distinct(lengths.withColumn("months", F.floor(F.col("days") / 30)), ["months"])


def born_after(ages: DataFrame) -> DataFrame:
    late = ages.filter(F.col("year_of_birth") > F.col("first_year"))
    return late.agg(F.countDistinct("person_id").alias(COUNT))


def _ages(cdm: Cdm) -> DataFrame:
    return first_year_age(cdm, "observation_period", START)


def _lengths(cdm: Cdm) -> DataFrame:
    return first_lengths(cdm, "observation_period", START, END, "observation_period_id")


# The names and strata in the decorators below are those of the catalogue.
@analysis(101, "Number of persons by age, with age at first observation period", ("age",), "FIRST")
def persons_by_age(cdm: Cdm) -> DataFrame:
    return count_rows(_ages(cdm), ["age"], "person_id")


@analysis(
    102,
    "Number of persons by gender by age, with age at first observation period",
    ("gender_concept_id", "age"),
    "FIRST",
)
def persons_by_gender_age(cdm: Cdm) -> DataFrame:
    return count_rows(_ages(cdm), ["gender_concept_id", "age"], "person_id")


@analysis(103, "Distribution of age at first observation period", family="DIST", kind=DIST)
def age_at_first(cdm: Cdm) -> DataFrame:
    return distribution(_ages(cdm), [], "age", legacy=cdm.legacy)


@analysis(
    104, "Distribution of age at first observation period by gender", ("gender_concept_id",), "DIST", DIST
)
def age_at_first_by_gender(cdm: Cdm) -> DataFrame:
    return distribution(_ages(cdm), ["gender_concept_id"], "age", legacy=cdm.legacy)


@analysis(105, "Length of observation (days) of first observation period", family="DIST", kind=DIST)
def first_length(cdm: Cdm) -> DataFrame:
    # all persons with a period, known or not
    first = first_period(cdm["observation_period"], START, END, "observation_period_id")
    days = first.select(F.datediff("end_date", "start_date").alias("days"))
    return distribution(days, [], "days", legacy=cdm.legacy)


@analysis(
    106, "Length of observation (days) of first observation period by gender", ("gender_concept_id",),
    "DIST", DIST,
)
def first_length_by_gender(cdm: Cdm) -> DataFrame:
    return distribution(_lengths(cdm), ["gender_concept_id"], "days", legacy=cdm.legacy)


@analysis(
    107, "Length of observation (days) of first observation period by age decile", ("age decile",),
    "DIST", DIST,
)
def first_length_by_age(cdm: Cdm) -> DataFrame:
    return distribution(_lengths(cdm), ["age_decile"], "days", legacy=cdm.legacy)


@analysis(
    108,
    "Number of persons by length of observation period, in 30d increments",
    ("Observation period length 30d increments",),
    "FIRST",
)
def persons_by_length(cdm: Cdm) -> DataFrame:
    return length_in_months(_lengths(cdm))


@analysis(
    109, "Number of persons with continuous observation in each year", ("calendar year",), "CALENDAR"
)
def observed_whole_year(cdm: Cdm) -> DataFrame:
    return calendar_coverage(cdm["observation_period"], START, END, "year", "contain")


@analysis(
    110, "Number of persons with continuous observation in each month", ("calendar month",), "CALENDAR"
)
def observed_whole_month(cdm: Cdm) -> DataFrame:
    return calendar_coverage(cdm["observation_period"], START, END, "month", "contain")


@analysis(111, "Number of persons by observation period start month", ("calendar month",))
def persons_by_start_month(cdm: Cdm) -> DataFrame:
    months = cdm["observation_period"].select("person_id", month_key(F.col(START)).alias("month"))
    return count_distinct(months, ["month"])


@analysis(112, "Number of persons by observation period end month", ("calendar month",))
def persons_by_end_month(cdm: Cdm) -> DataFrame:
    months = cdm["observation_period"].select("person_id", month_key(F.col(END)).alias("month"))
    return count_distinct(months, ["month"])


@analysis(
    113, "Number of persons by number of observation periods", ("number of observation periods",), "COUNT2"
)
def persons_by_periods(cdm: Cdm) -> DataFrame:
    return count_of_counts(cdm["observation_period"], "person_id", START, "periods")


@analysis(114, "Number of persons with observation period before year-of-birth", family="FIRST")
def observed_before_birth(cdm: Cdm) -> DataFrame:
    return born_after(_ages(cdm))


@analysis(
    115, "Number of persons with observation period end < observation period start", family="INVERT"
)
def inverted_periods(cdm: Cdm) -> DataFrame:
    return inverted_dates(cdm["observation_period"], START, END)


@analysis(
    116,
    "Number of persons with at least one day of observation in each year by gender and age decile",
    ("calendar year", "gender_concept_id", "age decile"),
    "CALENDAR",
)
def observed_by_year(cdm: Cdm) -> DataFrame:
    # gender and year of birth divide the persons, so their counts add up to deciles
    covered = calendar_coverage(
        cdm["observation_period"], START, END, "year", "overlap",
        persons=cdm.persons(), attributes=["gender_concept_id", "year_of_birth"],
    )
    decile = age_decile(F.col("unit"), F.col("year_of_birth")).alias("age_decile")
    return covered.groupBy("unit", "gender_concept_id", decile).agg(F.sum(COUNT).alias(COUNT))


@analysis(
    117, "Number of persons with at least one day of observation in each month", ("calendar month",),
    "CALENDAR",
)
def observed_by_month(cdm: Cdm) -> DataFrame:
    return calendar_coverage(cdm["observation_period"], START, END, "month", "overlap")


@analysis(118, "Number of observation periods with invalid person_id", family="ORPHAN")
def invalid_person(cdm: Cdm) -> DataFrame:
    return orphans(cdm["observation_period"], "person_id", cdm["person"], "person_id", F.lit(1))
