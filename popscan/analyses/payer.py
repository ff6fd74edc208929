"""Analyses of the payer plan period table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popscan.analyses.periods import born_after, first_lengths, first_year_age, length_in_months
from popscan.catalogue import DIST, analysis
from popscan.cdm import Cdm
from popscan.functions import first_of_month
from popscan.operators import calendar_coverage, count_distinct, distribution, inverted_dates

TABLE = "payer_plan_period"
START, END = "payer_plan_period_start_date", "payer_plan_period_end_date"


def _lengths(cdm: Cdm) -> DataFrame:
    return first_lengths(cdm, TABLE, START, END, "payer_plan_period_id")


def _known(periods: DataFrame, cdm: Cdm) -> DataFrame:
    """Rows of known persons; call it on rows already reduced per person."""
    return periods.join(cdm["person"].select("person_id"), "person_id", "left_semi")


# The names and strata in the decorators below are those of the catalogue.
@analysis(
    1406, "Length of payer plan (days) of first payer plan period by gender", ("gender_concept_id",),
    "DIST", DIST,
)
def first_length_by_gender(cdm: Cdm) -> DataFrame:
    return distribution(_lengths(cdm), ["gender_concept_id"], "days", legacy=cdm.legacy)


@analysis(
    1407, "Length of payer plan (days) of first payer plan period by age decile", ("age_decile",),
    "DIST", DIST,
)
def first_length_by_age(cdm: Cdm) -> DataFrame:
    return distribution(_lengths(cdm), ["age_decile"], "days", legacy=cdm.legacy)


@analysis(
    1408,
    "Number of persons by length of payer plan period, in 30d increments",
    ("payer plan period length 30d increments",),
    "FIRST",
)
def persons_by_length(cdm: Cdm) -> DataFrame:
    return length_in_months(_lengths(cdm))


@analysis(1409, "Number of persons with continuous payer plan in each year", ("calendar year",), "CALENDAR")
def covered_by_year(cdm: Cdm) -> DataFrame:
    # the name says continuous; the reference results count any overlap
    return calendar_coverage(cdm[TABLE], START, END, "year", "overlap", persons=cdm.persons())


@analysis(
    1410, "Number of persons with continuous payer plan in each month", ("calendar month",), "CALENDAR"
)
def covered_whole_month(cdm: Cdm) -> DataFrame:
    return calendar_coverage(cdm[TABLE], START, END, "month", "contain", persons=cdm.persons())


def _persons_by_month(cdm: Cdm, date: str) -> DataFrame:
    months = cdm[TABLE].select("person_id", F.trunc(date, "month").alias("month")).distinct()
    counted = count_distinct(_known(months, cdm), ["month"])
    return counted.select(first_of_month(F.col("month")).alias("month"), "count_value")


@analysis(1411, "Number of persons by payer plan period start month", ("calendar month",))
def persons_by_start_month(cdm: Cdm) -> DataFrame:
    return _persons_by_month(cdm, START)


@analysis(1412, "Number of persons by payer plan period end month", ("calendar month",))
def persons_by_end_month(cdm: Cdm) -> DataFrame:
    return _persons_by_month(cdm, END)


@analysis(
    1413, "Number of persons by number of payer plan periods", ("number of payer plan periods",), "COUNT2"
)
def persons_by_periods(cdm: Cdm) -> DataFrame:
    per_person = cdm[TABLE].groupBy("person_id").agg(F.count(START).alias("periods"))
    known = _known(per_person, cdm)
    return known.groupBy("periods").agg(F.count("person_id").alias("count_value"))


@analysis(1414, "Number of persons with payer plan period before year-of-birth", family="FIRST")
def covered_before_birth(cdm: Cdm) -> DataFrame:
    return born_after(first_year_age(cdm, TABLE, START))


@analysis(
    1415, "Number of persons with payer plan period end < payer plan period start", family="INVERT"
)
def inverted_periods(cdm: Cdm) -> DataFrame:
    return inverted_dates(cdm[TABLE], START, END)
