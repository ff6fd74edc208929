"""Analyses of providers, locations, care sites, organizations and cohorts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popscan.catalogue import analysis
from popscan.cdm import Cdm
from popscan.operators import count_distinct, count_rows, count_via, inverted_dates, orphans

PLACE = "place_of_service_concept_id"


@analysis(300, "Number of providers")
def providers(cdm: Cdm) -> DataFrame:
    return count_distinct(cdm["provider"], [], "provider_id")


@analysis(301, "Number of providers by specialty concept_id", ("specialty_concept_id",))
def providers_by_specialty(cdm: Cdm) -> DataFrame:
    return count_distinct(cdm["provider"], ["specialty_concept_id"], "provider_id")


@analysis(302, "Number of providers with invalid care site id", family="ORPHAN")
def providers_invalid_care_site(cdm: Cdm) -> DataFrame:
    has_id = F.when(F.col("provider_id").isNotNull(), 1).otherwise(0)
    return orphans(cdm["provider"], "care_site_id", cdm["care_site"], "care_site_id", has_id)


def _at_location(cdm: Cdm, table: str, key: str, attribute: str) -> DataFrame:
    # a row has one location, so distinct ids per location add up
    column = F.substring("zip", 1, 3) if attribute == "zip" else F.col(attribute)
    return count_via(
        cdm[table], "location_id", cdm["location"], "location_id", column, attribute, F.countDistinct(key)
    )


@analysis(1100, "Number of persons by location 3-digit zip", ("3-digit zip",))
def persons_by_zip(cdm: Cdm) -> DataFrame:
    return _at_location(cdm, "person", "person_id", "zip")


@analysis(1101, "Number of persons by location state", ("state",))
def persons_by_state(cdm: Cdm) -> DataFrame:
    return _at_location(cdm, "person", "person_id", "state")


@analysis(1102, "Number of care sites by location 3-digit zip", ("3-digit zip",))
def care_sites_by_zip(cdm: Cdm) -> DataFrame:
    return _at_location(cdm, "care_site", "care_site_id", "zip")


@analysis(1103, "Number of care sites by location state", ("state",))
def care_sites_by_state(cdm: Cdm) -> DataFrame:
    return _at_location(cdm, "care_site", "care_site_id", "state")


def _at_care_site(cdm: Cdm, table: str, counted: str) -> DataFrame:
    return count_via(
        cdm[table], "care_site_id", cdm["care_site"], "care_site_id", F.col(PLACE), PLACE, F.count(counted)
    )


@analysis(1200, "Number of persons by place of service", (PLACE,))
def persons_by_place(cdm: Cdm) -> DataFrame:
    return _at_care_site(cdm, "person", "person_id")


@analysis(1201, "Number of visits by place of service", (PLACE,))
def visits_by_place(cdm: Cdm) -> DataFrame:
    return _at_care_site(cdm, "visit_occurrence", "visit_occurrence_id")


@analysis(1202, "Number of care sites by place of service", (PLACE,))
def care_sites_by_place(cdm: Cdm) -> DataFrame:
    return count_rows(cdm["care_site"].filter(F.col(PLACE).isNotNull()), [PLACE], "care_site_id")


@analysis(1300, "Number of organizations by place of service", (PLACE,), versions=("v4",))
def organizations_by_place(cdm: Cdm) -> DataFrame:
    return count_rows(cdm["organization"].filter(F.col(PLACE).isNotNull()), [PLACE], "organization_id")


@analysis(1700, "Number of records by cohort_concept_id", ("cohort_concept_id",))
def cohort_records(cdm: Cdm) -> DataFrame:
    return count_rows(cdm["cohort"], ["cohort_definition_id"], "subject_id")


@analysis(1701, "Number of records with cohort end date < cohort start date", family="INVERT")
def inverted_cohorts(cdm: Cdm) -> DataFrame:
    return inverted_dates(cdm["cohort"], "cohort_start_date", "cohort_end_date", "subject_id")
