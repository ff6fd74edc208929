"""Analyses of the person table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popscan.catalogue import BOTH, analysis
from popscan.cdm import Cdm
from popscan.operators import count_distinct, orphans


@analysis(0, "Source name", kind=BOTH)
def source_name(cdm: Cdm) -> DataFrame:
    persons = cdm["person"].agg(F.countDistinct("person_id").alias("count_value"))
    return persons.select(F.lit(cdm.source_name).alias("source_name"), "count_value")


@analysis(1, "Number of persons")
def persons(cdm: Cdm) -> DataFrame:
    return count_distinct(cdm["person"], [])


@analysis(2, "Number of persons by gender", ("gender_concept_id",))
def persons_by_gender(cdm: Cdm) -> DataFrame:
    return count_distinct(cdm["person"], ["gender_concept_id"])


@analysis(3, "Number of persons by year of birth", ("year_of_birth",))
def persons_by_year_of_birth(cdm: Cdm) -> DataFrame:
    return count_distinct(cdm["person"], ["year_of_birth"])


@analysis(4, "Number of persons by race", ("race_concept_id",))
def persons_by_race(cdm: Cdm) -> DataFrame:
    return count_distinct(cdm["person"], ["race_concept_id"])


@analysis(5, "Number of persons by ethnicity", ("ethnicity_concept_id",))
def persons_by_ethnicity(cdm: Cdm) -> DataFrame:
    return count_distinct(cdm["person"], ["ethnicity_concept_id"])


def _invalid(cdm: Cdm, key: str, parent: str) -> DataFrame:
    has_id = F.when(F.col("person_id").isNotNull(), 1).otherwise(0)
    return orphans(cdm["person"], key, cdm[parent], key, has_id)


@analysis(7, "Number of persons with invalid provider_id", family="ORPHAN")
def invalid_provider(cdm: Cdm) -> DataFrame:
    return _invalid(cdm, "provider_id", "provider")


@analysis(8, "Number of persons with invalid location_id", family="ORPHAN")
def invalid_location(cdm: Cdm) -> DataFrame:
    return _invalid(cdm, "location_id", "location")


@analysis(9, "Number of persons with invalid care_site_id", family="ORPHAN")
def invalid_care_site(cdm: Cdm) -> DataFrame:
    return _invalid(cdm, "care_site_id", "care_site")
