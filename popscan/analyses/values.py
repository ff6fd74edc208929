"""Distributions of recorded values: durations, prescriptions, lab results and their ranges.

Measures of one table are unpivoted and computed in one pass, the analysis
number being one more stratum.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popscan.analyses.domains import CONDITION_ERA, DRUG_ERA, VISIT
from popscan.catalogue import DIST, analysis, shared_analyses
from popscan.cdm import Cdm, Domain
from popscan.operators import distribution, relative_to_range


def unpivot(df: DataFrame, strata: Sequence[str], measures: Mapping[int, Column]) -> DataFrame:
    """``analysis_id, strata, value``: one row per input row and non-null measure."""
    # plain doubles by position: an array of structs would be boxed for every row
    long = df.select(*strata, F.posexplode(F.array(*[c.cast("double") for c in measures.values()])).alias("at", "value"))
    number = F.get(F.array(*[F.lit(i) for i in measures]), F.col("at"))
    return long.filter(F.col("value").isNotNull()).select(number.alias("analysis_id"), *strata, "value")


def _length(cdm: Cdm, d: Domain) -> DataFrame:
    days = cdm[d.table].select(d.concept, F.datediff(d.end, d.start).alias("days"))
    return distribution(days, [d.concept], "days", legacy=cdm.legacy)


@analysis(211, "Distribution of length of stay by visit_concept_id", ("visit_concept_id",), "DIST", DIST)
def length_of_stay(cdm: Cdm) -> DataFrame:
    return _length(cdm, VISIT)


@analysis(907, "Distribution of drug era length, by drug_concept_id", ("drug_concept_id",), "DIST", DIST)
def drug_era_length(cdm: Cdm) -> DataFrame:
    return _length(cdm, DRUG_ERA)


@analysis(
    1007, "Distribution of condition era length, by condition_concept_id", ("condition_concept_id",),
    "DIST", DIST,
)
def condition_era_length(cdm: Cdm) -> DataFrame:
    return _length(cdm, CONDITION_ERA)


_PRESCRIPTION = {715: "days_supply", 716: "refills", 717: "quantity"}


@shared_analyses(
    {i: f"Distribution of {c} by drug_concept_id" for i, c in _PRESCRIPTION.items()}, ("drug_concept_id",)
)
def prescriptions(cdm: Cdm, ids: Sequence[int]) -> DataFrame:
    long = unpivot(cdm["drug_exposure"], ["drug_concept_id"], {i: F.col(_PRESCRIPTION[i]) for i in ids})
    return distribution(
        long, ["analysis_id", "drug_concept_id"], "value", legacy=cdm.legacy, bounded=False
    )


def _with_ranges(table: str, concept: str, base: int, ids: Sequence[int], cdm: Cdm, legacy: bool) -> DataFrame:
    """Values (+15) of rows with a unit; limits (+16, +17) of rows with value and both limits."""
    complete = (
        F.col("value_as_number").isNotNull() & F.col("range_low").isNotNull() & F.col("range_high").isNotNull()
    )
    measures = {
        base + 15: F.col("value_as_number"),
        base + 16: F.when(complete, F.col("range_low")),
        base + 17: F.when(complete, F.col("range_high")),
    }
    rows = cdm[table].filter(F.col("unit_concept_id").isNotNull())
    strata = [concept, "unit_concept_id"]
    long = unpivot(rows, strata, {i: measures[i] for i in ids})
    return distribution(long, ["analysis_id", *strata], "value", legacy=legacy, bounded=False)


_OBS = "by observation_concept_id and unit_concept_id"
_MEAS = "by measurement_concept_id and unit_concept_id"


# the catalogue names no strata for these numbers, though their results have them
@shared_analyses({815: f"Distribution of numeric values, {_OBS}"})
def observation_values(cdm: Cdm, ids: Sequence[int]) -> DataFrame:
    return _with_ranges("observation", "observation_concept_id", 800, ids, cdm, cdm.legacy)


@shared_analyses(
    {816: f"Distribution of low range, {_OBS}", 817: f"Distribution of high range, {_OBS}"},
    family="DISTLEG",
    versions=("v4",),
)
def observation_ranges(cdm: Cdm, ids: Sequence[int]) -> DataFrame:
    return _with_ranges("observation", "observation_concept_id", 800, ids, cdm, legacy=True)


@analysis(
    818, f"Number of observation records below/within/above normal range, {_OBS}", family="RANGE",
    versions=("v4",),
)
def observation_bands(cdm: Cdm) -> DataFrame:
    return relative_to_range(cdm["observation"], "observation_concept_id", "unit_concept_id")


@shared_analyses(
    {
        1815: f"Distribution of numeric values, {_MEAS}",
        1816: f"Distribution of low range, {_MEAS}",
        1817: f"Distribution of high range, {_MEAS}",
    },
    versions=("v5",),
)
def measurement_values(cdm: Cdm, ids: Sequence[int]) -> DataFrame:
    return _with_ranges("measurement", "measurement_concept_id", 1800, ids, cdm, cdm.legacy)


@analysis(
    1818, f"Number of measurement records below/within/above normal range, {_MEAS}", family="RANGE",
    versions=("v5",),
)
def measurement_bands(cdm: Cdm) -> DataFrame:
    return relative_to_range(cdm["measurement"], "measurement_concept_id", "unit_concept_id")
