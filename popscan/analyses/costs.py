"""Analyses of the drug and procedure cost tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popscan.analyses.values import unpivot
from popscan.catalogue import analysis, shared_analyses
from popscan.cdm import Cdm
from popscan.operators import Check, count_rows, distribution, orphan_check, orphans, spread_join

# column and wording of the measures, in the order of their numbers (fixed values)
_MEASURES = (
    ("paid_copay", "paid copay"),
    ("paid_coinsurance", "paid coinsurance"),
    ("paid_toward_deductible", "paid toward deductible"),
    ("paid_by_payer", "paid by payer"),
    ("paid_by_coordination_benefits", "paid by coordination of benefit"),
    ("total_out_of_pocket", "total out-of-pocket"),
    ("total_paid", "total paid"),
    ("ingredient_cost", "ingredient_cost"),
    ("dispensing_fee", "dispensing fee"),
    ("average_wholesale_price", "average wholesale price"),
)
_DRUG = dict(enumerate(_MEASURES, 1502))
_PROCEDURE = dict(enumerate(_MEASURES[:7], 1602))


def _costs(
    cdm: Cdm, cost: str, key: str, event: str, concept: str, columns: dict, ids: Sequence[int]
) -> DataFrame:
    mapped = cdm[event].filter(F.col(concept) != 0).select(key, concept)
    wanted = {i: columns[i][0] for i in ids}
    # rows without any of the measures have nothing to tell; ids that do not match any event are often one and the same
    told = cdm[cost].select(key, *wanted.values()).dropna("all", subset=list(wanted.values()))
    joined = spread_join(told, mapped, key)
    long = unpivot(joined, [concept], {i: F.col(c) for i, c in wanted.items()})
    return distribution(long, ["analysis_id", concept], "value", legacy=cdm.legacy, bounded=False)


@shared_analyses(
    {i: f"Distribution of {words}, by drug_concept_id" for i, (_, words) in _DRUG.items()},
    ("drug_concept_id",),
)
def drug_costs(cdm: Cdm, ids: Sequence[int]) -> DataFrame:
    return _costs(cdm, "drug_cost", "drug_exposure_id", "drug_exposure", "drug_concept_id", _DRUG, ids)


@shared_analyses(
    {i: f"Distribution of {words}, by procedure_concept_id" for i, (_, words) in _PROCEDURE.items()},
    ("procedure_concept_id",),
)
def procedure_costs(cdm: Cdm, ids: Sequence[int]) -> DataFrame:
    return _costs(
        cdm, "procedure_cost", "procedure_occurrence_id", "procedure_occurrence", "procedure_concept_id",
        _PROCEDURE, ids,
    )


def _orphan_check(cost: str, key: str, parent: str, keep_null: bool) -> Check:
    return orphan_check(key, parent, key, f"{cost}_id", keep_null)


def _orphans(cdm: Cdm, cost: str, key: str, parent: str, keep_null: bool) -> DataFrame:
    has_id = F.when(F.col(f"{cost}_id").isNotNull(), 1).otherwise(0)
    return orphans(cdm[cost], key, cdm[parent], key, has_id, keep_null_fk=keep_null)


@analysis(
    1500, "Number of drug cost records with invalid drug exposure id", family="ORPHAN",
    check=("drug_cost", _orphan_check("drug_cost", "drug_exposure_id", "drug_exposure", True)),
)
def drug_costs_without_exposure(cdm: Cdm) -> DataFrame:
    return _orphans(cdm, "drug_cost", "drug_exposure_id", "drug_exposure", True)


@analysis(
    1501, "Number of drug cost records with invalid payer plan period id", family="ORPHAN",
    check=("drug_cost", _orphan_check("drug_cost", "payer_plan_period_id", "payer_plan_period", False)),
)
def drug_costs_without_plan(cdm: Cdm) -> DataFrame:
    return _orphans(cdm, "drug_cost", "payer_plan_period_id", "payer_plan_period", False)


@analysis(
    1600, "Number of procedure cost records with invalid procedure occurrence id", family="ORPHAN",
    check=("procedure_cost", _orphan_check("procedure_cost", "procedure_occurrence_id", "procedure_occurrence", True)),
)
def procedure_costs_without_procedure(cdm: Cdm) -> DataFrame:
    return _orphans(cdm, "procedure_cost", "procedure_occurrence_id", "procedure_occurrence", True)


@analysis(
    1601, "Number of procedure cost records with invalid payer plan period id", family="ORPHAN",
    check=("procedure_cost", _orphan_check("procedure_cost", "payer_plan_period_id", "payer_plan_period", False)),
)
def procedure_costs_without_plan(cdm: Cdm) -> DataFrame:
    return _orphans(cdm, "procedure_cost", "payer_plan_period_id", "payer_plan_period", False)


def _records_by(cdm: Cdm, column: str) -> DataFrame:
    return count_rows(cdm["procedure_cost"].filter(F.col(column).isNotNull()), [column], "procedure_cost_id")


@analysis(
    1609, "Number of records by disease_class_concept_id", ("disease_class_concept_id",), versions=("v4",)
)
def records_by_disease_class(cdm: Cdm) -> DataFrame:
    return _records_by(cdm, "disease_class_concept_id")


@analysis(1610, "Number of records by revenue_code_concept_id", ("revenue_code_concept_id",))
def records_by_revenue_code(cdm: Cdm) -> DataFrame:
    return _records_by(cdm, "revenue_code_concept_id")
