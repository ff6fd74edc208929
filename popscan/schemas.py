"""Table schemas: result tables, clinical tables of data model version 5, vocabulary."""

from __future__ import annotations

from pyspark.sql import types as T

_STRATA = [T.StructField(f"stratum_{i}", T.StringType()) for i in range(1, 6)]

ANALYSIS = T.StructType(
    [
        T.StructField("analysis_id", T.IntegerType(), False),
        T.StructField("analysis_name", T.StringType()),
        *[T.StructField(f"stratum_{i}_name", T.StringType()) for i in range(1, 6)],
    ]
)

RESULTS = T.StructType(
    [T.StructField("analysis_id", T.IntegerType()), *_STRATA, T.StructField("count_value", T.LongType())]
)

RESULTS_DIST = T.StructType(
    [
        *RESULTS.fields,
        *[
            T.StructField(name, T.DoubleType())
            for name in (
                "min_value", "max_value", "avg_value", "stdev_value",
                "median_value", "p10_value", "p25_value", "p75_value", "p90_value",
            )
        ],
    ]
)

#: Person sketches of an analysis by stratum and month.
SUMMARIES = T.StructType(
    [
        T.StructField("analysis_id", T.IntegerType()),
        T.StructField("stratum_1", T.StringType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("records", T.LongType()),
        T.StructField("persons", T.BinaryType()),
    ]
)

HEEL_RESULTS = T.StructType(
    [
        T.StructField("analysis_id", T.IntegerType()),
        T.StructField("heel_warning", T.StringType()),
        T.StructField("rule_id", T.IntegerType()),
        T.StructField("record_count", T.LongType()),
    ]
)

# Column names of the clinical data model, version 5.
# Types: L long, I int, D date, F double, S string; "!" = not null.
_CDM: dict[str, str] = {
    "person": "person_id L!, gender_concept_id I, year_of_birth I, month_of_birth I, day_of_birth I, "
    "race_concept_id I, ethnicity_concept_id I, location_id L, provider_id L, care_site_id L, "
    "person_source_value S, gender_source_value S, race_source_value S, ethnicity_source_value S",
    "observation_period": "observation_period_id L!, person_id L, observation_period_start_date D, "
    "observation_period_end_date D",
    "visit_occurrence": "visit_occurrence_id L!, person_id L, visit_concept_id I, visit_start_date D, "
    "visit_end_date D, visit_type_concept_id I, provider_id L, care_site_id L, visit_source_value S, "
    "visit_source_concept_id I",
    "condition_occurrence": "condition_occurrence_id L!, person_id L, condition_concept_id I, "
    "condition_start_date D, condition_end_date D, condition_type_concept_id I, "
    "provider_id L, visit_occurrence_id L, condition_source_value S, condition_source_concept_id I",
    "procedure_occurrence": "procedure_occurrence_id L!, person_id L, procedure_concept_id I, "
    "procedure_date D, procedure_type_concept_id I, modifier_concept_id I, quantity F, provider_id L, "
    "visit_occurrence_id L, procedure_source_value S, procedure_source_concept_id I, "
    "qualifier_source_value S",
    "drug_exposure": "drug_exposure_id L!, person_id L, drug_concept_id I, drug_exposure_start_date D, "
    "drug_exposure_end_date D, drug_type_concept_id I, stop_reason S, refills I, quantity F, "
    "days_supply I, sig S, route_concept_id I, effective_drug_dose F, dose_unit_concept_id I, "
    "lot_number S, provider_id L, visit_occurrence_id L, drug_source_value S, drug_source_concept_id I, "
    "route_source_value S, dose_unit_source_value S",
    "device_exposure": "device_exposure_id L!, person_id L, device_concept_id I, "
    "device_exposure_start_date D, device_exposure_end_date D, device_type_concept_id I, "
    "unique_device_id S, quantity F, provider_id L, visit_occurrence_id L, device_source_value S, "
    "device_source_concept_id I",
    "observation": "observation_id L!, person_id L, observation_concept_id I, observation_date D, "
    "observation_time S, value_as_number F, value_as_string S, value_as_concept_id I, "
    "qualifier_concept_id I, unit_concept_id I, observation_type_concept_id I, provider_id L, "
    "visit_occurrence_id L, observation_source_value S, observation_source_concept_id I, "
    "unit_source_value S, qualifier_source_value S",
    "measurement": "measurement_id L!, person_id L, measurement_concept_id I, measurement_date D, "
    "measurement_type_concept_id I, value_as_number F, value_as_concept_id I, unit_concept_id I, "
    "range_low F, range_high F, provider_id L, visit_occurrence_id L",
    "drug_era": "drug_era_id L!, person_id L, drug_concept_id I, drug_era_start_date D, "
    "drug_era_end_date D, drug_exposure_count I",
    "dose_era": "dose_era_id L!, person_id L, drug_concept_id I, unit_concept_id I, dose_value F, "
    "dose_era_start_date D, dose_era_end_date D",
    "condition_era": "condition_era_id L!, person_id L, condition_concept_id I, "
    "condition_era_start_date D, condition_era_end_date D, condition_occurrence_count I",
    "death": "person_id L, death_date D, death_type_concept_id I, cause_concept_id I, "
    "cause_source_value S, cause_source_concept_id I",
    "provider": "provider_id L!, npi S, dea S, specialty_concept_id I, care_site_id L, "
    "provider_source_value S, specialty_source_value S",
    "location": "location_id L!, address_1 S, address_2 S, city S, state S, zip S, county S, "
    "location_source_value S",
    "care_site": "care_site_id L!, location_id L, place_of_service_concept_id I, "
    "care_site_source_value S, place_of_service_source_value S",
    "payer_plan_period": "payer_plan_period_id L!, person_id L, payer_plan_period_start_date D, "
    "payer_plan_period_end_date D, payer_source_value S, plan_source_value S, family_source_value S",
    "drug_cost": "drug_cost_id L!, drug_exposure_id L, currency_concept_id I, paid_copay F, "
    "paid_coinsurance F, paid_toward_deductible F, paid_by_payer F, paid_by_coordination_benefits F, "
    "total_out_of_pocket F, total_paid F, ingredient_cost F, dispensing_fee F, "
    "average_wholesale_price F, payer_plan_period_id L",
    "procedure_cost": "procedure_cost_id L!, procedure_occurrence_id L, currency_concept_id I, "
    "paid_copay F, paid_coinsurance F, paid_toward_deductible F, paid_by_payer F, "
    "paid_by_coordination_benefits F, total_out_of_pocket F, total_paid F, revenue_code_concept_id I, "
    "payer_plan_period_id L, revenue_code_source_value S",
    "cohort": "cohort_definition_id I, cohort_start_date D, cohort_end_date D, subject_id L",
    "concept": "concept_id I!, concept_name S, domain_id S, vocabulary_id S, concept_class_id S, "
    "concept_code S",
    "concept_ancestor": "ancestor_concept_id I, descendant_concept_id I, min_levels_of_separation I",
    "vocabulary": "vocabulary_id S, vocabulary_name S",
}

_TYPES = {
    "L": T.LongType(),
    "I": T.IntegerType(),
    "D": T.DateType(),
    "F": T.DoubleType(),
    "S": T.StringType(),
}


def _parse(columns: str) -> T.StructType:
    fields = []
    for column in columns.split(","):
        name, kind = column.split()
        fields.append(T.StructField(name, _TYPES[kind[0]], not kind.endswith("!")))
    return T.StructType(fields)

# Version 4 of the model.
_CDM_V4: dict[str, str] = {
    "care_site": "care_site_id L!, location_id L, organization_id L, place_of_service_concept_id I, "
    "care_site_source_value S, place_of_service_source_value S",
    "cohort": "cohort_id L!, cohort_concept_id I, cohort_start_date D, cohort_end_date D, subject_id L, "
    "stop_reason S",
    "condition_era": "condition_era_id L!, person_id L, condition_concept_id I, condition_era_start_date D, "
    "condition_era_end_date D, condition_type_concept_id I, condition_occurrence_count I",
    "condition_occurrence": "condition_occurrence_id L!, person_id L, condition_concept_id I, "
    "condition_start_date D, condition_end_date D, condition_type_concept_id I, stop_reason S, "
    "associated_provider_id L, visit_occurrence_id L, condition_source_value S",
    "death": "person_id L, death_date D, death_type_concept_id I, cause_of_death_concept_id I, "
    "cause_of_death_source_value S",
    "drug_cost": "drug_cost_id L!, drug_exposure_id L, paid_copay F, paid_coinsurance F, "
    "paid_toward_deductible F, paid_by_payer F, paid_by_coordination_benefits F, total_out_of_pocket F, "
    "total_paid F, ingredient_cost F, dispensing_fee F, average_wholesale_price F, payer_plan_period_id L",
    "drug_era": "drug_era_id L!, person_id L, drug_concept_id I, drug_era_start_date D, "
    "drug_era_end_date D, drug_type_concept_id I, drug_exposure_count I",
    "drug_exposure": "drug_exposure_id L!, person_id L, drug_concept_id I, drug_exposure_start_date D, "
    "drug_exposure_end_date D, drug_type_concept_id I, stop_reason S, refills I, quantity F, "
    "days_supply I, sig S, prescribing_provider_id L, visit_occurrence_id L, "
    "relevant_condition_concept_id I, drug_source_value S",
    "location": _CDM["location"],
    "observation": "observation_id L!, person_id L, observation_concept_id I, observation_date D, "
    "observation_time S, value_as_number F, value_as_string S, value_as_concept_id I, unit_concept_id I, "
    "range_low F, range_high F, observation_type_concept_id I, associated_provider_id L, "
    "visit_occurrence_id L, relevant_condition_concept_id I, observation_source_value S, "
    "unit_source_value S",
    "observation_period": _CDM["observation_period"],
    "organization": "organization_id L!, place_of_service_concept_id I, location_id L, "
    "organization_source_value S, place_of_service_source_value S",
    "payer_plan_period": _CDM["payer_plan_period"],
    "person": _CDM["person"],
    "procedure_cost": "procedure_cost_id L!, procedure_occurrence_id L, paid_copay F, paid_coinsurance F, "
    "paid_toward_deductible F, paid_by_payer F, paid_by_coordination_benefits F, total_out_of_pocket F, "
    "total_paid F, disease_class_concept_id I, revenue_code_concept_id I, payer_plan_period_id L, "
    "disease_class_source_value S, revenue_code_source_value S",
    "procedure_occurrence": "procedure_occurrence_id L!, person_id L, procedure_concept_id I, "
    "procedure_date D, procedure_type_concept_id I, associated_provider_id L, visit_occurrence_id L, "
    "relevant_condition_concept_id I, procedure_source_value S",
    "provider": _CDM["provider"],
    "visit_occurrence": "visit_occurrence_id L!, person_id L, visit_start_date D, visit_end_date D, "
    "place_of_service_concept_id I, care_site_id L, place_of_service_source_value S",
    "concept": "concept_id I!, concept_name S, concept_level I, concept_class S, vocabulary_id I, "
    "concept_code S",
    "concept_ancestor": _CDM["concept_ancestor"],
    "vocabulary": "vocabulary_id I, vocabulary_name S",
}

CDM: dict[str, dict[str, T.StructType]] = {
    "v5": {name: _parse(columns) for name, columns in _CDM.items()},
    "v4": {name: _parse(columns) for name, columns in _CDM_V4.items()},
}

# Version 4 column names and what version 5 calls them (fixed values).
V4_RENAMES: dict[str, dict[str, str]] = {
    "visit_occurrence": {"place_of_service_concept_id": "visit_concept_id"},
    "condition_occurrence": {"associated_provider_id": "provider_id"},
    "procedure_occurrence": {"associated_provider_id": "provider_id"},
    "drug_exposure": {"prescribing_provider_id": "provider_id"},
    "observation": {"associated_provider_id": "provider_id"},
    "death": {"cause_of_death_concept_id": "cause_concept_id"},
    "cohort": {"cohort_concept_id": "cohort_definition_id"},
    "concept": {"concept_class": "concept_class_id"},
}
