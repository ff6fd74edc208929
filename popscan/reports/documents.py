"""JSON documents assembled from the report queries.

Summary documents are one row each: their sections are bounded by months,
ages and genders. Treemaps stay one row per node, and detail documents are one
row per concept, joined and serialised by Spark, so that the number of
concepts never meets one task. Tables inside a document are column-wise:
``{"CATEGORY": [...], "MIN_VALUE": [...]}``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popscan.reports.hierarchy import Vocabulary
from popscan.reports.queries import BOX, REPORTS, report
from popscan.results import ResultSet

_BOX = ("category", *BOX)
_LABEL = ("concept_id", "concept_name", "count_value")
_NAME_COUNT = ("concept_name", "count_value")
_BY_YEAR = ("trellis_name", "series_name", "x_calendar_year", "y_prevalence_1000pp")
_BY_MONTH = ("x_calendar_month", "y_prevalence_1000pp")
_HISTOGRAM = ("interval_index", "count_value", "percent_value")


@dataclass(frozen=True)
class Section:
    """A report query as a table inside a document."""

    query: str
    columns: Sequence[str]
    descending: bool = False
    concept: str = "concept_id"  # key column, in detail documents


@dataclass(frozen=True)
class Histogram:
    """A histogram with its axis, taken from a query or fixed."""

    data: Section
    stats: str | None = None
    fixed: tuple[int, int, int] | None = None  # min, max, interval size


# Sections of each document.
_PERSON: dict[str, Section | Histogram] = {
    "SUMMARY": Section("person_population", ("attribute_name", "attribute_value"), descending=True),
    "GENDER_DATA": Section("person_gender", _LABEL),
    "RACE_DATA": Section("person_race", _LABEL),
    "ETHNICITY_DATA": Section("person_ethnicity", _LABEL),
    "BIRTH_YEAR_HISTOGRAM": Histogram(
        Section("person_year_of_birth_data", _HISTOGRAM), "person_year_of_birth_stats"
    ),
}
_PERIOD: dict[str, Section | Histogram] = {
    "AGE_AT_FIRST_OBSERVATION_HISTOGRAM": Histogram(
        Section("observationperiod_age_at_first", _HISTOGRAM), fixed=(0, 100, 1)
    ),
    "AGE_BY_GENDER": Section("observationperiod_age_by_gender", _BOX),
    "OBSERVATION_LENGTH_HISTOGRAM": Histogram(
        Section("observationperiod_length_data", _HISTOGRAM), "observationperiod_length_stats"
    ),
    "CUMULATIVE_DURATION": Section(
        "observationperiod_cumulative_duration",
        ("series_name", "x_length_of_observation", "y_percent_persons"),
    ),
    "OBSERVATION_PERIOD_LENGTH_BY_GENDER": Section("observationperiod_length_by_gender", _BOX),
    "OBSERVATION_PERIOD_LENGTH_BY_AGE": Section("observationperiod_length_by_age", _BOX),
    "OBSERVED_BY_YEAR_HISTOGRAM": Histogram(
        Section("observationperiod_observed_by_year_data", _HISTOGRAM), "observationperiod_observed_by_year_stats"
    ),
    "OBSERVED_BY_MONTH": Section(
        "observationperiod_observed_by_month", ("month_year", "count_value", "percent_value")
    ),
    "PERSON_PERIODS_DATA": Section("observationperiod_periods_per_person", _LABEL),
}
DOCUMENTS: dict[str, Mapping[str, Section | Histogram]] = {
    "person": _PERSON,
    "observationperiod": _PERIOD,
    "dashboard": {
        **{k: _PERSON[k] for k in ("SUMMARY", "GENDER_DATA")},
        **{k: _PERIOD[k] for k in ("AGE_AT_FIRST_OBSERVATION_HISTOGRAM", "CUMULATIVE_DURATION", "OBSERVED_BY_MONTH")},
    },
    "datadensity": {
        "TOTAL_RECORDS": Section(
            "datadensity_total_records", ("series_name", "x_calendar_month", "y_record_count")
        ),
        "RECORDS_PER_PERSON": Section(
            "datadensity_records_per_person", ("series_name", "x_calendar_month", "y_record_count")
        ),
        "CONCEPTS_PER_PERSON": Section("datadensity_concepts_per_person", _BOX),
    },
    "death": {
        "PREVALENCE_BY_GENDER_AGE_YEAR": Section("death_prevalence_by_gender_age_year", _BY_YEAR),
        "PREVALENCE_BY_MONTH": Section("death_prevalence_by_month", _BY_MONTH),
        "DEATH_BY_TYPE": Section("death_by_type", _LABEL),
        "AGE_AT_DEATH": Section("death_age_at_death", _BOX),
    },
    "heel": {"MESSAGES": Section("heel_messages", ("attributename", "attributevalue"))},
}


def _prevalence(domain: str) -> dict[str, Section]:
    return {
        "PREVALENCE_BY_GENDER_AGE_YEAR": Section(f"{domain}_prevalence_by_gender_age_year", _BY_YEAR),
        "PREVALENCE_BY_MONTH": Section(f"{domain}_prevalence_by_month", _BY_MONTH),
    }


def _ranges(domain: str) -> dict[str, Section]:
    key = f"{domain}_concept_id"
    return {
        "RECORDS_BY_UNIT": Section(f"{domain}_records_by_unit", _NAME_COUNT, concept=key),
        f"{domain.upper()}_VALUE_DISTRIBUTION": Section(f"{domain}_value_distribution", _BOX),
        "LOWER_LIMIT_DISTRIBUTION": Section(f"{domain}_lower_limit_distribution", _BOX),
        "UPPER_LIMIT_DISTRIBUTION": Section(f"{domain}_upper_limit_distribution", _BOX),
        "VALUES_RELATIVE_TO_NORM": Section(f"{domain}_values_relative_to_norm", _NAME_COUNT, concept=key),
    }


def _drug_box(query: str) -> Section:
    return Section(query, _BOX, concept="drug_concept_id")


# domain -> (folder, file prefix, sections)
DETAILS: dict[str, tuple[str, str, dict[str, Section]]] = {
    "condition": ("conditions", "condition", {
        **_prevalence("condition"),
        "CONDITIONS_BY_TYPE": Section("condition_by_type", _NAME_COUNT, concept="condition_concept_id"),
        "AGE_AT_FIRST_DIAGNOSIS": Section("condition_age_at_first_diagnosis", _BOX),
    }),
    "conditionera": ("conditioneras", "condition", {
        **_prevalence("conditionera"),
        "LENGTH_OF_ERA": Section("conditionera_length_of_era", _BOX),
        "AGE_AT_FIRST_DIAGNOSIS": Section("conditionera_age_at_first_diagnosis", _BOX),
    }),
    "drugera": ("drugeras", "drug", {
        "AGE_AT_FIRST_EXPOSURE": Section("drugera_age_at_first_exposure", _BOX),
        **_prevalence("drugera"),
        "LENGTH_OF_ERA": Section("drugera_length_of_era", _BOX),
    }),
    "drug": ("drugs", "drug", {
        "AGE_AT_FIRST_EXPOSURE": _drug_box("drug_age_at_first_exposure"),
        "DAYS_SUPPLY_DISTRIBUTION": _drug_box("drug_days_supply_distribution"),
        "DRUGS_BY_TYPE": Section("drug_by_type", _NAME_COUNT, concept="drug_concept_id"),
        **_prevalence("drug"),
        "QUANTITY_DISTRIBUTION": _drug_box("drug_quantity_distribution"),
        "REFILLS_DISTRIBUTION": _drug_box("drug_refills_distribution"),
    }),
    "procedure": ("procedures", "procedure", {
        **_prevalence("procedure"),
        "PROCEDURES_BY_TYPE": Section("procedure_by_type", _NAME_COUNT, concept="procedure_concept_id"),
        "AGE_AT_FIRST_OCCURRENCE": Section("procedure_age_at_first_occurrence", _BOX),
    }),
    "measurement": ("measurements", "measurement", {
        **_prevalence("measurement"),
        "MEASUREMENTS_BY_TYPE": Section("measurement_by_type", _NAME_COUNT, concept="measurement_concept_id"),
        "AGE_AT_FIRST_OCCURRENCE": Section("measurement_age_at_first_occurrence", _BOX),
        **_ranges("measurement"),
    }),
    "observation": ("observations", "observation", {
        **_prevalence("observation"),
        "OBSERVATIONS_BY_TYPE": Section("observation_by_type", _NAME_COUNT, concept="observation_concept_id"),
        "AGE_AT_FIRST_OCCURRENCE": Section("observation_age_at_first_occurrence", _BOX),
        **_ranges("observation"),  # version 4 only
    }),
    "visit": ("visits", "visit", {
        **_prevalence("visit"),
        "VISIT_DURATION_BY_TYPE": Section("visit_duration_by_type", _BOX),
        "AGE_AT_FIRST_OCCURRENCE": Section("visit_age_at_first_occurrence", _BOX),
    }),
}


def _rows(section: Section) -> Column:
    """Collected rows of a section, in a fixed order."""
    row = F.struct(*section.columns)
    return F.sort_array(F.collect_list(row), asc=not section.descending)


def _columnwise(rows: Column, columns: Sequence[str]) -> Column:
    return F.struct(*[rows.getField(c).alias(c.upper()) for c in columns])


def _table(section: Section, r: ResultSet, v: Vocabulary) -> Column:
    one = report(section.query, r, v).agg(_rows(section).alias("rows"))
    return one.select(_columnwise(F.col("rows"), section.columns).alias("t")).scalar()


def _part(part: Section | Histogram, r: ResultSet, v: Vocabulary) -> Column:
    if isinstance(part, Section):
        return _table(part, r, v)
    if part.fixed is not None:
        low, high, size = (F.lit(x) for x in part.fixed)
        axis = F.struct(
            low.alias("MIN"), high.alias("MAX"), size.alias("INTERVAL_SIZE"),
            ((high - low) / size).alias("INTERVALS"),
        )
    else:
        stats = report(part.stats, r, v).select(
            F.struct(
                F.col("min_value").alias("MIN"), F.col("max_value").alias("MAX"),
                F.col("interval_size").alias("INTERVAL_SIZE"),
                ((F.col("max_value") - F.col("min_value")) / F.col("interval_size")).alias("INTERVALS"),
            ).alias("s")
        )
        axis = stats.scalar()
    fields = ("MIN", "MAX", "INTERVAL_SIZE", "INTERVALS")
    return F.struct(*[axis.getField(f).alias(f) for f in fields], _table(part.data, r, v).alias("DATA"))


def document(name: str, results: ResultSet, vocabulary: Vocabulary) -> DataFrame:
    """A summary document as one row: ``path, document``."""
    parts = [_part(p, results, vocabulary).alias(k) for k, p in DOCUMENTS[name].items()]
    # a row to hang the sections on; each section is a scalar subquery
    row = results.spark.range(1)
    return row.select(F.lit(f"{name}.json").alias("path"), F.to_json(F.struct(*parts)).alias("document"))


def treemap_rows(domain: str, results: ResultSet, vocabulary: Vocabulary) -> DataFrame:
    """A treemap, one JSON object per node: ``path, document``."""
    df = report(f"{domain}_treemap", results, vocabulary)
    upper = F.struct(*[F.col(c).alias(c.upper()) for c in df.columns])
    return df.select(F.lit(f"{domain}_treemap.json").alias("path"), F.to_json(upper).alias("document"))


def concept_documents(domain: str, results: ResultSet, vocabulary: Vocabulary) -> DataFrame:
    """One document per concept of the domain's treemap: ``path, concept_id, document``."""
    folder, prefix, sections = DETAILS[domain]
    sections = {k: s for k, s in sections.items() if vocabulary.version in REPORTS[s.query].versions}
    out = report(f"{domain}_treemap", results, vocabulary).select("concept_id").distinct()
    for key, s in sections.items():
        rows = report(s.query, results, vocabulary).groupBy(F.col(s.concept).alias("concept_id")).agg(_rows(s).alias(key))
        out = out.join(rows, "concept_id", "left")
    parts = [
        F.when(F.col(k).isNotNull(), _columnwise(F.col(k), s.columns))
        .otherwise(_columnwise(F.filter(F.col(k), lambda x: F.lit(False)), s.columns))
        .alias(k)
        for k, s in sections.items()
    ]
    name = F.concat(F.lit(f"{folder}/{prefix}_"), F.col("concept_id").cast("string"), F.lit(".json"))
    return out.select(name.alias("path"), "concept_id", F.to_json(F.struct(*parts)).alias("document"))


# Report names as users ask for them -> the documents they consist of.
_CATEGORIES: dict[str, str] = {
    "CONDITION": "condition", "CONDITION_ERA": "conditionera", "DRUG": "drug", "DRUG_ERA": "drugera",
    "PROCEDURE": "procedure", "MEASUREMENT": "measurement", "OBSERVATION": "observation", "VISIT": "visit",
}
_SUMMARIES: dict[str, str] = {
    "HEEL": "heel", "DATA_DENSITY": "datadensity", "DEATH": "death", "PERSON": "person",
    "OBSERVATION_PERIOD": "observationperiod", "DASHBOARD": "dashboard",
}
ALL_REPORTS = (*_SUMMARIES, *_CATEGORIES)


def show_report_types() -> tuple[str, ...]:
    """Names accepted by ``export_reports``."""
    return ALL_REPORTS


def export_reports(
    results: ResultSet,
    vocabulary: Vocabulary,
    output: str,
    reports: Sequence[str] = ALL_REPORTS,
) -> list[str]:
    """Write reports as JSON below ``output``; returns the folders written.

    Summaries and treemaps become text folders of JSON, details one JSON-lines
    folder per domain with ``path``, ``concept_id`` and ``document``. Store the
    results first (``run_analyses``): they are read many times.
    """
    unknown = [n for n in reports if n not in ALL_REPORTS]
    if unknown:
        raise ValueError(f"unknown reports: {unknown}")
    written = []

    def write(df: DataFrame, folder: str, put: Callable[[DataFrame, str], None]) -> None:
        put(df, f"{output}/{folder}")
        written.append(folder)

    def as_text(df: DataFrame, path: str) -> None:
        df.select("document").write.mode("overwrite").text(path)

    def as_json(df: DataFrame, path: str) -> None:
        df.write.mode("overwrite").json(path)

    for n in reports:
        if n in _SUMMARIES:
            write(document(_SUMMARIES[n], results, vocabulary), f"{_SUMMARIES[n]}.json", as_text)
            continue
        domain = _CATEGORIES[n]
        if vocabulary.version not in REPORTS[f"{domain}_treemap"].versions:
            continue
        write(treemap_rows(domain, results, vocabulary), f"{domain}_treemap.json", as_text)
        write(concept_documents(domain, results, vocabulary), DETAILS[domain][0], as_json)
    return written
