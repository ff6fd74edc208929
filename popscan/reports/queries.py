"""The report queries: labelled counts, box plots, prevalences, histograms, treemaps.

Each report reads slices of a ``ResultSet`` and the vocabulary. Slices are
aggregates, so joins here are small next to the analyses; Spark still chooses
their strategy by size, nothing is broadcast by hand.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from popscan.catalogue import analyses
from popscan.functions import decile_label, ratio
from popscan.heel import fetch_heel, run_heel
from popscan.reports import hierarchy
from popscan.reports.hierarchy import Vocabulary
from popscan.results import ResultSet

BOX = ("min_value", "p10_value", "p25_value", "median_value", "p75_value", "p90_value", "max_value")
GENDERS = (8507, 8532)  # fixed value: genders shown in reports

Build = Callable[[ResultSet, Vocabulary], DataFrame]


@dataclass(frozen=True)
class Report:
    name: str
    kind: str
    build: Build
    versions: tuple[str, ...] = ("v4", "v5")


REPORTS: dict[str, Report] = {}


def _add(name: str, kind: str, build: Build, versions: tuple[str, ...] = ("v4", "v5")) -> None:
    REPORTS[name] = Report(name, kind, build, versions)


def report(name: str, results: ResultSet, vocabulary: Vocabulary) -> DataFrame:
    return REPORTS[name].build(results, vocabulary)


def _label(v: Vocabulary, stratum: str, concept_id: str, concept_name: str) -> DataFrame:
    """Concept ids as result strata with id and name under the given headings."""
    return v.concept.select(
        F.col("concept_id").cast("string").alias(stratum),
        F.col("concept_id").alias(concept_id),
        F.col("concept_name").alias(concept_name),
    )


def _persons(r: ResultSet) -> Column:
    """The number of persons, as a scalar subquery."""
    return r.counts(1).select("count_value").scalar()


def _int(stratum: str) -> Column:
    return F.col(stratum).try_cast("int")


# --- labelled counts


def _counts_by_concept(number: int, only: tuple[int, ...] | None = None) -> Build:
    def build(r: ResultSet, v: Vocabulary) -> DataFrame:
        df = r.counts(number).join(_label(v, "stratum_1", "concept_id", "concept_name"), "stratum_1")
        if only is not None:
            df = df.filter(F.col("concept_id").isin(*only))
        return df.select("concept_id", "concept_name", "count_value")

    return build


def _counts_by_two(number: int, first: str, with_name: bool = True, joiner: str | None = None) -> Build:
    """Counts by concept and a second concept; ``joiner`` appends the third stratum to its name."""

    def build(r: ResultSet, v: Vocabulary) -> DataFrame:
        df = (
            r.counts(number)
            .join(_label(v, "stratum_1", f"{first}_concept_id", f"{first}_concept_name"), "stratum_1")
            .join(_label(v, "stratum_2", "concept_id", "concept_name"), "stratum_2")
        )
        if joiner is not None:
            df = df.withColumn("concept_name", F.concat_ws(joiner, "concept_name", "stratum_3"))
        heads = [f"{first}_concept_id", *([f"{first}_concept_name"] if with_name else [])]
        return df.select(*heads, "concept_id", "concept_name", "count_value")

    return build


def _conditions_by_type(r: ResultSet, v: Vocabulary) -> DataFrame:
    """Condition records by type, claim types grouped by setting and position."""
    name = F.col("concept_name")
    inpatient, outpatient = name.like("Inpatient%"), name.like("Outpatient%")
    claim = inpatient | outpatient
    primary = name.like("%primary%") | name.like("%1st position%")
    # fixed values: group numbers and wording
    setting_id = F.when(inpatient, 10).when(outpatient, 20).otherwise(F.col("concept_id")).cast("string")
    position_id = F.when(claim & primary, "1").when(claim & ~primary, "2").otherwise("0")
    setting = F.when(inpatient, "Claim- Inpatient: ").when(outpatient, "Claim- Outpatient: ").otherwise(name)
    position = (
        F.when(claim & primary, "Primary diagnosis").when(claim & ~primary, "Secondary diagnosis").otherwise("")
    )
    types = v.concept.filter(v.rules.condition_type).select(
        F.col("concept_id").cast("string").alias("stratum_2"),
        F.concat_ws("", setting_id, position_id).alias("concept_id"),
        F.concat_ws(" ", setting, position).alias("concept_name"),
    )
    df = (
        r.counts(405)
        .join(_label(v, "stratum_1", "condition_concept_id", "condition_concept_name"), "stratum_1")
        .join(types, "stratum_2")
    )
    keys = ["condition_concept_id", "condition_concept_name", "concept_id", "concept_name"]
    return df.groupBy(*keys).agg(F.sum("count_value").alias("count_value"))


_SERIES = {  # fixed values: month series and their names
    220: "Visit occurrence", 420: "Condition occurrence", 502: "Death", 620: "Procedure occurrence",
    720: "Drug exposure", 820: "Observation", 920: "Drug era", 1020: "Condition era",
    111: "Observation period",
}
_CONCEPTS_PER_PERSON = {  # fixed values
    403: "Condition occurrence", 603: "Procedure occurrence", 703: "Drug exposure", 803: "Observation",
    903: "Drug era", 1003: "Condition era",
}


def _named_by_id(names: Mapping[int, str]) -> Column:
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for number, name in names.items():
        out = out.when(F.col("analysis_id") == number, name)
    return out


def _monthly(r: ResultSet) -> DataFrame:
    return r.counts(*_SERIES).select(
        _named_by_id(_SERIES).alias("series_name"), F.col("stratum_1").alias("x_calendar_month"), "count_value"
    )


def _total_records(r: ResultSet, v: Vocabulary) -> DataFrame:
    df = _monthly(r).withColumnRenamed("count_value", "y_record_count")
    return df.orderBy("series_name", _int("x_calendar_month"))


def _records_per_person(r: ResultSet, v: Vocabulary) -> DataFrame:
    base = r.counts(117).select(F.col("stratum_1").alias("x_calendar_month"), F.col("count_value").alias("persons"))
    df = _monthly(r).join(base, "x_calendar_month")
    y = ratio(F.col("count_value"), F.col("persons")).alias("y_record_count")
    return df.select("series_name", "x_calendar_month", y).orderBy("series_name", _int("x_calendar_month"))


def _concepts_per_person(r: ResultSet, v: Vocabulary) -> DataFrame:
    df = r.dist(*_CONCEPTS_PER_PERSON)
    return df.select(_named_by_id(_CONCEPTS_PER_PERSON).alias("category"), *BOX).distinct()


def _population(r: ResultSet, v: Vocabulary) -> DataFrame:
    known = analyses()
    source = r.counts(0).select(F.lit(known[0].name).alias("attribute_name"), F.col("stratum_1").alias("attribute_value"))
    persons = r.counts(1).select(
        F.lit(known[1].name).alias("attribute_name"), F.col("count_value").cast("string").alias("attribute_value")
    )
    return source.unionByName(persons).distinct().orderBy(F.desc("attribute_name"))


def _periods_per_person(r: ResultSet, v: Vocabulary) -> DataFrame:
    # one row per number of periods a person can have: a handful
    rank = F.row_number().over(W.orderBy("stratum_1")).cast("long")
    return r.counts(113).select(rank.alias("concept_id"), F.col("stratum_1").alias("concept_name"), "count_value")


def _heel(r: ResultSet, v: Vocabulary) -> DataFrame:
    found = fetch_heel(run_heel(r, v.concept, version=v.version, this_year=v.this_year))
    return found.select(F.col("analysis_id").alias("attributename"), F.col("heel_warning").alias("attributevalue"))


# --- box plots


def _box(number: int, concept: str | None = "concept_id", category: Column | str | None = None) -> Build:
    """Statistics per concept and category.

    ``category`` is a fixed text, or ``None`` for the name of the last
    stratum's concept. Empty groups are left out.
    """

    def build(r: ResultSet, v: Vocabulary) -> DataFrame:
        df = r.dist(number).filter(F.col("count_value") > 0)
        heads = []
        if concept is not None:
            df = df.join(_label(v, "stratum_1", concept, "_name"), "stratum_1")
            heads.append(concept)
        if category is None:
            stratum = "stratum_1" if concept is None else "stratum_2"
            df = df.join(_label(v, stratum, "_id", "category"), stratum)
        else:
            df = df.withColumn("category", F.lit(category))
        return df.select(*heads, "category", *BOX)

    return build


def _box_by_decile(number: int) -> Build:
    def build(r: ResultSet, v: Vocabulary) -> DataFrame:
        df = r.dist(number).filter(F.col("count_value") > 0)
        return df.select(decile_label(F.col("stratum_1")).alias("category"), *BOX)

    return build


# --- prevalence


def _prevalence_by_year(number: int, with_name: bool = True, with_concept: bool = True) -> Build:
    """Persons with the event per 1000 observed, by year, gender and age decile."""

    def build(r: ResultSet, v: Vocabulary) -> DataFrame:
        shift = 1 if with_concept else 0
        year, gender, decile = (f"stratum_{i + shift}" for i in (1, 2, 3))
        shown = [str(g) for g in GENDERS]
        num = r.counts(number).filter(F.col(gender).isin(*shown)).select(
            *(["stratum_1"] if with_concept else []),
            F.col(year).alias("year"), F.col(gender).alias("gender"), F.col(decile).alias("decile"),
            F.col("count_value").alias("n"),
        )
        denom = r.counts(116).filter(F.col("stratum_2").isin(*shown)).select(
            F.col("stratum_1").alias("year"), F.col("stratum_2").alias("gender"),
            F.col("stratum_3").alias("decile"), F.col("count_value").alias("d"),
        )
        df = num.join(denom, ["year", "gender", "decile"])
        df = df.join(_label(v, "gender", "_gender", "series_name"), "gender")
        heads = []
        if with_concept:
            df = df.join(_label(v, "stratum_1", "concept_id", "concept_name"), "stratum_1")
            heads = ["concept_id", "concept_name"] if with_name else ["concept_id"]
        return df.select(
            *heads,
            decile_label(F.col("decile")).alias("trellis_name"),
            "series_name",
            F.col("year").alias("x_calendar_year"),
            ratio(F.col("n"), F.col("d"), 1000).alias("y_prevalence_1000pp"),
        )

    return build


def _prevalence_by_month(
    number: int, with_name: bool = True, with_concept: bool = True, digits: int | None = 5
) -> Build:
    """Persons with the event per 1000 observed, by month."""

    def build(r: ResultSet, v: Vocabulary) -> DataFrame:
        month = "stratum_2" if with_concept else "stratum_1"
        denom = r.counts(117).select(F.col("stratum_1").alias(month), F.col("count_value").alias("d"))
        df = r.counts(number).select(
            *(["stratum_1"] if with_concept else []), month, F.col("count_value").alias("n")
        ).join(denom, month)
        heads = []
        if with_concept:
            df = df.join(_label(v, "stratum_1", "concept_id", "concept_name"), "stratum_1")
            heads = ["concept_id", "concept_name"] if with_name else ["concept_id"]
        y = ratio(F.col("n"), F.col("d"), 1000, digits)
        return df.select(*heads, F.col(month).alias("x_calendar_month"), y.alias("y_prevalence_1000pp"))

    return build


# --- histograms


def _histogram(number: int, index: str = "interval_index", from_min: bool = False) -> Build:
    """Counts and shares by an integer stratum, counted from the smallest if asked."""

    def build(r: ResultSet, v: Vocabulary) -> DataFrame:
        df = r.counts(number)
        at = _int("stratum_1")
        if from_min:
            at = at - r.counts(number).agg(F.min(_int("stratum_1"))).scalar()
        df = df.withColumn("persons", _persons(r)).filter(F.col("persons").isNotNull())
        share = ratio(F.col("count_value"), F.col("persons"))
        return df.select(at.alias(index), "count_value", share.alias("percent_value"))

    return build


def _histogram_stats(number: int, size: int) -> Build:
    def build(r: ResultSet, v: Vocabulary) -> DataFrame:
        at = _int("stratum_1") * size
        return r.counts(number).agg(
            F.min(at).alias("min_value"), F.max(at).alias("max_value"), F.lit(size).alias("interval_size")
        )

    return build


def _cumulative_duration(r: ResultSet, v: Vocabulary) -> DataFrame:
    """Share of persons observed at least this long: a running sum from the far end."""
    # one row per 30 days of observation length, so the single window is small
    at_least = W.orderBy(F.desc("months")).rangeBetween(W.unboundedPreceding, W.currentRow)
    df = r.counts(108).select(_int("stratum_1").alias("months"), "count_value")
    df = df.groupBy("months").agg(F.sum("count_value").alias("n")).filter(F.col("months").isNotNull())
    df = df.withColumn("longer", F.sum("n").over(at_least)).withColumn("persons", _persons(r))
    return (
        df.filter(F.col("persons").isNotNull())
        .select(
            F.lit("Length of observation").alias("series_name"),
            (F.col("months") * 30).alias("x_length_of_observation"),
            ratio(F.col("longer"), F.col("persons")).alias("y_percent_persons"),
        )
        .orderBy("x_length_of_observation")
    )


# --- treemaps


def _treemap(
    base: int, tree: Callable[[Vocabulary, DataFrame], DataFrame], digits: int | None, era: bool = False
) -> Build:
    """Share of persons and records per person (or era length) along a hierarchy."""

    def build(r: ResultSet, v: Vocabulary) -> DataFrame:
        persons = r.counts(base).select("stratum_1", F.col("count_value").alias("num_persons"))
        if era:
            second = r.dist(base + 7).select("stratum_1", F.col("avg_value").alias("second"))
            last = F.col("second") if digits is None else F.round("second", digits)
            last_name = "length_of_era"
        else:
            second = r.counts(base + 1).select("stratum_1", F.col("count_value").alias("second"))
            last = ratio(F.col("second"), F.col("num_persons"), digits=digits)
            last_name = "records_per_person"
        used = persons.select(_int("stratum_1").alias("concept_id"))
        named = tree(v, used).withColumn("stratum_1", F.col("concept_id").cast("string"))
        df = persons.join(second, "stratum_1").join(named, "stratum_1").withColumn("total", _persons(r))
        return (
            df.filter(F.col("total").isNotNull())
            .select(
                "concept_id", "concept_path", "num_persons",
                ratio(F.col("num_persons"), F.col("total"), digits=digits).alias("percent_persons"),
                last.alias(last_name),
            )
            .orderBy(F.desc("num_persons"))
        )

    return build


# --- the list


def _register() -> None:
    v4, v5 = ("v4",), ("v5",)
    _add("heel_messages", "LABEL", _heel)

    _add("condition_age_at_first_diagnosis", "BOX", _box(406))
    _add("condition_treemap", "TREE", _treemap(400, hierarchy.conditions, 5))
    _add("condition_by_type", "LABEL", _conditions_by_type)
    _add("condition_prevalence_by_gender_age_year", "PREV", _prevalence_by_year(404))
    _add("condition_prevalence_by_month", "PREV", _prevalence_by_month(402))

    _add("conditionera_age_at_first_diagnosis", "BOX", _box(1006))
    _add("conditionera_treemap", "TREE", _treemap(1000, hierarchy.conditions, 5, era=True))
    _add("conditionera_length_of_era", "BOX", _box(1007, category="Length of era"))
    _add("conditionera_prevalence_by_gender_age_year", "PREV", _prevalence_by_year(1004, with_name=False))
    _add("conditionera_prevalence_by_month", "PREV", _prevalence_by_month(1002, with_name=False))

    _add("datadensity_concepts_per_person", "BOX", _concepts_per_person)
    _add("datadensity_records_per_person", "PREV", _records_per_person)
    _add("datadensity_total_records", "LABEL", _total_records)

    _add("death_age_at_death", "BOX", _box(506, concept=None))
    _add("death_by_type", "LABEL", _counts_by_concept(505))
    _add("death_prevalence_by_gender_age_year", "PREV", _prevalence_by_year(504, with_concept=False))
    _add("death_prevalence_by_month", "PREV", _prevalence_by_month(502, with_concept=False, digits=None))

    _add("drug_age_at_first_exposure", "BOX", _box(706, "drug_concept_id"))
    _add("drug_days_supply_distribution", "BOX", _box(715, "drug_concept_id", "Days supply"))
    _add("drug_treemap", "TREE", _treemap(700, hierarchy.drugs, 5))
    _add("drug_by_type", "LABEL", _counts_by_two(705, "drug", with_name=False))
    _add("drug_prevalence_by_gender_age_year", "PREV", _prevalence_by_year(704))
    _add("drug_prevalence_by_month", "PREV", _prevalence_by_month(702))
    _add("drug_quantity_distribution", "BOX", _box(717, "drug_concept_id", "Quantity"))
    _add("drug_refills_distribution", "BOX", _box(716, "drug_concept_id", "Refills"))

    _add("drugera_age_at_first_exposure", "BOX", _box(906))
    _add("drugera_treemap", "TREE", _treemap(900, hierarchy.ingredients, None, era=True))
    _add("drugera_length_of_era", "BOX", _box(907, category="Length of era"))
    _add("drugera_prevalence_by_gender_age_year", "PREV", _prevalence_by_year(904, with_name=False))
    _add("drugera_prevalence_by_month", "PREV", _prevalence_by_month(902, with_name=False))

    _add("measurement_age_at_first_occurrence", "BOX", _box(1806), v5)
    _add("measurement_lower_limit_distribution", "BOX", _box(1816), v5)
    _add("measurement_treemap", "TREE", _treemap(1800, hierarchy.measurements, None), v5)
    _add("measurement_value_distribution", "BOX", _box(1815), v5)
    _add("measurement_by_type", "LABEL", _counts_by_two(1805, "measurement"), v5)
    _add("measurement_prevalence_by_gender_age_year", "PREV", _prevalence_by_year(1804), v5)
    _add("measurement_prevalence_by_month", "PREV", _prevalence_by_month(1802), v5)
    _add("measurement_records_by_unit", "LABEL", _counts_by_two(1807, "measurement"), v5)
    _add("measurement_upper_limit_distribution", "BOX", _box(1817), v5)
    _add("measurement_values_relative_to_norm", "LABEL", _counts_by_two(1818, "measurement", joiner=":"), v5)

    _add("observation_age_at_first_occurrence", "BOX", _box(806))
    _add("observation_treemap", "TREE", _treemap(800, hierarchy.observations, None))
    _add("observation_by_type", "LABEL", _counts_by_two(805, "observation"))
    _add("observation_prevalence_by_gender_age_year", "PREV", _prevalence_by_year(804))
    _add("observation_prevalence_by_month", "PREV", _prevalence_by_month(802))
    _add("observation_lower_limit_distribution", "BOX", _box(816), v4)
    _add("observation_value_distribution", "BOX", _box(815), v4)
    _add("observation_records_by_unit", "LABEL", _counts_by_two(807, "observation"), v4)
    _add("observation_upper_limit_distribution", "BOX", _box(817), v4)
    _add("observation_values_relative_to_norm", "LABEL", _counts_by_two(818, "observation", joiner=": "), v4)

    _add("observationperiod_age_at_first", "HIST", _histogram(101))
    _add("observationperiod_age_by_gender", "BOX", _box(104, concept=None))
    _add("observationperiod_cumulative_duration", "CUM", _cumulative_duration)
    _add("observationperiod_length_data", "HIST", _histogram(108))
    _add("observationperiod_length_stats", "HIST", _histogram_stats(108, 30))
    _add("observationperiod_length_by_age", "BOX", _box_by_decile(107))
    _add("observationperiod_length_by_gender", "BOX", _box(106, concept=None))
    _add("observationperiod_observed_by_month", "HIST", _histogram(110, "month_year"))
    _add("observationperiod_observed_by_year_data", "HIST", _histogram(109, from_min=True))
    _add("observationperiod_observed_by_year_stats", "HIST", _histogram_stats(109, 1))
    _add("observationperiod_periods_per_person", "LABEL", _periods_per_person)

    _add("person_ethnicity", "LABEL", _counts_by_concept(5))
    _add("person_gender", "LABEL", _counts_by_concept(2, GENDERS))
    _add("person_population", "LABEL", _population)
    _add("person_race", "LABEL", _counts_by_concept(4))
    _add("person_year_of_birth_data", "HIST", _histogram(3, from_min=True))
    _add("person_year_of_birth_stats", "HIST", _histogram_stats(3, 1))

    _add("procedure_age_at_first_occurrence", "BOX", _box(606))
    _add("procedure_prevalence_by_gender_age_year", "PREV", _prevalence_by_year(604))
    _add("procedure_prevalence_by_month", "PREV", _prevalence_by_month(602))
    _add("procedure_treemap", "TREE", _treemap(600, hierarchy.procedures, None))
    _add("procedure_by_type", "LABEL", _counts_by_two(605, "procedure"))

    _add("visit_age_at_first_occurrence", "BOX", _box(206))
    _add("visit_prevalence_by_gender_age_year", "PREV", _prevalence_by_year(204))
    _add("visit_prevalence_by_month", "PREV", _prevalence_by_month(202, digits=None))
    _add("visit_duration_by_type", "BOX", _box(211, category="Length of stay"))
    _add("visit_treemap", "TREE", _treemap(200, hierarchy.visits, None))


_register()
