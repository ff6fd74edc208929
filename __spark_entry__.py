
from __future__ import annotations

import re
import tempfile
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popscan.analyses.domains import CONDITION, DRUG, FROM_EVENTS, MEASUREMENT, VISIT
from popscan.catalogue import BOTH, DIST, RESULTS, Analysis, analyses, checked, stratified
from popscan.cdm import Cdm, Domain
from popscan.heel import ALL_RULES, run_heel
from popscan.operators import distribution, summaries
from popscan.plans import clustered, run_analyses, work_folder
from popscan.reports import DOCUMENTS, REPORTS, Vocabulary, concept_documents, document, report
from popscan.reports.documents import DETAILS, Histogram, treemap_rows
from popscan.reports.read_back import document_values, node_values, numbers_apart
from popscan.results import (
    STRATA, AskedResults, LiveResults, ResultSet, StoredOrLive, approximate_persons, compare_results, fetch_analysis,
    suppress_small_cells,
)
from popscan.schemas import V4_RENAMES
from popscan.sources import DerivedTables, StoredTables, adapt_v4, normalise_dates
from popscan_checks.analyses import analysis_sql
from popscan_checks.base import OFF_HALF, with_tables
from popscan_checks.documents import detail_entries, detail_values, summary_entries, summary_values, treemap_values
from popscan_checks.reports import report_sql
from popscan_checks.rules import THIS_YEAR, rule_sql
from popscan_checks.stored import with_results

try:  # the operators for training data, where they are installed
    import corpus_pipeline
    from popscan.llm import queries as llm
except ImportError:
    llm = corpus_pipeline = None

_ROUNDED = ("avg_value", "stdev_value")


def _cdm(spark: SparkSession, sf_dir: str, version: str = "v5") -> Cdm:
    return Cdm(DerivedTables(spark, sf_dir), version=version)


def _rounded(df: DataFrame) -> DataFrame:
    """Cut means and deviations to six decimals so that summation order does not show."""
    return df.withColumns({c: F.round(F.col(c) + OFF_HALF, 6) for c in _ROUNDED if c in df.columns})


def _slug(name: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_")[:48].strip("_")


def _key(a: Analysis) -> str:
    return f"a{a.id:04d}_{a.family.lower()}_{_slug(a.name)}"


def _analysis_query(number: int) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _rounded(analyses()[number].frame(_cdm(spark, sf_dir)))

    return run


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: persons observed per year by gender and age decile."""
    return _analysis_query(116)(spark, "/root/testdata/sf0.001")


def _live(spark: SparkSession, sf_dir: str, version: str = "v5") -> tuple[LiveResults, Vocabulary]:
    cdm = _cdm(spark, sf_dir, version)
    return LiveResults(spark, cdm), Vocabulary(cdm.tables, "v5", THIS_YEAR)


def _from_store(
    spark: SparkSession, sf_dir: str, build: Callable[[ResultSet, Vocabulary], DataFrame], others: bool = True
) -> DataFrame:
    """``build`` over stored results: the analyses it asks for are run once, over clinical tables written once.

    For what reads many analyses, or one of them several times; live slices would derive the tables for each. ``others``
    says whether analyses of another version, which a run does not store, are answered as well.
    """
    cdm = _stored_clinical(spark, sf_dir)
    vocabulary = Vocabulary(cdm.tables, "v5", THIS_YEAR)
    asked = AskedResults(spark)
    build(asked, vocabulary)
    ids = [i for i in sorted(asked.ids) if i in analyses("v5")]
    stored = run_analyses(spark, cdm, _scratch(spark), ids=ids, small_cell_count=None, with_heel=False)
    return build(StoredOrLive(stored, LiveResults(spark, cdm)) if others else stored, vocabulary)


def _rule_query(number: int) -> Callable[[SparkSession, str], DataFrame]:
    def build(results: ResultSet, vocabulary: Vocabulary) -> DataFrame:
        return run_heel(results, vocabulary.concept, rules=[number], this_year=THIS_YEAR)

    return lambda spark, sf_dir: _from_store(spark, sf_dir, build)


def _report_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        if name in _STORED_REPORTS:
            return _from_store(spark, sf_dir, lambda r, v: report(name, r, v))
        df = report(name, *_live(spark, sf_dir))
        if "length_of_era" in df.columns:  # a mean, hence cut like the others
            df = df.withColumn("length_of_era", F.round("length_of_era", 5))
        return df

    return run


def _document_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """A summary document, read back by value."""
    return lambda spark, sf_dir: numbers_apart(document_values(document(name, *_live(spark, sf_dir))))


def _details_query(domain: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: numbers_apart(
        document_values(_from_store(spark, sf_dir, lambda r, v: concept_documents(domain, r, v)))
    )


def _treemap_query(domain: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: numbers_apart(node_values(_from_store(spark, sf_dir, lambda r, v: treemap_rows(domain, r, v))))


def _heel_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document of the quality rules, over stored results: they read most analyses."""
    return numbers_apart(document_values(_from_store(spark, sf_dir, lambda r, v: document("heel", r, v), others=False)))


def _entries(docs: DataFrame, arrays: Mapping[str, str]) -> DataFrame:
    """Read documents back: ``path, section, entries``; ``arrays`` maps sections to a JSON path."""
    sizes = F.array(
        *[
            F.struct(F.lit(k).alias("section"), F.json_array_length(F.get_json_object("document", at)).alias("entries"))
            for k, at in arrays.items()
        ]
    )
    return docs.select("path", F.explode(sizes).alias("s")).select("path", "s.section", "s.entries")


def _document_entries(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        arrays = {
            k: f"$.{k}.DATA.{p.data.columns[0].upper()}" if isinstance(p, Histogram) else f"$.{k}.{p.columns[0].upper()}"
            for k, p in DOCUMENTS[name].items()
        }
        return _entries(document(name, *_live(spark, sf_dir)), arrays)

    return run


def _details_entries(domain: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        arrays = {k: f"$.{k}.{s.columns[0].upper()}" for k, s in DETAILS[domain][2].items()}
        return _entries(_from_store(spark, sf_dir, lambda r, v: concept_documents(domain, r, v)), arrays)

    return run


_STORED_REPORTS = ("heel_messages",)
_TREEMAP = {
    era: ("concept_id", "concept_path", "num_persons", "percent_persons", "length_of_era" if era else "records_per_person")
    for era in (False, True)
}
_ENTRIES_SUMMARY = ("person", "observationperiod", "datadensity", "death")
_ENTRIES_DETAIL = ("visit", "conditionera", "measurement")


def _located_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Analysis 1508 from the operator alone: ranks located by bucket and value."""
    tables = _cdm(spark, sf_dir)
    costs = tables["drug_cost"].select("drug_exposure_id", "total_paid")
    mapped = tables["drug_exposure"].filter("drug_concept_id <> 0").select("drug_exposure_id", "drug_concept_id")
    df = distribution(
        costs.join(mapped, "drug_exposure_id").filter("total_paid IS NOT NULL"),
        ["drug_concept_id"], "total_paid", bounded=False,
    )
    number = F.lit(1508).cast("int").alias("analysis_id")
    return _rounded(df.select(number, F.col("drug_concept_id").cast("string").alias("stratum_1"), *df.columns[1:]))


def _rolled_up(number: int) -> Callable[[SparkSession, str], DataFrame]:
    """An analysis read from the person-level rollup instead of the event table."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        cdm = _cdm(spark, sf_dir)
        domain = FROM_EVENTS[number]
        cdm = cdm.with_rollups({domain.table: cdm.rollup(domain)})
        return _rounded(analyses()[number].frame(cdm))

    return run


def _families(attribute: str) -> dict[str, list[int]]:
    """Version 5 analyses that share a pass over one table, by table."""
    out: dict[str, list[int]] = {}
    for i, a in analyses("v5").items():
        if (of := getattr(a, attribute)) is not None:
            out.setdefault(of[0] if isinstance(of[0], str) else of[0].table, []).append(i)
    return out


def _together(build: Callable[..., DataFrame], ids: list[int]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(_cdm(spark, sf_dir), ids)


def _approximate_persons(domain: Domain) -> Callable[[SparkSession, str], DataFrame]:
    """Persons by concept and year from monthly sketches, held to their stated error against the exact counts."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = _cdm(spark, sf_dir).events(domain)
        monthly = summaries.summarise(events, ["concept_id"], "month", weight="n", person="person_id")
        year = F.floor(F.col("month") / 100).cast("int").alias("year")
        estimated = summaries.merged(monthly, ["concept_id", year]).select(
            "concept_id", "year", "records", summaries.person_estimate().alias("estimate")
        )
        exact = events.groupBy("concept_id", year).agg(F.countDistinct("person_id").alias("persons"))
        off = F.abs(F.col("estimate") - F.col("persons")) <= summaries.person_error() * F.col("persons")
        return exact.join(estimated, ["concept_id", "year"]).select("concept_id", "year", "records", "persons", off.alias("within"))

    return run


def _approximate_values(table: str, keys: list[str], value: str, date: str) -> Callable[[SparkSession, str], DataFrame]:
    """Quantiles of values from monthly sketches, held to their stated error of rank."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = _cdm(spark, sf_dir)[table]
        rows = rows.filter(f"{value} IS NOT NULL").select(*keys, F.col(value).cast("double").alias("v"), date).dropna(subset=keys)
        rows = rows.withColumn("month", F.date_format(date, "yyyyMM").cast("int"))
        merged = summaries.merged(summaries.summarise(rows, keys, "month", value="v"), keys)
        return summaries.ranks_held(rows, keys, "v", merged.select(*keys, summaries.quantile_estimates().alias("estimates")))

    return run


def _clustered(number: int, domain: Domain) -> Callable[[SparkSession, str], DataFrame]:
    """An analysis over tables bucketed by person, written, as the tables leave the session's catalogue behind it."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = _scratch(spark)
        cdm, clusters = clustered(_cdm(spark, sf_dir), [domain], folder)
        df = _rounded(analyses()[number].frame(cdm))
        df.write.parquet(f"{folder}/result")
        clusters.release()
        return spark.read.schema(df.schema).parquet(f"{folder}/result")

    return run


_CLUSTERED = ((208, VISIT), (400, CONDITION), (403, CONDITION), (404, CONDITION), (406, CONDITION), (410, CONDITION), (704, DRUG))
_SPAN = (199604, 199709)


def _approximate_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Persons by condition over a span of months that no analysis counts, from the sketches of a stored run."""
    cdm = _cdm(spark, sf_dir)
    out = run_analyses(spark, cdm, _scratch(spark), ids=[400, 700], with_heel=False, summaries=True)
    estimated = approximate_persons(out, 400, *_SPAN, limit=None)
    events = cdm.events(CONDITION).filter(F.col("month").between(*_SPAN))
    exact = events.groupBy(F.col("concept_id").cast("string").alias("stratum_1")).agg(
        F.countDistinct("person_id").alias("persons")
    )
    off = F.abs(F.col("count_value") - F.col("persons")) <= summaries.person_error() * F.col("persons")
    return exact.join(estimated, "stratum_1").select("stratum_1", "persons", "records", off.alias("within"))


def _scratch(spark: SparkSession) -> str:
    return f"{work_folder(spark, tempfile.gettempdir())}/store"


def _stored_clinical(spark: SparkSession, sf_dir: str) -> Cdm:
    """The derived clinical tables, as a warehouse has them: what takes a shuffle to derive is written when first read."""
    return Cdm(StoredTables(spark, sf_dir, _scratch(spark)))


_REDONE = (2, 402, 715, 2000)  # the last is no analysis of version 5 and left out


def _whole_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All analyses run and stored, some of them run again with small cells suppressed, and everything read back."""
    out, cdm = _scratch(spark), _stored_clinical(spark, sf_dir)
    run_analyses(spark, cdm, out, small_cell_count=None, with_heel=False)
    redone = [i for i in _REDONE if i in analyses("v5")]
    results = run_analyses(spark, cdm, out, ids=redone, create=False, with_heel=False)
    counts = results.counts(*results.ids(RESULTS))
    spread = results.dist(*results.ids(DIST)).select(
        "analysis_id", *STRATA, "count_value", "min_value", "median_value", "max_value"
    )
    return counts.withColumns({c: F.lit(None).cast("double") for c in ("min_value", "median_value", "max_value")}).unionByName(spread)


def _whole_run_sql() -> str:
    """The union of all check queries, with the later suppression of those that were run again."""
    known = analyses("v5")
    counts = tuple(i for i, a in known.items() if a.kind in (RESULTS, BOTH))
    dists = tuple(i for i, a in known.items() if a.kind == DIST)
    both = ", ".join(str(i) for i, a in known.items() if a.kind == BOTH)
    redone = ", ".join(str(i) for i in _REDONE)
    strata = ", ".join(f"stratum_{i}" for i in range(1, 5)) + ", CAST(NULL AS varchar) AS stratum_5"
    empty = ", ".join(f"CAST(NULL AS double) AS {c}" for c in ("min_value", "median_value", "max_value"))
    return with_results(
        f"SELECT * FROM (SELECT analysis_id, {strata}, count_value, {empty} FROM res UNION ALL "
        f"SELECT analysis_id, {strata}, count_value, {empty} FROM res WHERE analysis_id IN ({both}) UNION ALL "
        f"SELECT analysis_id, {strata}, count_value, min_value, median_value, max_value FROM dst) AS a "
        f"WHERE analysis_id NOT IN ({redone}) OR count_value > 5",
        counts, dists,
    )


class _V4Tables(Mapping):
    """The derived tables under their version 4 column names."""

    def __init__(self, tables: DerivedTables):
        self._tables = tables

    def __getitem__(self, name: str) -> DataFrame:
        old = {new: old for old, new in V4_RENAMES.get(name, {}).items()}
        return self._tables[name].withColumnsRenamed(old)

    def __iter__(self):
        return iter(self._tables)

    def __len__(self) -> int:
        return len(self._tables.keys())


def _v4_query(number: int) -> Callable[[SparkSession, str], DataFrame]:
    """A version 4 data set, adapted, under the legacy quantile."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = _V4Tables(DerivedTables(spark, sf_dir))
        cdm = Cdm({n: adapt_v4({n: tables[n]})[n] for n in _V4_NEEDS}, version="v4")
        return _rounded(analyses()[number].frame(cdm))

    return run


_V4_NEEDS = (
    "person", "observation_period", "visit_occurrence", "condition_occurrence", "drug_exposure", "observation",
    "drug_era", "death", "payer_plan_period", "drug_cost", "cohort", "provider",
)
_V4 = (103, 104, 107, 200, 203, 206, 211, 412, 500, 506, 512, 715, 717, 815, 907, 1406, 1502, 1700)


def _suppressed(spark: SparkSession, sf_dir: str) -> DataFrame:
    results, _ = _live(spark, sf_dir)
    return suppress_small_cells(results.counts(402)).select("analysis_id", "stratum_1", "stratum_2", "count_value")


def _fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fetch_analysis(_live(spark, sf_dir)[0], 116)
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What suppression removes, as a comparison of two result sets."""
    counts = _live(spark, sf_dir)[0].counts(101, 818)
    return compare_results(counts, suppress_small_cells(counts, 20)).select(
        "analysis_id", "stratum_1", "stratum_2", "stratum_3", "difference", "expected"
    )


def _dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates written in three ways, one of them unreadable, and read back."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    text = F.expr(
        "CASE o_orderkey % 3 WHEN 0 THEN date_format(o_orderdate, 'M/d/yyyy') "
        "WHEN 1 THEN date_format(o_orderdate, 'yyyy-MM-dd') ELSE concat('x', o_orderkey) END"
    )
    read = normalise_dates(orders.select(text.alias("order_date")))
    return read.groupBy("order_date").agg(F.count(F.lit(1)).alias("n"))


_MANAGEMENT: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {
    "results_suppress_small_cells": (
        _suppressed,
        with_results(
            "SELECT analysis_id, stratum_1, stratum_2, count_value FROM res WHERE count_value > 5", (402,)
        ),
    ),
    "results_fetch_analysis": (
        _fetched,
        with_results(
            "SELECT analysis_id, stratum_1 AS calendar_year, stratum_2 AS gender_concept_id, stratum_3 AS age_decile, "
            "count_value FROM res", (116,),
        ),
    ),
    "results_compare": (
        _compared,
        with_results(
            "SELECT analysis_id, coalesce(stratum_1, '') AS stratum_1, coalesce(stratum_2, '') AS stratum_2, "
            "coalesce(stratum_3, '') AS stratum_3, 'only left' AS difference, analysis_id = 818 AS expected "
            "FROM res WHERE count_value <= 20", (101, 818),
        ),
    ),
    "source_normalise_dates": (
        _dates,
        "SELECT CASE WHEN o_orderkey % 3 < 2 THEN CAST(o_orderdate AS date) END AS order_date, count(*) AS n "
        "FROM orders GROUP BY 1",
    ),
}

_SETS = _families("grouping")
_CHECKS = _families("check")


def _padded_sql(ids: list[int], strata: int) -> str:
    columns = "".join(f", stratum_{i}" for i in range(1, strata + 1))
    return with_results(f"SELECT analysis_id{columns}, count_value FROM res", tuple(ids))


def _persons_sql(table: str, concept: str, date: str) -> str:
    return with_tables(
        f"SELECT {concept} AS concept_id, CAST(year({date}) AS integer) AS year, count(person_id) AS records, "
        f"count(DISTINCT person_id) AS persons, true AS within FROM {table} GROUP BY 1, 2"
    )


def _values_sql(table: str, keys: list[str], value: str) -> str:
    by = ", ".join(keys)
    known = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return with_tables(
        f"SELECT {by}, count(*) AS n, true AS within FROM {table} WHERE {value} IS NOT NULL AND {known} GROUP BY {by}"
    )


_VALUES = (
    ("measurement", ["measurement_concept_id", "unit_concept_id"], "value_as_number", "measurement_date"),
    ("observation", ["observation_concept_id", "unit_concept_id"], "value_as_number", "observation_date"),
    ("drug_exposure", ["drug_concept_id"], "quantity", "drug_exposure_start_date"),
)

#: Queries of mechanisms that serve several analyses at once, with their check SQL.
_SHARED: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {
    **{f"sets_{t}": (_together(stratified, ids), _padded_sql(ids, 2)) for t, ids in _SETS.items()},
    **{f"checks_{t}": (_together(checked, ids), _padded_sql(ids, 0)) for t, ids in _CHECKS.items()},
    **{
        f"approx_persons_{d.table}": (_approximate_persons(d), _persons_sql(d.table, d.concept, d.start))
        for d in (CONDITION, DRUG, MEASUREMENT)
    },
    **{
        f"approx_values_{table}": (_approximate_values(table, keys, value, date), _values_sql(table, keys, value))
        for table, keys, value, date in _VALUES
    },
    "approx_stored": (
        _approximate_stored,
        with_tables(
            "SELECT CAST(condition_concept_id AS varchar) AS stratum_1, count(DISTINCT person_id) AS persons, "
            "count(person_id) AS records, true AS within FROM condition_occurrence "
            f"WHERE year(condition_start_date) * 100 + month(condition_start_date) BETWEEN {_SPAN[0]} AND {_SPAN[1]} GROUP BY 1"
        ),
    ),
    **{f"clustered_a{i:04d}": (_clustered(i, d), with_tables(analysis_sql()[i])) for i, d in _CLUSTERED},
    "store_whole_run": (_whole_run, _whole_run_sql()),
}

_ROLLED_UP = (400, 401, 404, 405, 406, 409)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {_key(a): _analysis_query(i) for i, a in analyses().items()}
    out["family_dist_located_ranks"] = _located_costs
    out.update({f"rollup_a{i:04d}": _rolled_up(i) for i in _ROLLED_UP})
    out.update({f"v4_a{i:04d}": _v4_query(i) for i in _V4})
    out.update({name: query for name, (query, _) in {**_MANAGEMENT, **_SHARED}.items()})
    out.update({f"heel_{n:02d}": _rule_query(n) for n in ALL_RULES})
    out.update({f"rpt_{name}": _report_query(name) for name in REPORTS})
    out.update({f"doc_{name}": _heel_document if name == "heel" else _document_query(name) for name in DOCUMENTS})
    out.update({f"doc_{domain}_details": _details_query(domain) for domain in DETAILS})
    out.update({f"doc_{domain}_treemap": _treemap_query(domain) for domain in DETAILS})
    out.update({f"entries_{name}": _document_entries(name) for name in _ENTRIES_SUMMARY})
    out.update({f"entries_{domain}_details": _details_entries(domain) for domain in _ENTRIES_DETAIL})
    if llm:
        out.update(llm.queries())
        out["pipeline"] = corpus_pipeline.run
    return out


def oracle_sql() -> dict[str, str]:
    bodies = analysis_sql()
    out = {_key(a): with_tables(bodies[i]) for i, a in analyses().items()}
    out["family_dist_located_ranks"] = with_tables(bodies[1508])
    out.update({f"rollup_a{i:04d}": with_tables(bodies[i]) for i in _ROLLED_UP})
    old = analysis_sql("v4")
    out.update({f"v4_a{i:04d}": with_tables(old[i]) for i in _V4})
    out.update({name: sql for name, (_, sql) in {**_MANAGEMENT, **_SHARED}.items()})
    out.update({f"heel_{n:02d}": sql for n, sql in rule_sql().items()})
    out.update({f"rpt_{name}": sql for name, sql in report_sql().items()})
    out.update({f"doc_{name}": summary_values(name) for name in DOCUMENTS})
    out.update({f"doc_{domain}_details": detail_values(domain) for domain in DETAILS})
    out.update({f"doc_{domain}_treemap": treemap_values(domain, _TREEMAP[domain.endswith("era")]) for domain in DETAILS})
    out.update({f"entries_{name}": summary_entries(name) for name in _ENTRIES_SUMMARY})
    out.update({f"entries_{domain}_details": detail_entries(domain) for domain in _ENTRIES_DETAIL})
    if llm:
        out.update(llm.oracle_sql())
    return out
