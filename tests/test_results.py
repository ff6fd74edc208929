from __future__ import annotations

import json

import pytest

from conftest import SF
from popscan import schemas
from popscan.catalogue import analyses, pad
from popscan.heel import run_heel
from popscan.plans import run_analyses, work_folder
from popscan.reports import Vocabulary, concept_documents, document, export_reports, report
from popscan.results import (
    AskedResults,
    FrameResults,
    LiveResults,
    StoredOrLive,
    StoredResults,
    compare_documents,
    compare_results,
    fetch_analysis,
    suppress_small_cells,
)


def counts(spark, rows):
    return spark.createDataFrame([(i, s, None, None, None, None, n) for i, s, n in rows], schemas.RESULTS)


def test_suppression(spark):
    df = counts(spark, [(2, "a", 5), (2, "b", 6)])
    once = suppress_small_cells(df)
    assert [r.stratum_1 for r in once.collect()] == ["b"]
    assert suppress_small_cells(once).collect() == once.collect()


def test_run_matches_single_analyses(spark, derived, stored):
    """Rollups and batching change nothing."""
    results = StoredResults(spark, stored)
    for i in (1, 116, 200, 204, 401, 405):
        want = {tuple(r) for r in pad(analyses()[i].frame(derived), "results").collect()}
        assert {tuple(r) for r in results.counts(i).select(schemas.RESULTS.names).collect()} == want
    for i in (104, 206, 715):
        want = pad(analyses()[i].frame(derived), "dist").select(schemas.RESULTS_DIST.names)
        assert compare_results(want, results.dist(i).select(schemas.RESULTS_DIST.names), digits=9).collect() == []


def test_rerun_replaces_only_its_analyses(spark, derived, tmp_path):
    out = str(tmp_path)
    run_analyses(spark, derived, out, ids=[1, 2, 103], small_cell_count=None, with_heel=False)
    run_analyses(spark, derived, out, ids=[2, 5], create=False, with_heel=False)
    got = {r.analysis_id for r in StoredResults(spark, out).counts(*range(10)).select("analysis_id").distinct().collect()}
    assert got == {1, 2, 5}
    assert StoredResults(spark, out).dist(103).count() == 1
    run_analyses(spark, derived, out, ids=[5], with_heel=False)
    assert StoredResults(spark, out).counts(1, 2).count() == 0


def test_rerun_that_finds_nothing_leaves_nothing(spark, derived, tmp_path):
    out = str(tmp_path)
    run_analyses(spark, derived, out, ids=[1, 2, 103], small_cell_count=None, with_heel=False)
    run_analyses(spark, derived, out, ids=[2, 103], small_cell_count=1 << 40, create=False, with_heel=False)
    results = StoredResults(spark, out)
    assert results.counts(2).count() == 0 and results.dist(103).count() == 0
    assert results.counts(1).count() == 1


def test_run_with_heel_and_unknown_ids(spark, derived, tmp_path):
    results = run_analyses(spark, derived, str(tmp_path), ids=[7, 8], this_year=2020)
    assert results.heel().schema.names == schemas.HEEL_RESULTS.names
    assert results.catalogue().count() == 197
    with pytest.raises(ValueError):
        run_analyses(spark, derived, str(tmp_path), ids=[816])


def test_work_folder_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert work_folder(spark, "/elsewhere").startswith(shared)


def test_fetch_names_strata(spark, stored):
    df = fetch_analysis(StoredResults(spark, stored), 116)
    assert df.columns == ["analysis_id", "CALENDAR YEAR", "GENDER_CONCEPT_ID", "AGE DECILE", "count_value"]
    assert "median_value" in fetch_analysis(StoredResults(spark, stored), 104).columns


def test_compare_results(spark):
    a = counts(spark, [(1, None, 100000), (2, "x", 5), (818, "y", 7)])
    b = counts(spark, [(1, "", 100001), (2, "x", 6), (3, "z", 1)])
    got = {(r.analysis_id, r.difference, r.expected) for r in compare_results(a, b).collect()}
    assert got == {(2, "count_value", False), (818, "only left", True), (3, "only right", False)}


def test_compare_documents(spark):
    a = spark.createDataFrame([("p", '{"A":"NA"}'), ("q", "1")], "path string, document string")
    b = spark.createDataFrame([("p", '{"A":""}'), ("q", "2"), ("r", "3")], "path string, document string")
    assert {tuple(r) for r in compare_documents(a, b).collect()} == {("q", "differs"), ("r", "only right")}


@pytest.fixture(scope="module")
def vocabulary(derived):
    return Vocabulary(derived.tables)


def test_person_document(spark, stored, vocabulary):
    results = StoredResults(spark, stored)
    doc = json.loads(document("person", results, vocabulary).first().document)
    assert list(doc) == ["SUMMARY", "GENDER_DATA", "RACE_DATA", "ETHNICITY_DATA", "BIRTH_YEAR_HISTOGRAM"]
    assert doc["SUMMARY"]["ATTRIBUTE_NAME"] == ["Source name", "Number of persons"]
    hist = doc["BIRTH_YEAR_HISTOGRAM"]
    assert hist["INTERVALS"] == hist["MAX"] - hist["MIN"]
    assert sum(hist["DATA"]["COUNT_VALUE"]) == results.counts(1).first().count_value


def test_period_document_and_dashboard(spark, stored, vocabulary):
    results = StoredResults(spark, stored)
    doc = json.loads(document("observationperiod", results, vocabulary).first().document)
    first = doc["AGE_AT_FIRST_OBSERVATION_HISTOGRAM"]
    assert (first["MIN"], first["MAX"], first["INTERVAL_SIZE"], first["INTERVALS"]) == (0, 100, 1, 100)
    survival = doc["CUMULATIVE_DURATION"]["Y_PERCENT_PERSONS"]
    assert survival == sorted(survival, reverse=True)
    board = json.loads(document("dashboard", results, vocabulary).first().document)
    assert board["CUMULATIVE_DURATION"] == doc["CUMULATIVE_DURATION"]


def test_detail_documents_hold_the_report_rows(spark, stored, vocabulary):
    results = StoredResults(spark, stored)
    docs = {r.concept_id: json.loads(r.document) for r in concept_documents("visit", results, vocabulary).collect()}
    tree = {r.concept_id for r in report("visit_treemap", results, vocabulary).collect()}
    assert set(docs) == tree
    months = report("visit_prevalence_by_month", results, vocabulary).collect()
    for c, doc in docs.items():
        want = sorted((r.x_calendar_month, r.y_prevalence_1000pp) for r in months if r.concept_id == c)
        part = doc["PREVALENCE_BY_MONTH"]
        assert list(zip(part["X_CALENDAR_MONTH"], part["Y_PREVALENCE_1000PP"])) == want
        assert set(doc) == {"PREVALENCE_BY_GENDER_AGE_YEAR", "PREVALENCE_BY_MONTH", "VISIT_DURATION_BY_TYPE",
                            "AGE_AT_FIRST_OCCURRENCE"}


def test_export(spark, stored, vocabulary, tmp_path):
    results = StoredResults(spark, stored)
    written = export_reports(results, vocabulary, str(tmp_path), ["PERSON", "VISIT", "DASHBOARD"])
    assert written == ["person.json", "visit_treemap.json", "visits", "dashboard.json"]
    assert spark.read.json(f"{tmp_path}/visits").columns == ["concept_id", "document", "path"]
    json.loads(spark.read.text(f"{tmp_path}/dashboard.json").first().value)
    with pytest.raises(ValueError):
        export_reports(results, vocabulary, str(tmp_path), ["NOPE"])


def test_reports_without_persons_are_empty(spark, vocabulary):
    empty = FrameResults(spark.createDataFrame([], schemas.RESULTS), spark.createDataFrame([], schemas.RESULTS_DIST))
    assert report("person_year_of_birth_data", empty, vocabulary).collect() == []
    assert report("observationperiod_cumulative_duration", empty, vocabulary).collect() == []


def test_asked_results_note_what_to_store(spark, derived):
    asked = AskedResults(spark)
    found = run_heel(asked, derived["concept"], rules=[2, 6], this_year=2024)
    assert found.collect() == [] and {715, 400, 1609} <= asked.ids and 402 not in asked.ids


def test_stored_results_with_other_versions_live(spark, derived, stored):
    both = StoredOrLive(StoredResults(spark, stored), LiveResults(spark, derived))
    assert {r.analysis_id for r in both.counts(2, 1609).collect()} == {2, 1609}  # the second is no analysis of version 5
    assert both.counts(1609).collect() and both.dist(104).collect() == StoredResults(spark, stored).dist(104).collect()


def test_rules_read_each_table_once(spark, tmp_path):
    """The query of a rule computes over stored results, not over slices that derive the tables anew."""
    import __spark_entry__ as entry

    df = entry.queries()["heel_02"](spark, SF)
    assert df.inputFiles() and not any(f.startswith(f"file://{SF}/") for f in df.inputFiles())
