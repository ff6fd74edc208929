"""The versioned store: what a broken run, a rerun and an older version look like to readers."""

from __future__ import annotations

import pytest

from popscan.catalogue import RESULTS
from popscan.plans import run_analyses
from popscan.results import StoredResults, approximate_persons
from popscan.store import ResultStore, Run

KEPT = {"small_cell_count": None, "with_heel": False}


def state(spark, out, version=None):
    results = StoredResults(spark, out, version)
    both = [*results.counts(*range(2000)).collect(), *results.dist(*range(2000)).collect()]
    return results.version.number, sorted(map(str, both))


@pytest.mark.parametrize("create", [True, False])
def test_a_run_that_breaks_changes_nothing(spark, derived, tmp_path, monkeypatch, create):
    out = str(tmp_path)
    run_analyses(spark, derived, out, ids=[1, 2, 103, 200], **KEPT)
    before = state(spark, out)
    write, calls = Run.write, []

    def breaks(self, kind, df, ids):
        calls.append(ids)
        if len(calls) == 2:
            raise RuntimeError("executor lost for good")
        write(self, kind, df, ids)

    monkeypatch.setattr(Run, "write", breaks)
    with pytest.raises(RuntimeError):
        run_analyses(spark, derived, out, ids=[2, 5, 113, 201], create=create, **KEPT)
    assert len(calls) == 2  # the first batch of the broken run has been written
    assert state(spark, out) == before
    monkeypatch.undo()
    store = ResultStore(spark, out)
    (left,) = store.unreferenced().collect()
    assert spark.read.parquet(f"{out}/{left.folder}/{RESULTS}").count() > 0
    run_analyses(spark, derived, out, ids=[2, 5], create=create, **KEPT)
    assert state(spark, out)[0] == 2
    assert {r.run for r in store.unreferenced().collect()} >= {left.run}


def test_a_run_that_breaks_in_its_commit_changes_nothing(spark, derived, tmp_path, monkeypatch):
    out = str(tmp_path)
    run_analyses(spark, derived, out, ids=[1], **KEPT)
    before = state(spark, out)
    append = ResultStore._append

    def breaks(self, name, rows, schema, stamp):
        if name == "manifest":
            raise RuntimeError("driver lost")
        append(self, name, rows, schema, stamp)

    monkeypatch.setattr(ResultStore, "_append", breaks)
    with pytest.raises(RuntimeError):
        run_analyses(spark, derived, out, ids=[2], **KEPT)
    monkeypatch.undo()
    assert state(spark, out) == before


def test_reruns_take_the_rest_over_by_reference(spark, derived, tmp_path):
    out = str(tmp_path)
    first = run_analyses(spark, derived, out, ids=[1, 2, 103, 200], **KEPT)
    second = run_analyses(spark, derived, out, ids=[2, 113], create=False, **KEPT)
    folders = second.version.of(RESULTS)
    assert folders[1] == folders[200] == first.version.of(RESULTS)[1] != folders[2] == folders[113]
    assert second.ids(RESULTS) == [1, 2, 113, 200] and second.ids("dist") == [103]
    assert state(spark, out, 1)[1] == sorted(map(str, [*first.counts(1, 2, 200).collect(), *first.dist(103).collect()]))
    log = {r.version: (r.entries, r.written) for r in ResultStore(spark, out).versions().collect()}
    assert log == {1: (5, 5), 2: (6, 3)}  # with the catalogue of each run
    # a rerun that finds nothing leaves nothing, and no rows that stand for it
    third = run_analyses(spark, derived, out, ids=[2, 103], create=False, with_heel=False, small_cell_count=1 << 40)
    assert third.counts(2).count() == third.dist(103).count() == 0 and third.counts(1).count() == 1
    # a run that creates starts anew
    assert run_analyses(spark, derived, out, ids=[5], **KEPT).ids(RESULTS) == [5]
    kept = {r.run for r in ResultStore(spark, out).unreferenced(keep=1).collect()}
    assert kept == {first.version.run, second.version.run, third.version.run}
    assert {r.run for r in ResultStore(spark, out).unreferenced(keep=4).collect()} == set()


def test_findings_belong_to_their_run(spark, derived, tmp_path):
    out = str(tmp_path)
    with_rules = run_analyses(spark, derived, out, ids=[7, 8], this_year=2020)
    assert with_rules.catalogue().count() == 197
    found = with_rules.heel().count()
    assert run_analyses(spark, derived, out, ids=[7], create=False, with_heel=False).heel().count() == 0
    assert StoredResults(spark, out, 1).heel().count() == found


def test_no_version_yet(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        StoredResults(spark, str(tmp_path / "none"))
    store = ResultStore(spark, str(tmp_path / "none"))
    assert store.manifest() is None and store.versions().count() == 0 and store.unreferenced().count() == 0
    run = store.begin()
    assert [r.run for r in store.unreferenced().collect()] == [run.name]
    store.commit(run, None)  # a run without analyses
    assert StoredResults(spark, str(tmp_path / "none")).counts(1, 2).count() == 0
    with pytest.raises(FileNotFoundError):
        StoredResults(spark, str(tmp_path / "none"), 7)


def test_stored_sketches_answer_other_months(spark, derived, tmp_path):
    results = run_analyses(spark, derived, str(tmp_path), ids=[400, 401, 700], with_heel=False, summaries=True)
    assert results.ids("summaries") == [400, 700]
    events = derived["condition_occurrence"].filter("condition_start_date BETWEEN '1996-04-01' AND '1997-09-30'")
    want = {str(r[0]): r[1] for r in events.selectExpr("condition_concept_id", "person_id").distinct().groupBy("condition_concept_id").count().collect()}
    got = {r.stratum_1: r.count_value for r in approximate_persons(results, 400, 199604, 199709, limit=None).collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) <= 0.05 * want[k] for k in want)
    limited = approximate_persons(results, 400, 199604, 199709, limit=20).collect()
    assert {r.stratum_1 for r in limited} == {k for k, n in got.items() if n > 20}
