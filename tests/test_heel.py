from __future__ import annotations

from popscan import schemas
from popscan.heel import ALL_RULES, fetch_heel, run_heel
from popscan.results import FrameResults


def results(spark, counts=(), dists=()):
    rows = [(i, *(list(strata) + [None] * 5)[:5], n) for i, strata, n in counts]
    drows = [(i, *(list(strata) + [None] * 5)[:5], 10, lo, hi, *[None] * 7) for i, strata, lo, hi in dists]
    return FrameResults(
        spark.createDataFrame(rows, schemas.RESULTS), spark.createDataFrame(drows, schemas.RESULTS_DIST)
    )


def concept(spark, rows=((8507, "Gender"),)):
    return spark.createDataFrame(list(rows), "concept_id int, domain_id string")


def found(spark, counts=(), dists=(), rules=None, concepts=((8507, "Gender"),), **kw):
    return run_heel(results(spark, counts, dists), concept(spark, concepts), rules, this_year=2020, **kw).collect()


def test_clean_data_is_silent(spark):
    counts = [(2, ["8507"], 5), (3, ["1980"], 5), (101, ["30"], 5), (7, [], 0), (420, ["201001"], 20), (420, ["201002"], 25)]
    dists = [(103, [], 0.0, 90.0), (511, [], -50.0, 30.0), (715, ["1"], 1.0, 180.0)]
    assert found(spark, counts, dists) == []


def test_december_to_january(spark):
    counts = [(420, ["201012"], 20), (420, ["201101"], 60)]
    (row,) = found(spark, counts, rules=[22])
    assert row.rule_id == 22 and row.record_count is None
    assert row.heel_warning.startswith("WARNING: 420-Number of condition occurrence records by")


def test_small_base_and_gaps_are_silent(spark):
    assert found(spark, [(420, ["201001"], 10), (420, ["201002"], 100)], rules=[22]) == []
    assert found(spark, [(420, ["201001"], 20), (420, ["201003"], 100)], rules=[22]) == []
    assert found(spark, [(420, ["201001"], 20), (420, ["201002"], 40)], rules=[22]) == []


def test_change_per_concept(spark):
    counts = [(402, [c, m], n) for c in ("1", "2", "3") for m, n in (("201001", 20), ("201002", 50))]
    counts += [(402, ["4", "201001"], 20), (402, ["5", "201002"], 90), (402, [None, "201001"], 20)]
    (row,) = found(spark, counts, rules=[23])
    assert row.record_count == 3


def test_domains_and_vocabulary(spark):
    counts = [(2, ["8507"], 5), (2, ["8532"], 5), (2, ["1"], 5), (2, ["0"], 5), (2, [None], 5)]
    rows = found(spark, counts, rules=[4, 6, 7], concepts=((8507, "gender"), (8532, "Race"), (0, "None")))
    assert {(r.rule_id, r.record_count) for r in rows} == {(4, 1), (6, None), (7, 1)}


def test_implausible_years_and_ages(spark):
    counts = [(3, ["2021"], 2), (3, ["2020"], 2), (3, ["1700"], 3), (3, ["x"], 4), (101, ["-1"], 5), (101, ["151"], 6)]
    rows = found(spark, counts, rules=[18, 19, 20, 21])
    assert {(r.rule_id, r.record_count) for r in rows} == {(18, 2), (19, 3), (20, 5), (21, 6)}


def test_limits_count_strata(spark):
    dists = [(715, ["1"], -1.0, 200.0), (715, ["2"], 0.0, 200.0), (513, [], 0.0, 31.0)]
    rows = found(spark, dists=dists, rules=[2, 3, 24])
    assert {(r.rule_id, r.record_count) for r in rows} == {(2, 1), (3, 1), (24, 2)}


def test_rules_follow_version_and_vocabulary(spark):
    old = spark.createDataFrame([(5, 1), (6, 6)], "concept_id int, vocabulary_id int")
    r = results(spark, [(800, ["5"], 3), (800, ["6"], 3), (2, ["9"], 1)])
    assert {x.rule_id for x in run_heel(r, old, version="v4").collect()} == {4, 15}
    assert {x.rule_id for x in run_heel(r, old, version="v5").collect()} == {4}
    assert len(ALL_RULES) == 26


def test_errors_come_first(spark):
    df = spark.createDataFrame(
        [(1, "WARNING: a", 6, None), (9, "ERROR: b", 1, 2), (3, "error: c", 1, 2)], schemas.HEEL_RESULTS
    )
    assert [r.analysis_id for r in fetch_heel(df).collect()] == [3, 9, 1]
