"""Operators that answer several analyses from one pass, and what their plans look like."""

from __future__ import annotations

import contextlib
import datetime
import io
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from popscan.catalogue import analyses, checked, frames, pad, stratified
from popscan.cdm import Cdm
from popscan.analyses.domains import CONDITION, VISIT
from popscan.operators import (
    PERSONS, Check, Stratum, calendar_coverage, check_all, heavy_keys, inverted_check, no_value_check, orphan_check,
    spread_join, stratify, summaries,
)
from popscan.plans import clustered
from popscan.operators.grouping import grouping_number
from popscan.reports.hierarchy import ancestor_levels


def plan(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue().split("\n\n")[0]  # the tree


@pytest.fixture
def plain_plans(spark):
    """Plans as they would be for large tables: nothing broadcast, nothing adapted."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = [spark.conf.get(n) for n in names]
    for n, v in zip(names, ("-1", "false")):
        spark.conf.set(n, v)
    yield
    for n, v in zip(names, before):
        spark.conf.set(n, v)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ---- grouping sets


def test_sets_equal_single_counts(spark):
    rng = random.Random(1)
    rows = [
        (rng.choice([None, *range(9)]), rng.choice([None, 1, 2]), rng.choice([10, 11, None]), rng.randint(0, 3))
        for _ in range(300)
    ]
    df = spark.createDataFrame(rows, "person_id long, a int, b int, n int")
    wanted = {
        1: Stratum(("a",), PERSONS), 2: Stratum(("a",)), 3: Stratum(("b", "a"), PERSONS), 4: Stratum(("b",)),
        5: Stratum(()), 6: Stratum((), PERSONS), 7: Stratum(("a", "b")),
    }
    got = defaultdict(dict)
    for r in stratify(df, wanted).collect():
        got[r.analysis_id][(r.stratum_1, r.stratum_2)] = r.count_value
    text = lambda x: None if x is None else str(x)
    for number, s in wanted.items():
        persons, records = defaultdict(set), Counter()
        for p, a, b, n in rows:
            key = tuple([text({"a": a, "b": b}[k]) for k in s.keys] + [None] * (2 - len(s.keys)))
            records[key] += n
            persons[key] |= set() if p is None else {p}
        want = {k: len(v) for k, v in persons.items()} if s.measure == PERSONS else dict(records)
        assert got[number] == want, number
    with pytest.raises(ValueError):
        stratify(df, {})


def test_grouping_numbers_are_those_of_spark(spark):
    columns = ("a", "b", "person_id")
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, person_id int")
    for kept in (("a",), ("a", "b"), ("b", "person_id"), ()):
        number = df.groupingSets([[F.col(c) for c in kept]], *columns).agg(F.grouping_id().alias("g")).first().g
        assert number == grouping_number(columns, kept)


def test_condition_counts_come_from_one_scan_of_the_rollup(spark, derived, tmp_path):
    derived.rollup(CONDITION).write.parquet(str(tmp_path / "rollup"))
    cdm = derived.with_rollups({CONDITION.table: spark.read.parquet(str(tmp_path / "rollup"))})
    ids = [400, 401, 402, 405, 420]
    together = stratified(cdm, ids)
    tree = plan(together)
    assert len(re.findall(r"Scan parquet", tree)) == 1
    single = [r for i in ids for r in rows_of(pad(analyses()[i].frame(derived), "results"))]
    assert rows_of(pad(together, "results")) == sorted(single, key=str)
    # and a run takes them so: one frame for the five
    assert len(frames(cdm, ids)) == 1
    with pytest.raises(ValueError):
        stratified(cdm, [400, 700])
    with pytest.raises(ValueError):
        stratified(cdm, [400, 404])


# ---- integrity checks


def test_all_checks_of_a_table(spark):
    facts = spark.createDataFrame(
        [(1, 5, 7, None, 3), (2, None, 7, 1, 2), (None, 6, 8, 1, 1), (9, 5, 9, None, None), (9, 99, None, 2, 2)],
        "person_id long, a int, b long, v int, w int",
    )
    tables = {
        "person": spark.createDataFrame([(1,), (2,), (2,)], "person_id long"),
        "other": spark.createDataFrame([(5,), (7,), (None,)], "id long"),
    }
    checks = {
        10: orphan_check("person_id", "person", "person_id"),
        11: orphan_check("a", "other", "id"),
        12: orphan_check("b", "other", "id", keep_null_key=True),
        13: inverted_check("w", "v"),
        14: no_value_check(["v"]),
        15: Check("person_id", "v > 100"),
    }
    want = {10: 2, 11: 1, 12: 2, 13: 1, 14: 2, 15: 0}
    assert {r.analysis_id: r.count_value for r in check_all(facts, checks, tables).collect()} == want
    assert {r.analysis_id: r.count_value for r in check_all(facts.limit(0), checks, tables).collect()} == dict.fromkeys(want, 0)


def test_checks_scan_their_table_once(spark, derived, tmp_path, plain_plans):
    tables = {}
    for name in ("condition_occurrence", "person", "provider", "visit_occurrence"):
        derived[name].write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    together = checked(Cdm(tables), [409, 411, 412, 413])
    scans = re.findall(r"Scan parquet", plan(together))
    assert len(scans) == 4  # the facts and three parents
    assert rows_of(together) == sorted((r for i in (409, 411, 412, 413) for r in rows_of(analyses()[i].frame(derived))), key=str)


def test_checks_count_without_sorting_or_joining_keys(spark, plain_plans):
    facts = spark.createDataFrame([(1, 5, 5), (2, 6, None), (3, None, 7), (4, 6, 7)], "person_id long, a int, b long")
    tables = {"other": spark.createDataFrame([(5,), (5,), (None,)], "id long"), "person": facts.select("person_id").limit(3)}
    checks = {
        1: orphan_check("a", "other", "id"), 2: orphan_check("b", "other", "id", keep_null_key=True),
        3: orphan_check("person_id", "person", "person_id"), 4: no_value_check(["a"]), 5: inverted_check("b", "a"),
    }
    found = check_all(facts, checks, tables)
    assert "Join" not in plan(found)
    assert {r.analysis_id: r.count_value for r in found.collect()} == {1: 2, 2: 3, 3: 1, 4: 1, 5: 1}


# ---- calendar


def covered(periods, unit, mode, attributes=None):
    """Plain count over the calendar."""
    day = datetime.timedelta(days=1)

    def units(d):
        return d.year if unit == "year" else d.year * 12 + d.month - 1

    def first(u):
        return datetime.date(u, 1, 1) if unit == "year" else datetime.date(u // 12, u % 12 + 1, 1)

    calendar = sorted({units(s) for _, s, _ in periods if s})
    out = defaultdict(set)
    for u in calendar:
        a, b = first(u), first(u + 1) - day
        for p, s, e in periods:
            if p is None or s is None or e is None:
                continue
            if (s <= a and e >= b) if mode == "contain" else (units(s) <= u <= units(e)):
                for extra in [()] if attributes is None else attributes.get(p, []):
                    out[(u if unit == "year" else u // 12 * 100 + u % 12 + 1, *extra)].add(p)
    return sorted((*k, len(v)) for k, v in out.items())


@pytest.mark.parametrize("unit", ["year", "month"])
@pytest.mark.parametrize("mode", ["contain", "overlap"])
def test_calendar_by_differences(spark, unit, mode):
    rng = random.Random(5)
    day = lambda: datetime.date(1994, 1, 1) + datetime.timedelta(days=rng.randint(0, 1800))
    periods = [(rng.choice([None, *range(14)]), day(), day()) for _ in range(60)]
    periods += [(1, None, day()), (2, day(), None), (3, datetime.date(1995, 1, 1), datetime.date(1995, 12, 31)), (4, day(), datetime.date(9998, 12, 31))]
    periods = [(p, s, e) for p, s, e in periods]
    df = spark.createDataFrame(periods, "person_id long, s date, e date")
    assert rows_of(calendar_coverage(df, "s", "e", unit, mode)) == sorted(covered(periods, unit, mode), key=str)
    known = {p: [(p % 2, p % 3)] for p in range(10)}
    persons = spark.createDataFrame([(p, *a[0]) for p, a in known.items()] + [(1, 1, 1)], "person_id long, g int, y int")
    got = calendar_coverage(df, "s", "e", unit, mode, persons, ["g", "y"])
    assert rows_of(got) == sorted(covered(periods, unit, mode, known), key=str)


@pytest.mark.parametrize("number", [109, 110, 116, 117, 1409, 1410])
def test_calendar_plans(spark, derived, tmp_path, plain_plans, number):
    tables = {}
    for name in ("observation_period", "payer_plan_period", "person"):
        derived[name].write.parquet(str(tmp_path / name))
        tables[name] = spark.read.parquet(str(tmp_path / name))
    df = analyses()[number].frame(Cdm(tables))
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("simple")
    tree = text.getvalue()
    periods = [x for x in re.findall(r"FileScan parquet \[([^\]]*)\]", tree) if "period_start_date" in x]
    assert len(periods) <= 2
    if number != 116:  # its strata need a row for each group and year
        assert "Generate" not in tree and "Expand" in tree


# ---- summaries


def test_sketches_merge_over_months(spark):
    df = spark.range(60000).selectExpr(
        "id % 9000 AS person_id", "CAST(id % 3 AS int) AS k", "CAST(200001 + id % 12 AS int) AS month", "id % 997 * 1.0D AS v", "1 AS n"
    )
    monthly = summaries.summarise(df, ["k"], "month", weight="n", person="person_id", value="v")
    whole = summaries.merged(monthly, ["k"])
    twice = summaries.merged(summaries.merged(monthly, ["k", "month"]), ["k"])  # in two steps
    for merged in (whole, twice):
        for r in merged.select("k", "records", summaries.person_estimate().alias("p")).collect():
            assert r.records == 20000
            assert abs(r.p - 3000) <= summaries.person_error() * 3000
    estimates = whole.select("k", summaries.quantile_estimates().alias("estimates"))
    held = summaries.ranks_held(df, ["k"], "v", estimates).collect()
    assert [(r.n, r.within) for r in held] == [(20000, True)] * 3
    wrong = estimates.withColumn("estimates", F.transform("estimates", lambda x: x + 60))
    assert not any(r.within for r in summaries.ranks_held(df, ["k"], "v", wrong).collect())
    some = summaries.merged(monthly, ["k"], 200003, 200005)
    assert {r.records for r in some.collect()} == {5000}


def test_sketches_of_few_are_exact_and_nulls_stay_out(spark):
    df = spark.createDataFrame([(1, 5, None), (1, 5, None), (None, 5, 2.0), (2, 6, 3.0)], "person_id long, month int, v double")
    monthly = summaries.summarise(df, [], "month", person="person_id", value="v")
    row = summaries.merged(monthly, []).select("records", summaries.person_estimate().alias("p"), summaries.quantile_estimates([0.0, 1.0]).alias("q")).first()
    assert (row.records, row.p, list(row.q)) == (4, 2, [2.0, 3.0])
    empty = summaries.merged(monthly.filter("month = 5").drop("quantiles"), [])
    assert empty.select(summaries.person_estimate()).first()[0] == 1


# ---- heavy keys


def test_heavy_keys_are_found(spark):
    df = spark.range(90000).select(F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 50 == 1, 7).otherwise(F.col("id")).alias("k"))
    keys = spark.range(1).select(heavy_keys(df, "k", 0.01).alias("keys")).first()["keys"]
    assert set(keys) == {-1, 7}


@pytest.mark.parametrize("partner", [True, False])
def test_a_third_of_the_rows_under_one_key(spark, plain_plans, partner):
    """No task of the join reads more than twice the median."""
    costs = spark.range(0, 120000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 30000).alias("k"), F.col("id").alias("cost")
    )
    events = spark.range(30000).select(F.col("id").alias("k"), (F.col("id") % 40).alias("concept"))
    if partner:
        events = events.union(spark.createDataFrame([(-1, 99), (-1, 98)], "k long, concept long"))
    joined = spread_join(costs, events, "k")
    assert rows_of(joined.groupBy("concept").agg(F.count("*"), F.sum("cost"))) == rows_of(
        costs.join(events, "k").groupBy("concept").agg(F.count("*"), F.sum("cost"))
    )
    sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect())
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[4]


def test_spread_join_without_heavy_or_any_rows(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k long, v string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "k long, w string")
    assert rows_of(spread_join(left, right, "k", share=0.9)) == [(1, "a", "x"), (1, "a", "y")]
    assert rows_of(spread_join(left, right, "k", share=0.1)) == [(1, "a", "x"), (1, "a", "y")]
    assert rows_of(spread_join(left.limit(0), right, "k")) == rows_of(spread_join(left, right.limit(0), "k")) == []


# ---- person clusters


@pytest.mark.parametrize(("number", "domain", "most"), [(404, CONDITION, 2), (406, CONDITION, 3), (208, VISIT, 1), (400, CONDITION, 1)])
def test_clustered_tables_spare_exchanges(spark, derived, tmp_path, plain_plans, number, domain, most):
    cdm, clusters = clustered(derived, [domain], str(tmp_path), buckets=5)
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        df = analyses()[number].frame(cdm)
        exchanges = re.findall(r"Exchange (?:hash|range|Single)", plan(df).replace("(", " ")) or re.findall(r"Exchange", plan(df))
        assert len(exchanges) <= most, plan(df)
        assert rows_of(df) == rows_of(analyses()[number].frame(derived))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    clusters.release()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("popscan_")]


# ---- ancestors


def test_many_parents_are_sets_not_paths(spark):
    """Ten parents, grandparents and great-grandparents each: thirty rows, not a thousand."""
    pairs = [(10 * (level + 1) + i, 10 * level + j, 1) for level in range(1, 3) for i in range(10) for j in range(10)]
    pairs += [(10 + i, 1, 1) for i in range(10)]
    names = [(i, f"concept {i:02d}") for i in (1, *range(10, 40))]

    class Small:
        tables = {"concept_ancestor": spark.createDataFrame(pairs, "ancestor_concept_id long, descendant_concept_id long, min_levels_of_separation int")}
        concept = spark.createDataFrame(names, "concept_id long, concept_name string")

    found = ancestor_levels(Small, spark.createDataFrame([(1,)], "concept_id long"), 3)
    assert sorted((r.level, r.ancestor) for r in found.collect()) == [(level, 10 * level + i) for level in (1, 2, 3) for i in range(10)]
