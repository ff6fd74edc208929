"""Counts, integrity checks and calendars on hand-written data."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from popscan.catalogue import analyses
from popscan.cdm import Cdm
from popscan.operators import (
    by_demographics,
    calendar_coverage,
    count_of_counts,
    first_period,
    inverted_dates,
    orphans,
    outside_period,
    relative_to_range,
)


def d(text):
    return dt.date.fromisoformat(text)


def periods(spark, rows):
    return spark.createDataFrame(
        [(i, p, d(s), d(e) if e else None) for i, (p, s, e) in enumerate(rows)],
        "observation_period_id long, person_id long, observation_period_start_date date, observation_period_end_date date",
    )


S, E = "observation_period_start_date", "observation_period_end_date"


def cover(spark, rows, unit, mode, **kw):
    got = calendar_coverage(periods(spark, rows), S, E, unit, mode, **kw)
    return {r.unit: r.count_value for r in got.collect()}


def test_calendar_holds_start_units_only(spark):
    rows = [(1, "1999-01-01", "2003-12-31"), (2, "2001-02-01", "2001-03-01")]
    assert cover(spark, rows, "year", "overlap") == {1999: 1, 2001: 2}
    assert cover(spark, rows, "year", "contain") == {1999: 1, 2001: 1}


def test_containment_and_overlap(spark):
    rows = [(1, "2000-03-01", "2001-02-28")]
    assert cover(spark, rows, "year", "contain") == {}
    assert cover(spark, rows, "year", "overlap") == {2000: 1}
    assert cover(spark, rows, "month", "contain") == {200003: 1}


def test_overlapping_periods_count_a_person_once(spark):
    rows = [(1, "2000-01-01", "2000-12-31"), (1, "2000-06-01", "2001-12-31"), (2, "2001-01-01", "2001-01-31")]
    assert cover(spark, rows, "year", "overlap") == {2000: 1, 2001: 2}


def test_adjacent_periods_do_not_join_to_a_contained_year(spark):
    rows = [(1, "2000-01-01", "2000-06-30"), (1, "2000-07-01", "2000-12-31")]
    assert cover(spark, rows, "year", "contain") == {}


def test_inverted_and_open_periods(spark):
    rows = [(1, "2001-05-01", "2000-05-01"), (2, "2001-06-01", "9999-12-31"), (3, "2001-07-01", None)]
    assert cover(spark, rows, "year", "overlap") == {2001: 1}
    got = inverted_dates(periods(spark, rows), S, E).first().count_value
    assert got == 1


@pytest.mark.parametrize("unit", ["year", "month"])
@pytest.mark.parametrize("mode", ["contain", "overlap"])
def test_calendar_matches_brute_force(spark, unit, mode):
    rng = random.Random(unit + mode)
    rows = []
    for _ in range(120):
        start = d("1998-01-01") + dt.timedelta(days=rng.randint(0, 1500))
        if rng.random() < 0.3:
            start = start.replace(day=1)
        end = start + dt.timedelta(days=rng.randint(-20, 900))
        if rng.random() < 0.3:
            end = end.replace(day=1) - dt.timedelta(days=1)
        rows.append((rng.choice([1, 1, 1, *range(2, 20)]), start.isoformat(), end.isoformat()))

    def key(x):
        return x.year if unit == "year" else x.year * 100 + x.month

    def span(u):
        if unit == "year":
            return dt.date(u, 1, 1), dt.date(u, 12, 31)
        y, m = divmod(u, 100)
        nxt = dt.date(y + m // 12, m % 12 + 1, 1)
        return dt.date(y, m, 1), nxt - dt.timedelta(days=1)

    want = {}
    for u in {key(d(s)) for _, s, _ in rows}:
        lo, hi = span(u)
        if mode == "contain":
            seen = {p for p, s, e in rows if d(s) <= lo and d(e) >= hi}
        else:
            seen = {p for p, s, e in rows if key(d(s)) <= u <= key(d(e))}
        if seen:
            want[u] = len(seen)
    assert cover(spark, rows, unit, mode) == want


def test_outside_matches_brute_force(spark):
    rng = random.Random(3)
    spans = [(rng.choice([1, 1, 2, 3]), rng.randint(0, 300), rng.randint(0, 60)) for _ in range(40)]
    base = d("2001-01-01")
    op = periods(
        spark,
        [(p, (base + dt.timedelta(days=s)).isoformat(), (base + dt.timedelta(days=s + n)).isoformat()) for p, s, n in spans],
    )
    events = [(rng.choice([1, 1, 1, 2, 3, 4]), rng.randint(-5, 370)) for _ in range(400)]
    rows = [(p, base + dt.timedelta(days=x)) for p, x in events] + [(1, None), (None, base)]
    df = spark.createDataFrame(rows, "person_id long, day date")
    want = sum(not any(q == p and s <= x <= s + n for q, s, n in spans) for p, x in events) + 1
    assert outside_period(df, "day", op, S, E).first().count_value == want


def test_orphans_with_and_without_key(spark):
    from pyspark.sql import functions as F

    facts = spark.createDataFrame([(1, 10), (2, 99), (3, None), (4, 99)], "id long, fk long")
    dim = spark.createDataFrame([(10,)], "pk long")
    assert orphans(facts, "fk", dim, "pk", F.lit(1)).first().count_value == 2
    assert orphans(facts, "fk", dim, "pk", F.lit(1), keep_null_fk=True).first().count_value == 3


def test_negative_ages_fall_into_negative_deciles(spark):
    events = spark.createDataFrame([(1, 7, 1990)], "person_id long, concept_id int, year int")
    persons = spark.createDataFrame([(1, 8507, 1995)], "person_id long, gender_concept_id int, year_of_birth int")
    assert by_demographics(events, persons).first().age_decile == -1


def test_repeated_person_rows_do_not_double_counts(spark):
    events = spark.createDataFrame([(1, 7, 1990), (1, 7, 1990)], "person_id long, concept_id int, year int")
    persons = spark.createDataFrame([(1, 8507, 1960)] * 2, "person_id long, gender_concept_id int, year_of_birth int")
    assert by_demographics(events, persons).first().count_value == 1


def test_first_period_breaks_ties(spark):
    op = periods(spark, [(1, "2000-01-01", "2000-05-01"), (1, "2000-01-01", "2000-03-01"), (1, "2001-01-01", None)])
    row = first_period(op, S, E, "observation_period_id").first()
    assert (row.start_date, row.end_date) == (d("2000-01-01"), d("2000-03-01"))


def test_count_of_counts(spark):
    op = periods(spark, [(1, "2000-01-01", None), (1, "2001-01-01", None), (2, "2000-01-01", None)])
    got = {r.k: r.count_value for r in count_of_counts(op, "person_id", S, "k").collect()}
    assert got == {1: 1, 2: 1}


def test_bands(spark):
    rows = [(1, 5, 8, v, 10.0, 20.0) for v in (9.0, 10.0, 20.0, 21.0)] + [(1, 5, 8, None, 10.0, 20.0), (1, 5, None, 1.0, 2.0, 3.0)]
    df = spark.createDataFrame(
        rows, "person_id long, c int, u int, value_as_number double, range_low double, range_high double"
    )
    got = {r.band: r.count_value for r in relative_to_range(df, "c", "u").collect()}
    assert got == {"Below Range Low": 1, "Within Range": 2, "Above Range High": 1}


def test_null_stratum_kept_in_counts(spark):
    obs = spark.createDataFrame(
        [(1, 5, d("2000-01-01"), 1, None), (1, 5, d("2000-01-01"), 1, 8)],
        "person_id long, observation_concept_id int, observation_date date, observation_type_concept_id int, unit_concept_id int",
    )
    got = analyses()[807].frame(Cdm({"observation": obs})).collect()
    assert {(r.stratum_2, r.count_value) for r in got} == {(None, 1), ("8", 1)}


def test_event_without_person_counts_as_no_record(spark):
    visits = spark.createDataFrame(
        [(1, 9, d("2000-01-01")), (None, 9, d("2000-01-01"))],
        "person_id long, visit_concept_id int, visit_start_date date",
    )
    cdm = Cdm({"visit_occurrence": visits})
    assert analyses()[201].frame(cdm).first().count_value == 1
    assert analyses()[200].frame(cdm).first().count_value == 1


def test_records_add_up_over_types_but_persons_do_not(derived):
    by_concept = {r.stratum_1: r.count_value for r in analyses()[401].frame(derived).collect()}
    total = {}
    for r in analyses()[405].frame(derived).collect():
        total[r.stratum_1] = total.get(r.stratum_1, 0) + r.count_value
    assert by_concept == total


def test_new_analyses_can_be_registered(derived):
    from popscan import catalogue

    @catalogue.analysis(99001, "Number of visits by care site", ("care_site_id",))
    def visits_by_care_site(cdm):
        return cdm["visit_occurrence"].groupBy("care_site_id").count().withColumnRenamed("count", "count_value")

    try:
        frame = analyses()[99001].frame(derived)
        assert frame.columns == ["analysis_id", "stratum_1", "count_value"]
        with pytest.raises(ValueError):
            catalogue.analysis(99001, "again")(visits_by_care_site)
    finally:
        del catalogue._REGISTRY[99001]


def test_demographics_with_repeated_persons(spark):
    """An id that the person table repeats counts once in each group it belongs to; the joined rows need no distinct."""
    events = spark.createDataFrame(
        [(1, 9, 2000), (1, 9, 2000), (1, None, 2000), (2, 9, 2000), (None, 9, 2000), (3, 9, None), (4, 9, 2000)],
        "person_id long, concept_id int, year int",
    )
    persons = spark.createDataFrame(
        [(1, 8507, 1960), (1, 8507, 1960), (1, 8507, 1955), (1, 8532, 1960), (2, 8507, 1958), (None, 8507, 1960), (3, None, None)],
        "person_id long, gender_concept_id int, year_of_birth int",
    )
    df = by_demographics(events, persons)
    assert sorted(map(tuple, df.collect()), key=str) == sorted(
        [(9, 2000, 8507, 4, 2), (9, 2000, 8532, 4, 1), (None, 2000, 8507, 4, 1), (None, 2000, 8532, 4, 1), (9, None, None, None, 1)],
        key=str,
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = df._jdf.queryExecution().executedPlan().toString().split("Join")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert text[0].count(" HashAggregate(") == 2, text[0]  # the count by strata, in two steps
