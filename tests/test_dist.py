"""Quantile rules, NULL handling, and the two ways of locating ranks."""

from __future__ import annotations

import math
import re
import random
import statistics

import pytest

from popscan.operators import distribution
from popscan.operators.dist import NAMES, QUANTILES


def one(df):
    (row,) = df.collect()
    return row.asDict()


def brute(values, legacy=False):
    """Both rules as stated, by numbering sorted rows; NULLs last and counted."""
    known = sorted(v for v in values if v is not None)
    n = len(values)
    rows = known + [None] * (n - len(known))
    out = {}
    for q in QUANTILES:
        if legacy:
            hits = [v if rn * 100 <= q * (n + 1) else -9999.0 for rn, v in enumerate(rows, 1)]
            out[NAMES[q]] = max(h for h in hits if h is not None)
        else:
            hits = [v if rn * 100 >= q * n else known[-1] for rn, v in enumerate(rows, 1)]
            out[NAMES[q]] = min(h for h in hits if h is not None)
    return out


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v double")


def test_even_count(spark):
    row = one(distribution(frame(spark, [1.0, 2.0, 3.0, 4.0]), [], "v"))
    assert [row[NAMES[q]] for q in QUANTILES] == [1, 1, 2, 3, 4]
    assert row["count_value"] == 4 and row["avg_value"] == 2.5


def test_single_row(spark):
    row = one(distribution(frame(spark, [7.0]), [], "v"))
    assert {row[NAMES[q]] for q in QUANTILES} == {7.0}
    assert row["stdev_value"] is None


def test_legacy_single_row(spark):
    row = one(distribution(frame(spark, [7.0]), [], "v", legacy=True))
    assert [row[NAMES[q]] for q in QUANTILES] == [-9999, -9999, 7, 7, 7]


def test_legacy_sentinel_beats_very_low_values(spark):
    values = [-20000.0] * 30
    row = one(distribution(frame(spark, values), [], "v", legacy=True))
    assert {row[NAMES[q]] for q in QUANTILES} == {-9999.0}


def test_empty_input(spark):
    assert distribution(frame(spark, []), [], "v").collect() == []


def test_null_stratum_dropped(spark):
    df = spark.createDataFrame([(None, 1.0), (5, 2.0)], "unit int, v double")
    assert [r.unit for r in distribution(df, ["unit"], "v").collect()] == [5]


def test_null_values_count_but_do_not_rank(spark):
    row = one(distribution(frame(spark, [1.0, 2.0, None, None]), [], "v"))
    assert row["count_value"] == 4
    assert row["median_value"] == 2.0 and row["p75_value"] == 2.0 and row["p25_value"] == 1.0
    assert row["avg_value"] == 1.5


@pytest.mark.parametrize("legacy", [False, True])
@pytest.mark.parametrize("bounded", [False, True])
def test_both_ways_match_brute_force(spark, legacy, bounded):
    rng = random.Random(7)
    groups = {
        "hot": [rng.lognormvariate(3, 2) for _ in range(900)],
        "mixed": [rng.uniform(-50, 50) for _ in range(101)] + [None] * 9,
        "narrow": [36.5 + rng.random() * 1e-4 for _ in range(200)] + [1e9],
        "tiny": [rng.random() * 1e-7 for _ in range(40)],
        "ties": [float(rng.randint(0, 3)) for _ in range(150)],
        "zero": [0.0] * 5 + [-0.0] * 5,
        "single": [42.0],
        "cents": [rng.randint(1, 200000) / 100 for _ in range(333)],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = distribution(df, ["g"], "v", legacy=legacy, bounded=bounded)
    for row in got.collect():
        values = groups[row.g]
        known = [v for v in values if v is not None]
        want = brute(values, legacy)
        for q in QUANTILES:
            assert row[NAMES[q]] == want[NAMES[q]], (row.g, q)
        assert row.count_value == (len(known) if legacy else len(values))
        assert row.min_value == min(known) and row.max_value == max(known)
        assert math.isclose(row.avg_value, statistics.fmean(known), rel_tol=1e-12, abs_tol=1e-12)
        if len(known) > 1:
            assert math.isclose(row.stdev_value, statistics.stdev(known), rel_tol=1e-6, abs_tol=1e-9), row.g
        else:
            assert row.stdev_value is None
    assert got.count() == len(groups)


@pytest.mark.parametrize("bounded", [False, True])
def test_values_that_are_not_finite(spark, bounded):
    inf, nan = math.inf, math.nan
    groups = {
        "nan": [1.0, 2.0, nan], "inf": [1.0, 2.0, 3.0, inf], "both": [-inf, 0.0, 5.0, inf, None],
        "huge": [1.7e308, -1.7e308, 1e-320, 3.0, 1.6e308],
    }
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double")
    got = {r.g: r for r in distribution(df, ["g"], "v", bounded=bounded).collect()}
    assert [got["nan"][NAMES[q]] for q in (10, 25, 50)] == [1, 1, 2]
    assert math.isnan(got["nan"].p90_value) and math.isnan(got["nan"].max_value) and math.isnan(got["nan"].avg_value)
    assert got["nan"].count_value == 3 and math.isnan(got["nan"].stdev_value)
    assert (got["inf"].median_value, got["inf"].p90_value, got["inf"].avg_value) == (2.0, inf, inf)
    assert math.isnan(got["inf"].stdev_value)
    assert (got["both"].min_value, got["both"].median_value, got["both"].count_value) == (-inf, 5.0, 5)
    assert math.isnan(got["both"].avg_value)
    assert [got["huge"][NAMES[q]] for q in QUANTILES] == [-1.7e308, 1e-320, 3.0, 1.6e308, 1.7e308]


def test_located_ranks_plan_at_most_ten_exchanges(spark, capsys):
    df = spark.range(50).selectExpr("id % 3 AS g", "rand(1) * 100 AS v")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        distribution(df, ["g"], "v", bounded=False).explain()
        assert capsys.readouterr().out.count(" Exchange hashpartitioning") <= 10
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_quantiles_are_ordered(derived):
    from popscan.catalogue import analyses

    for row in analyses()[717].frame(derived).collect():
        chain = [row.min_value, row.p10_value, row.p25_value, row.median_value, row.p75_value, row.p90_value,
                 row.max_value]
        assert chain == sorted(chain)


def test_located_ranks_shuffle_buckets_not_values(spark, tmp_path):
    """Values reach a shuffle only where their bucket holds a rank: the histogram is taken behind a semi join."""
    df = spark.range(20000).selectExpr("id % 3 AS g", "id * 0.37 AS v")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        located = distribution(df, ["g"], "v", bounded=False)
        text = located._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "LeftSemi" in text
    assert located.drop("avg_value", "stdev_value").exceptAll(distribution(df, ["g"], "v").drop("avg_value", "stdev_value")).isEmpty()


def test_located_ranks_read_their_rows_twice(spark):
    """Statistics and ranks share the pass over the rows that fills the buckets; the second one looks for the ranks."""
    df = spark.range(2000).selectExpr("id % 3 AS g", "id * 0.37 AS v")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = distribution(df, ["g"], "v", bounded=False)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(re.findall(r"\bRange \(", text)) == 2


def test_one_value_has_no_deviation(spark):
    df = spark.createDataFrame([("a", 104949.1), ("b", 0.3)], "g string, v double").crossJoin(spark.range(1000)).repartition(7)
    assert all(r.stdev_value < 1e-9 for r in distribution(df, ["g"], "v", bounded=False).collect())


def test_weights_of_located_ranks(spark):
    rows = [(1.5, 3), (2.25, 1), (70.0, 6), (None, 2)]
    plain = spark.createDataFrame([(v,) for v, n in rows for _ in range(n)], "v double")
    weighted = distribution(spark.createDataFrame(rows, "v double, w long"), [], "v", weight="w", bounded=False)
    want, got = one(distribution(plain, [], "v")), one(weighted)
    assert got.keys() == want.keys() and all(math.isclose(got[c], want[c], rel_tol=1e-9) for c in want)
