"""One registered query of every shape against its check SQL, and the plans behind them."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_point
from check import TABLES, rows
from conftest import SF

SHAPES = (
    "a0000", "a0007", "a0102", "a0103", "a0106", "a0110", "a0116", "a0208", "a0210", "a0404", "a0511", "a0712", "a0814",
    "a0817", "a0818", "a1101", "a1201", "a1409", "a1411", "a1500", "a1604", "a1806", "v4_a0206", "rollup_a0406", "heel_05",
    "heel_10", "heel_23", "rpt_condition_by_type", "rpt_drug_treemap", "rpt_procedure_treemap", "results_compare",
    "source_normalise_dates", "family_dist_located_ranks", "rpt_observationperiod_cumulative_duration",
    "sets_condition_occurrence", "checks_drug_exposure", "approx_persons_measurement", "approx_values_measurement",
    "approx_stored", "clustered_a0208", "clustered_a0404", "doc_person", "doc_visit_details", "doc_visit_treemap",
)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def named(prefix):
    (name,) = [n for n in entry_point.queries() if n == prefix or n.startswith(f"{prefix}_")]
    return name


@pytest.mark.parametrize("prefix", SHAPES)
def test_matches_check_sql(spark, duck, prefix):
    name = named(prefix)
    df = entry_point.queries()[name](spark, SF)
    rel = duck.sql(entry_point.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(rel.columns, rel.fetchall())


def test_every_check_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    without = set(entry_point.queries()) - set(entry_point.oracle_sql())
    # operators for training data, where they are installed, that SQL cannot express
    assert all(n == "pipeline" or n.startswith("op") for n in without)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("prefix", ["a0109", "a0116", "a0208", "a0404", "a0406", "a1502", "rpt_drug_treemap"])
def test_no_cartesian_or_nested_loop_joins(spark, prefix):
    text = plan(entry_point.queries()[named(prefix)](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text


def test_columns_are_pruned_at_the_scan(spark):
    text = plan(entry_point.queries()[named("a0201")](spark, SF))
    assert "o_totalprice" not in text and "o_orderstatus" not in text
