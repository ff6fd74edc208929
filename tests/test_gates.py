from __future__ import annotations

from pathlib import Path

import pytest

from popscan import schemas
from popscan.cdm import Cdm
from popscan.heel import ALL_RULES, rules_not_run, run_heel
from popscan.plans import run_analyses
from popscan.sources import adapt_v4, load_cdm
from popscan.sources.cdm import schema_defects
from test_heel import concept, results


def empty(spark, version="v5"):
    return {n: spark.createDataFrame([], s) for n, s in schemas.CDM[version].items()}


@pytest.mark.parametrize("version", ["v4", "v5"])
def test_complete_data_sets_have_no_defects(spark, version):
    tables = empty(spark, version)
    assert schema_defects(Cdm(adapt_v4(tables) if version == "v4" else tables, version=version)) == []


def test_a_run_refuses_an_incomplete_data_set_before_any_work(spark, tmp_path):
    tables = empty(spark)
    del tables["cohort"]
    tables["death"] = tables["death"].drop("death_date")
    cdm = Cdm(tables)
    assert set(schema_defects(cdm)) == {"death.death_date", "cohort"}
    with pytest.raises(ValueError, match="death.death_date"):
        run_analyses(spark, cdm, str(tmp_path / "out"), ids=[1], validate_schema=True)
    assert not Path(tmp_path / "out").exists()


def test_a_missing_table_leaves_the_output_alone(spark, tmp_path):
    tables = empty(spark)
    del tables["cohort"]
    with pytest.raises(KeyError):
        run_analyses(spark, Cdm(tables), str(tmp_path / "out"), ids=[1, 1700], with_heel=False)
    assert not Path(tmp_path / "out" / "results").exists()


def test_missing_tables_are_named(spark, tmp_path):
    empty(spark)["person"].write.parquet(f"{tmp_path}/person")
    with pytest.warns(UserWarning, match="cohort"):
        assert set(load_cdm(spark, str(tmp_path)).tables) == {"person"}


def test_rules_left_out_are_named(spark):
    whole = spark.createDataFrame([], schemas.CDM["v5"]["concept"])
    assert rules_not_run(whole) == ()
    assert set(rules_not_run(None)) >= {4, 5, 7, 14, 17}
    domains = concept(spark).drop("domain_id")
    lacking = rules_not_run(domains)
    assert lacking and set(lacking) < set(ALL_RULES) and not {4, 5} & set(lacking)
    with pytest.warns(UserWarning, match=str(lacking[0])):
        run_heel(results(spark), domains)
