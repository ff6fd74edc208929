from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF
from popscan import schemas
from popscan.catalogue import analyses, analysis_catalogue
from popscan.operators import inverted_dates
from popscan.sources import adapt_v4, load_cdm, normalise_dates, validate_schema
from popscan.sources.derived import DERIVED, DerivedTables, StoredTables


def test_text_dates(spark):
    df = spark.createDataFrame([("1/2/2010",), ("2010-01-02",), ("2010-01-02 00:00:00",), ("x",), (None,)], "a_date string")
    day = dt.date(2010, 1, 2)
    assert [r.a_date for r in normalise_dates(df).collect()] == [day, day, day, None, None]


def test_dates_compare_as_dates_not_text(spark):
    df = spark.createDataFrame([(1, "2010-9-1", "2010-10-1")], "person_id long, start_date string, end_date string")
    assert inverted_dates(normalise_dates(df), "start_date", "end_date").first().count_value == 0


def test_timestamps_become_dates(spark):
    df = spark.createDataFrame([(dt.datetime(2010, 1, 2, 3, 4),)], "a_date timestamp")
    assert normalise_dates(df).first().a_date == dt.date(2010, 1, 2)


def test_v4_names(spark):
    death = spark.createDataFrame([(1, 5)], "person_id long, cause_of_death_concept_id int")
    assert adapt_v4({"death": death})["death"].columns == ["person_id", "cause_concept_id"]


def test_schema_check(spark):
    empty = {n: spark.createDataFrame([], s) for n, s in schemas.CDM["v5"].items()}
    assert {r.status for r in validate_schema(spark, empty).collect()} == {"ok"}
    del empty["cohort"]
    empty["death"] = empty["death"].drop("death_date")
    empty["person"] = empty["person"].withColumn("year_of_birth", empty["person"].year_of_birth.cast("long"))
    bad = {(r.table_name, r.column_name): r.status for r in validate_schema(spark, empty).collect() if r.status != "ok"}
    assert bad[("cohort", "subject_id")] == "missing table"
    assert bad[("death", "death_date")] == "missing column"
    assert bad[("person", "year_of_birth")] == "type differs"


def test_load_from_files(spark, derived, tmp_path):
    derived["person"].write.parquet(f"{tmp_path}/person")
    death = derived["death"]
    death.withColumn("death_date", death.death_date.cast("string")).write.parquet(f"{tmp_path}/death.parquet")
    cdm = load_cdm(spark, str(tmp_path), source_name="test")
    assert set(cdm.tables) == {"person", "death"}
    assert dict(cdm["death"].dtypes)["death_date"] == "date"
    assert analyses()[0].frame(cdm).first().stratum_1 == "test"


def test_load_csv(spark, tmp_path):
    (tmp_path / "cohort.csv").write_text("cohort_definition_id,cohort_start_date,cohort_end_date,subject_id\n1,1/2/2010,2010-01-01,7\n")
    cdm = load_cdm(spark, str(tmp_path), format="csv")
    assert analyses()[1701].frame(cdm).first().count_value == 1


def test_catalogue(spark):
    df = analysis_catalogue(spark)
    assert df.count() == 197 and df.schema == schemas.ANALYSIS
    assert set(analyses("v4")) & {816, 817, 818, 1300, 1609} == {816, 817, 818, 1300, 1609}
    assert not set(analyses("v5")) & {816, 817, 818, 1300, 1609}
    assert not set(analyses("v4")) & set(range(1800, 1821))


def test_every_order_line_reaches_the_clinical_tables(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").join(
        spark.read.parquet(f"{SF}/orders.parquet"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    n, derived = lines.count(), DerivedTables(spark, SF)
    for table in ("drug_exposure", "procedure_occurrence", "drug_cost", "procedure_cost"):
        ids = derived[table].select(F.col(derived[table].columns[0]).alias("id"))
        assert (ids.count(), ids.distinct().count()) == (n, n)


def test_order_lines_are_dealt_once(spark, tmp_path):
    """Repeated pairs, lines and orders without a key: the rows of the plain text, from one exchange of the lines."""
    day = dt.datetime(1996, 5, 1)
    lines = [(k, n, 7, 8, float(q), 10.0 * q, 0.1, None, day, "R", "F") for k in (1, 2, 3, None) for n in (1, 1, 2) for q in (1, 2, 2)]
    columns = (
        "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_shipdate timestamp, l_returnflag string, l_linestatus string"
    )
    spark.createDataFrame(lines, columns).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 5), (2, None), (None, 6)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    tables = DerivedTables(spark, str(tmp_path))
    plain = spark.sql(DERIVED["order_line"], lineitem=tables["lineitem"], orders=tables["orders"])
    assert sorted(map(repr, tables["order_line"].collect())) == sorted(map(repr, plain.collect()))
    assert plain.count() == 18

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = DerivedTables(spark, str(tmp_path))["order_line"]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert text.count("Exchange") == 2, text  # the lines and the orders


def test_eras_are_added_up_in_more_tasks_than_other_exchanges_have(spark):
    """The rows of the plain text, missing keys and repeats included, in four tasks for each shuffle partition."""

    class Exposures(DerivedTables):
        def __getitem__(self, name):
            return exposures if name == "drug_exposure" else super().__getitem__(name)

    days = [None, dt.date(1996, 5, 1), dt.date(1996, 7, 3), dt.date(1997, 1, 1)]
    rows = [(p, c, d) for p in (1, 2, None) for c in (0, 210001, 210026, None) for d in days for _ in range(2)]
    exposures = spark.createDataFrame(rows, "person_id long, drug_concept_id int, drug_exposure_start_date date")
    eras, plain = Exposures(spark, SF)["drug_era"], spark.sql(DERIVED["drug_era"], drug_exposure=exposures)
    assert eras.dtypes == plain.dtypes
    assert sorted(map(repr, eras.collect())) == sorted(map(repr, plain.collect()))
    assert eras.rdd.getNumPartitions() == 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_stored_tables_are_written_when_asked_for(spark, tmp_path):
    plain, tables = DerivedTables(spark, SF), StoredTables(spark, SF, str(tmp_path))
    eras = tables["drug_era"]
    assert {p.name for p in tmp_path.iterdir()} == {"order_line", "drug_era"}
    assert all("drug_era" in f for f in eras.inputFiles())
    for name in ("drug_era", "drug_exposure", "cohort"):
        assert tables[name].dtypes == plain[name].dtypes
        assert tables[name].exceptAll(plain[name]).isEmpty() and plain[name].exceptAll(tables[name]).isEmpty()
