from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def derived(spark):
    from popscan.cdm import Cdm
    from popscan.sources import DerivedTables

    return Cdm(DerivedTables(spark, SF))


@pytest.fixture(scope="session")
def stored(spark, derived, tmp_path_factory):
    """A run over a mixed selection of analyses, nothing suppressed."""
    from popscan.plans import run_analyses

    out = str(tmp_path_factory.mktemp("out"))
    ids = [0, 1, 2, 3, 4, 5, 101, 104, 106, 107, 108, 109, 110, 113, 116, 117, 200, 201, 202, 204, 206, 211, 400, 401,
           402, 405, 420, 715]
    run_analyses(spark, derived, out, ids=ids, small_cell_count=None, with_heel=False)
    return out
