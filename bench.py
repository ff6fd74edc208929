"""Headline timings: ``BENCH_SF_DIR`` (data), ``BENCH_CPUS`` (cores), ``BENCH_RUNS`` (median of),
``BENCH_WORK`` (folder for the stored tables; on a cluster, one that all executors share).

The clinical tables are derived once and stored, then analyses run over the
stored tables as they would in a warehouse. Prints one JSON line; ``value`` is
the sum of the medians, ``setup`` the time to derive and store the tables,
``once`` single timings of whole paths that are not part of the sum.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from popscan.analyses.domains import CONDITION, DRUG, FROM_EVENTS, VISIT
from popscan.catalogue import analyses, frames, stratified
from popscan.cdm import Cdm
from popscan.heel import run_heel
from popscan.plans import clustered, run_analyses
from popscan.reports import Vocabulary, concept_documents, document, report
from popscan.results import LiveResults
from popscan.sources.derived import DERIVED, DerivedTables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

# the three with a published timing first, then one per family
SINGLE = (109, 116, 117, 110, 101, 103, 108, 200, 206, 208, 211, 402, 404, 406, 412, 413, 511, 703, 704, 706, 710, 711,
          818, 1201, 1409, 1500)
# analyses that share a scan
SHARED = {"a0715_0717": range(715, 718), "a1502_1511": range(1502, 1512), "a1602_1608": range(1602, 1609),
          "a1815_1817": range(1815, 1818)}
REPORTS = ("visit_prevalence_by_month", "condition_prevalence_by_gender_age_year", "drug_treemap", "procedure_treemap")


def timed(build) -> float:
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 4)


def once(build) -> float:
    start = time.perf_counter()
    build()
    return round(time.perf_counter() - start, 2)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    start = time.perf_counter()
    folder = tempfile.mkdtemp(prefix="bench-", dir=os.environ.get("BENCH_WORK"))
    derived = DerivedTables(spark, SF_DIR)
    tables = {}
    for name in DERIVED:
        if name != "order_line":
            derived[name].write.parquet(f"{folder}/{name}")
            tables[name] = spark.read.parquet(f"{folder}/{name}")
    cdm = Cdm(tables)
    setup = round(time.perf_counter() - start, 2)

    results = {}
    for i in SINGLE:
        results[f"a{i:04d}"] = timed(lambda: analyses()[i].frame(cdm))
    for name, ids in SHARED.items():
        results[name] = timed(lambda: frames(cdm, ids)[0][1])
    live, vocabulary = LiveResults(spark, cdm), Vocabulary(tables)
    for name in REPORTS:
        results[f"rpt_{name}"] = timed(lambda: report(name, live, vocabulary))
    results["heel_04_05"] = timed(lambda: run_heel(live, tables["concept"], [4, 5]))
    grouped = [i for i, d in FROM_EVENTS.items() if d == DRUG and analyses()[i].grouping]
    results["sets_drug_exposure"] = timed(lambda: stratified(cdm, grouped))

    whole = {}
    runs = f"{folder}/store"
    whole["run_analyses"] = once(lambda: run_analyses(spark, cdm, runs, this_year=2020))
    whole["rerun_of_three"] = once(lambda: run_analyses(spark, cdm, runs, ids=[2, 402, 715], create=False, with_heel=False))
    stored = run_analyses(spark, cdm, runs, ids=[1], create=False, with_heel=False)
    for name in ("person", "dashboard"):
        whole[f"doc_{name}"] = once(lambda: document(name, stored, vocabulary).collect())
    whole["doc_condition_details"] = once(
        lambda: concept_documents("condition", stored, vocabulary).write.format("noop").mode("overwrite").save()
    )
    near, clusters = clustered(cdm, [CONDITION, VISIT], f"{folder}/clustered")
    for i in (208, 404, 406):
        whole[f"clustered_a{i:04d}"] = once(lambda: analyses()[i].frame(near).write.format("noop").mode("overwrite").save())
    clusters.release()
    print(
        json.dumps(
            {
                "metric": "sum of median wall-clock per query, stored clinical tables",
                "value": round(sum(results.values()), 3),
                "unit": "sec",
                "queries": results,
                "once": whole,
                "setup": setup,
                "runs": RUNS,
                "sf": SF_DIR.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
