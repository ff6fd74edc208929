"""Running many analyses over one data set.

A run is a handful of Spark jobs, not one per analysis. Event tables that
serve several analyses are first reduced to a person-level rollup, written to
shared storage and read back by all of them: one scan of the raw table instead
of ten, and a lost executor only repeats work since the rollup. Analyses are
then unioned per source and written in one job each.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popscan import heel
from popscan.analyses.domains import FROM_EVENTS
from popscan.catalogue import BOTH, DIST, RESULTS, analyses, analysis_catalogue, frames
from popscan.cdm import Cdm
from popscan.operators import PERSONS, Stratum
from popscan.operators.summaries import summarise
from popscan.plans.clustered import clustered
from popscan.results import CATALOGUE, HEEL, SMALL_CELL_COUNT, SUMMARIES, StoredResults, suppress_small_cells
from popscan.sources.cdm import schema_defects
from popscan.store import ResultStore

CHECKPOINT_CONF = "spark.checkpoint.dir"
# An event table is worth a rollup from this many analyses on.
MIN_USES = 3


def work_folder(spark: SparkSession, fallback: str) -> str:
    """A fresh folder on storage all executors share.

    It lies in the folder the cluster names in ``spark.checkpoint.dir``;
    ``fallback`` (next to the output) serves where none is named.
    """
    shared = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    return f"{(shared or fallback).rstrip('/')}/popscan-{uuid.uuid4().hex}"


def materialise(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a frame to shared storage and read it back, cutting its lineage."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _batches(ids: Iterable[int]) -> list[list[int]]:
    """Group ids by hundred, that is, by source table."""
    out: dict[int, list[int]] = {}
    for i in ids:
        out.setdefault(i // 100, []).append(i)
    return list(out.values())


def _sketched(number: int) -> bool:
    grouping = analyses()[number].grouping
    return grouping is not None and grouping[1] == Stratum(("concept_id",), PERSONS)


def _person_sketches(cdm: Cdm, number: int) -> DataFrame:
    events = cdm.events(analyses()[number].grouping[0])
    return summarise(events, ["concept_id"], "month", weight="n", person="person_id").select(
        F.lit(number).alias("analysis_id"), F.col("concept_id").cast("string").alias("stratum_1"),
        F.col("month").cast("int").alias("month"), "records", "persons",
    )


def run_analyses(
    spark: SparkSession,
    cdm: Cdm,
    output: str,
    ids: Sequence[int] | None = None,
    small_cell_count: int | None = SMALL_CELL_COUNT,
    create: bool = True,
    rollups: bool = True,
    with_heel: bool = True,
    this_year: int | None = None,
    validate_schema: bool = False,
    summaries: bool = False,
    cluster: bool = False,
) -> StoredResults:
    """Compute analyses and commit them as the next version of the store at ``output``.

    A version holds ``results``, ``dist``, ``catalogue`` and, unless
    ``with_heel`` is off, ``heel``. ``ids`` defaults to all analyses of the
    data set's version. ``create=False`` takes stored analyses not in ``ids``
    over from the version before. Until the commit, which is the last step,
    readers see the old version whole, and a run that breaks changes nothing.
    Counts up to ``small_cell_count`` are suppressed; ``None`` keeps all.
    ``validate_schema`` refuses data sets that lack a table or column of the
    model, before any work. Without it, a table that an analysis needs and does
    not find fails the run before anything is written. ``summaries`` also
    stores monthly person sketches of the analyses that count persons by
    concept (``approximate_persons`` reads them); sketches are not suppressed,
    so keep such a store as private as the data. ``cluster`` buckets persons,
    periods and rollups by person, which spares large data sets an exchange of
    the facts in each person-level analysis.
    """
    if validate_schema and (defects := schema_defects(cdm)):
        raise ValueError(f"not in the data set: {', '.join(defects)}")
    wanted = sorted(analyses(cdm.version) if ids is None else set(ids))
    unknown = [i for i in wanted if i not in analyses(cdm.version)]
    if unknown:
        raise ValueError(f"not analyses of model version {cdm.version}: {unknown}")
    folder = work_folder(spark, f"{output}/_work")

    clusters = None
    if rollups:
        uses: dict[str, list[int]] = {}
        for i in wanted:
            if i in FROM_EVENTS:
                uses.setdefault(FROM_EVENTS[i].table, []).append(i)
        domains = [FROM_EVENTS[used[0]] for used in uses.values() if len(used) >= MIN_USES]
        if cluster:
            cdm, clusters = clustered(cdm, domains, folder)
        else:
            cdm = cdm.with_rollups({d.table: materialise(cdm.rollup(d), folder, f"rollup_{d.table}") for d in domains})

    built = [(batch, frames(cdm, batch)) for batch in _batches(wanted)]
    store = ResultStore(spark, output)
    try:
        base = None if create else store.version()
    except FileNotFoundError:
        base = None
    run = store.begin()
    for batch, parts in built:
        for kind in (RESULTS, DIST):
            of_kind = [df for k, df in parts if k == kind]
            if not of_kind:
                continue
            asked = [i for i in batch if analyses(cdm.version)[i].kind in (kind, BOTH)]
            df = reduce(DataFrame.unionByName, of_kind)
            if small_cell_count is not None:
                df = suppress_small_cells(df, small_cell_count)
            run.write(kind, df, asked)
    if summaries:
        sketched = [i for i in wanted if _sketched(i)]
        if sketched:
            run.write(SUMMARIES, reduce(DataFrame.unionByName, [_person_sketches(cdm, i) for i in sketched]), sketched)
    run.write_whole(CATALOGUE, analysis_catalogue(spark))
    if with_heel:
        concept = cdm["concept"] if "concept" in cdm.tables else None
        results = StoredResults(spark, output, run.preview(base))
        run.write_whole(HEEL, heel.run_heel(results, concept, version=cdm.version, this_year=this_year))
    if clusters:
        clusters.release()
    return StoredResults(spark, output, store.commit(run, base))
