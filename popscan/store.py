"""A versioned result store: a folder per run, and a manifest that says which folder holds which analysis.

A run writes into ``versions/<run>`` only. What readers see is decided by the manifest, one small file per committed
version, written last by one task: a run that breaks before it leaves the store as it was, and one that breaks within it
leaves no file. A rerun of some analyses takes all others over by reference: its manifest names the folders that already
hold them, nothing is copied or rewritten. Older versions stay readable until their folders are removed.

Nothing here lists or deletes files, so any storage that Spark reads and writes will do. Runs announce themselves in
``started``, hence :meth:`ResultStore.unreferenced` can name folders that a broken run left, or that no recent version
needs. One run at a time should write to a store: of two that commit on the same base the later name wins whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ``analysis_id`` is null for tables that belong to the run as a whole.
ENTRY = "version long, run string, committed_at timestamp, kind string, analysis_id int, folder string"
RUN = "run string, started_at timestamp"


@dataclass(frozen=True)
class Version:
    """A committed state of the store: the folder of each (kind, analysis); kinds of the whole run have the id None."""

    number: int
    run: str
    folders: Mapping[tuple[str, int | None], str]

    def of(self, kind: str) -> dict[int | None, str]:
        return {i: f for (k, i), f in self.folders.items() if k == kind}


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


class ResultStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _log(self, name: str, schema: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as e:
            if _missing(e):
                return None
            raise

    def _append(self, name: str, rows: list[tuple], schema: str, stamp: str) -> None:
        df = self.spark.createDataFrame(rows, schema).withColumn(stamp, F.current_timestamp())
        df.coalesce(1).write.mode("append").parquet(f"{self.path}/{name}")  # one file: whole or not there

    def manifest(self) -> DataFrame | None:
        """All entries of all versions; None before the first commit."""
        return self._log("manifest", ENTRY)

    def version(self, number: int | None = None) -> Version:
        """The latest version, or an older one by number."""
        log = self.manifest()
        if log is not None and number is not None:
            log = log.filter(F.col("version") == number)
        # of two runs that committed the same number one whole manifest counts
        last = None if log is None else log.agg(F.max(F.struct("version", "run")).alias("v")).first()["v"]
        if last is None:
            raise FileNotFoundError(f"no committed version{'' if number is None else f' {number}'} in {self.path}")
        rows = log.filter((F.col("version") == last["version"]) & (F.col("run") == last["run"])).collect()
        return Version(last["version"], last["run"], {(r.kind, r.analysis_id): r.folder for r in rows if r.kind})

    def versions(self) -> DataFrame:
        """``version, run, committed_at, entries, written`` (by that run itself, not taken over)."""
        log = self.manifest()
        if log is None:
            log = self.spark.createDataFrame([], ENTRY)
        own = F.col("folder") == F.concat(F.lit("versions/"), F.col("run"))
        return log.groupBy("version", "run", "committed_at").agg(
            F.count("kind").alias("entries"), F.count(F.when(own, 1)).alias("written")
        )

    def begin(self) -> Run:
        run = uuid.uuid4().hex
        self._append("started", [(run, None)], RUN, "started_at")
        return Run(self, run)

    def commit(self, run: Run, base: Version | None) -> Version:
        """Make ``run`` the next version; what it did not redo is taken over from ``base``."""
        folders = run.preview(base).folders
        log = self.manifest()
        last = None if log is None else log.agg(F.max("version")).first()[0]
        number = (last or 0) + 1
        rows = [(number, run.name, None, k, i, f) for (k, i), f in folders.items()] or [(number, run.name, None, None, None, None)]
        self._append("manifest", rows, ENTRY, "committed_at")
        return Version(number, run.name, folders)

    def unreferenced(self, keep: int = 1) -> DataFrame:
        """``run, started_at, folder`` of runs that none of the last ``keep`` versions refers to: broken or superseded ones."""
        started = self._log("started", RUN)
        if started is None:
            started = self.spark.createDataFrame([], RUN)
        started = started.withColumn("folder", F.concat(F.lit("versions/"), F.col("run")))
        log = self.manifest()
        if log is None:
            return started
        recent = log.filter(F.col("version") > log.agg(F.max("version") - keep).scalar())
        return started.join(recent, "folder", "left_anti").select("run", "started_at", "folder")

    def read(self, version: Version, kind: str, schema, ids: Iterable[int] | None = None) -> DataFrame:
        """Rows of the wanted analyses (all by default), each from the folder that the version names."""
        at: dict[str, list[int]] = {}
        for i, folder in version.of(kind).items():
            if ids is None or i in ids:
                at.setdefault(folder, []).append(i)
        out = self.spark.createDataFrame([], schema)
        for folder, held in at.items():
            try:
                part = self.spark.read.schema(schema).parquet(f"{self.path}/{folder}/{kind}")
            except AnalysisException as e:
                if not _missing(e):
                    raise
                continue  # its analyses have no rows
            if None not in held:
                part = part.filter(F.col("analysis_id").isin(held))
            out = out.unionByName(part)
        return out


class Run:
    """What a run has written so far; nobody reads it before the commit."""

    def __init__(self, store: ResultStore, name: str):
        self.store, self.name = store, name
        self.folder = f"versions/{name}"
        self.entries: set[tuple[str, int | None]] = set()

    def write(self, kind: str, df: DataFrame, ids: Iterable[int]) -> None:
        """Rows of analyses, by analysis; ``ids`` are those computed, with rows or without."""
        # rebalance: no tiny files for small analyses, no single writer for a large one
        (
            df.hint("rebalance", "analysis_id")
            .write.mode("append")
            .partitionBy("analysis_id")
            .parquet(f"{self.store.path}/{self.folder}/{kind}")
        )
        self.entries.update((kind, i) for i in ids)

    def write_whole(self, kind: str, df: DataFrame) -> None:
        """A table of the run as a whole."""
        df.write.mode("overwrite").parquet(f"{self.store.path}/{self.folder}/{kind}")
        self.entries.add((kind, None))

    def preview(self, base: Version | None) -> Version:
        """The version that a commit on ``base`` would make; tables of the old run as a whole are stale and stay behind."""
        folders = {(k, i): f for (k, i), f in (base.folders if base else {}).items() if i is not None}
        return Version(0, self.name, {**folders, **{entry: self.folder for entry in self.entries}})
