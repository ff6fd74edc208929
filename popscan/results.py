"""Result sets: where summaries come from, suppression, writing, fetching, comparing."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from popscan import schemas
from popscan.catalogue import DIST, RESULTS, analyses, frames
from popscan.cdm import Cdm
from popscan.operators import STATISTICS, summaries
from popscan.store import ResultStore, Version

SMALL_CELL_COUNT = 5  # fixed value: default suppression limit
CATALOGUE, HEEL = "catalogue", "heel"  # tables of a run as a whole
SUMMARIES = "summaries"  # monthly sketches, an option of a run
STRATA = tuple(f"stratum_{i}" for i in range(1, 6))


def suppress_small_cells(df: DataFrame, limit: int = SMALL_CELL_COUNT) -> DataFrame:
    """Drop rows whose count is at most ``limit``."""
    return df.filter(F.col("count_value") > limit)


def _union(spark: SparkSession, parts: Sequence[DataFrame], kind: str) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], schemas.RESULTS if kind == RESULTS else schemas.RESULTS_DIST)
    return reduce(DataFrame.unionByName, parts)


class ResultSet:
    """Counts and distributions of many analyses, read by id."""

    spark: SparkSession

    def counts(self, *ids: int) -> DataFrame:
        raise NotImplementedError

    def dist(self, *ids: int) -> DataFrame:
        raise NotImplementedError


class LiveResults(ResultSet):
    """Computes the wanted analyses from a data set when asked; nothing is stored.

    Fine for single questions. For reports over many analyses store the
    results first: each use of a live slice plans its analysis again.
    """

    def __init__(self, spark: SparkSession, cdm: Cdm, limit: int | None = None):
        self.spark, self._cdm, self._limit = spark, cdm, limit

    def _slice(self, ids: Iterable[int], kind: str) -> DataFrame:
        parts = [df for k, df in frames(self._cdm, ids) if k == kind]
        df = _union(self.spark, parts, kind)
        return df if self._limit is None else suppress_small_cells(df, self._limit)

    def counts(self, *ids: int) -> DataFrame:
        return self._slice(ids, RESULTS)

    def dist(self, *ids: int) -> DataFrame:
        return self._slice(ids, DIST)


class AskedResults(ResultSet):
    """Holds no rows and notes which analyses it is asked for: what a report or rule has to have stored.

    Build the report over it first, run ``ids`` once and build it again over the stored results.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.ids = spark, set()

    def _note(self, ids: Iterable[int], kind: str) -> DataFrame:
        self.ids.update(ids)
        return _union(self.spark, [], kind)

    def counts(self, *ids: int) -> DataFrame:
        return self._note(ids, RESULTS)

    def dist(self, *ids: int) -> DataFrame:
        return self._note(ids, DIST)


class FrameResults(ResultSet):
    """Results held in two long DataFrames."""

    def __init__(self, results: DataFrame, results_dist: DataFrame):
        self.spark = results.sparkSession
        self._results, self._dist = results, results_dist

    def counts(self, *ids: int) -> DataFrame:
        return self._results.filter(F.col("analysis_id").isin(*ids))

    def dist(self, *ids: int) -> DataFrame:
        return self._dist.filter(F.col("analysis_id").isin(*ids))


class StoredResults(ResultSet):
    """Results written by ``run_analyses``: the latest committed version of a store, or an older one by number."""

    def __init__(self, spark: SparkSession, path: str, version: int | Version | None = None):
        self.spark, self.store = spark, ResultStore(spark, path)
        self.version = version if isinstance(version, Version) else self.store.version(version)

    def counts(self, *ids: int) -> DataFrame:
        return self.store.read(self.version, RESULTS, schemas.RESULTS, ids)

    def dist(self, *ids: int) -> DataFrame:
        return self.store.read(self.version, DIST, schemas.RESULTS_DIST, ids)

    def ids(self, kind: str) -> list[int]:
        """Analyses of a kind that the version holds, with rows or without."""
        return sorted(self.version.of(kind))

    def summaries(self, *ids: int) -> DataFrame:
        """Monthly person sketches of analyses that count persons by concept; without rows if the run made none."""
        return self.store.read(self.version, SUMMARIES, schemas.SUMMARIES, ids)

    def catalogue(self) -> DataFrame:
        return self.store.read(self.version, CATALOGUE, schemas.ANALYSIS)

    def heel(self) -> DataFrame:
        """Findings of the run; without rows if it was made without the rules."""
        return self.store.read(self.version, HEEL, schemas.HEEL_RESULTS)


class StoredOrLive(ResultSet):
    """Stored results, and for analyses the store does not hold a live slice."""

    def __init__(self, stored: StoredResults, live: LiveResults):
        self.spark, self._stored, self._live = stored.spark, stored, live

    def _slice(self, ids: Iterable[int], kind: str, read: str) -> DataFrame:
        held = set(self._stored.ids(kind))
        parts = [(self._stored, [i for i in ids if i in held]), (self._live, [i for i in ids if i not in held])]
        return _union(self.spark, [getattr(of, read)(*some) for of, some in parts if some], kind)

    def counts(self, *ids: int) -> DataFrame:
        return self._slice(ids, RESULTS, "counts")

    def dist(self, *ids: int) -> DataFrame:
        return self._slice(ids, DIST, "dist")


def approximate_persons(
    results: StoredResults, number: int, first: int | None = None, last: int | None = None,
    limit: int | None = SMALL_CELL_COUNT,
) -> DataFrame:
    """Distinct persons of an analysis over the months ``first`` to ``last``, estimated from a run's sketches.

    ``stratum_1, records, count_value``; records are exact, persons within ``summaries.person_error()``. Estimates up
    to ``limit`` are suppressed. Months of several runs may be merged: sketches add up without counting anyone twice.
    """
    found = summaries.merged(results.summaries(number), ["stratum_1"], first, last)
    found = found.select("stratum_1", "records", summaries.person_estimate().alias("count_value"))
    return found if limit is None else suppress_small_cells(found, limit)


def fetch_analysis(results: ResultSet, number: int) -> DataFrame:
    """One analysis, unused strata dropped and the others under their catalogue names."""
    entry = analyses()[number]
    df = results.dist(number) if entry.kind == DIST else results.counts(number)
    strata = [
        F.col(f"stratum_{i}").alias(name.upper()) for i, name in enumerate(entry.stratum_names, 1) if name
    ]
    measures = ["count_value"] + (list(STATISTICS) if entry.kind == DIST else [])
    return df.select("analysis_id", *strata, *measures)


def significant(c: Column, digits: int = 5) -> Column:
    """Round to ``digits`` significant digits, then to as many decimals."""
    size = F.floor(F.log10(F.abs(c))).cast("int")
    scale = F.pow(F.lit(10.0), F.lit(digits - 1) - size)
    return F.when(c == 0, F.lit(0.0)).otherwise(F.round(F.round(c * scale) / scale, digits))


def compare_results(
    left: DataFrame,
    right: DataFrame,
    digits: int = 5,
    expected_differences: Sequence[int] = (818,),
) -> DataFrame:
    """Rows in which two result sets differ.

    Rows are matched by analysis and strata (NULL equals empty), numbers are
    compared after rounding. ``difference`` is ``only left``, ``only right`` or
    the name of the first column that differs; ``expected`` marks analyses
    known to differ between platforms.
    """
    measures = [c for c in left.columns if c in ("count_value", *STATISTICS) and c in right.columns]

    def side(df: DataFrame, tag: str) -> DataFrame:
        return df.select(
            "analysis_id",
            *[F.coalesce(F.col(s), F.lit("")).alias(s) for s in STRATA],
            F.struct(*[significant(F.col(m).cast("double"), digits).alias(m) for m in measures]).alias(tag),
        )

    joined = side(left, "l").join(side(right, "r"), ["analysis_id", *STRATA], "full_outer")
    kind = F.when(F.col("r").isNull(), "only left").when(F.col("l").isNull(), "only right")
    for m in measures:
        kind = kind.when(~F.col(f"l.{m}").eqNullSafe(F.col(f"r.{m}")), m)
    return (
        joined.withColumn("difference", kind)
        .filter(F.col("difference").isNotNull())
        .select(
            "analysis_id", *STRATA, "difference",
            F.col("analysis_id").isin(*expected_differences).alias("expected"),
            F.col("l").alias("left"), F.col("r").alias("right"),
        )
    )


def compare_documents(left: DataFrame, right: DataFrame) -> DataFrame:
    """Documents (``path, document``) that differ after ``"NA"`` is read as empty text."""

    def side(df: DataFrame, tag: str) -> DataFrame:
        text = F.regexp_replace(F.col("document"), '"NA"', '""')
        return df.select("path", F.sha2(text, 256).alias(tag))

    joined = side(left, "l").join(side(right, "r"), "path", "full_outer")
    kind = (
        F.when(F.col("r").isNull(), "only left")
        .when(F.col("l").isNull(), "only right")
        .when(F.col("l") != F.col("r"), "differs")
    )
    return joined.select("path", kind.alias("difference")).filter(F.col("difference").isNotNull())


__all__ = [
    "AskedResults",
    "FrameResults",
    "LiveResults",
    "ResultSet",
    "StoredOrLive",
    "StoredResults",
    "approximate_persons",
    "compare_documents",
    "compare_results",
    "fetch_analysis",
    "significant",
    "suppress_small_cells",
]
