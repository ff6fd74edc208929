"""The catalogue of analyses and the registry behind it.

An analysis is a number, a name, stratum names and a builder that turns a
``Cdm`` into a DataFrame. Add one with the ``analysis`` decorator; builders
that serve several numbers from one scan use ``shared_analyses``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popscan import schemas
from popscan.cdm import Cdm, Domain
from popscan.operators import STATISTICS, Check, Stratum, check_all, stratify

RESULTS, DIST, BOTH = "results", "dist", "both"
_MEASURES = ("count_value", *STATISTICS)


@dataclass(frozen=True)
class Analysis:
    """A catalogued analysis.

    ``build`` returns the strata in order followed by ``count_value`` and, for
    distributions, the statistics. A shared builder takes the wanted ids as a
    second argument and returns ``analysis_id`` as well. An analysis that is
    one grouping of a domain's events says so by ``grouping``; several of one
    domain are then computed in a single pass (:func:`stratified`). So are
    integrity checks of one fact table that are described by ``check``
    (:func:`checked`).
    """

    id: int
    name: str
    stratum_names: tuple[str, ...]
    family: str
    kind: str
    build: Callable[..., DataFrame]
    shared: bool = False
    versions: tuple[str, ...] = ("v4", "v5")
    grouping: tuple[Domain, Stratum] | None = None
    check: tuple[str, Check] | None = None

    def frame(self, cdm: Cdm) -> DataFrame:
        """``analysis_id, stratum_1.., count_value[, statistics]`` in final types."""
        return _shape(self.build(cdm, [self.id]) if self.shared else self.build(cdm), self.id)


_REGISTRY: dict[int, Analysis] = {}


def _shape(df: DataFrame, analysis_id: int | None = None) -> DataFrame:
    strata = [c for c in df.columns if c not in _MEASURES and c != "analysis_id"]
    number = F.col("analysis_id") if analysis_id is None else F.lit(analysis_id)
    return df.select(
        number.cast("int").alias("analysis_id"),
        *[F.col(c).cast("string").alias(f"stratum_{i}") for i, c in enumerate(strata, 1)],
        *[F.col(c) for c in df.columns if c in _MEASURES],
    )


def pad(df: DataFrame, kind: str) -> DataFrame:
    """Widen a frame to the full result schema."""
    schema = schemas.RESULTS if kind == RESULTS else schemas.RESULTS_DIST
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def register(entry: Analysis) -> None:
    if entry.id in _REGISTRY:
        raise ValueError(f"analysis {entry.id} is registered twice")
    _REGISTRY[entry.id] = entry


def analysis(
    number: int,
    name: str,
    strata: Sequence[str] = (),
    family: str = "COUNT",
    kind: str = RESULTS,
    versions: tuple[str, ...] = ("v4", "v5"),
    check: tuple[str, Check] | None = None,
):
    """Register the decorated builder under ``number``."""

    def wrap(build: Callable[[Cdm], DataFrame]):
        register(Analysis(number, name, tuple(strata), family, kind, build, versions=versions, check=check))
        return build

    return wrap


def shared_analyses(
    names: Mapping[int, str],
    strata: Sequence[str] = (),
    family: str = "DIST",
    kind: str = DIST,
    versions: tuple[str, ...] = ("v4", "v5"),
):
    """Register one builder ``(cdm, ids)`` for several numbers."""

    def wrap(build: Callable[[Cdm, Sequence[int]], DataFrame]):
        for number, name in names.items():
            register(Analysis(number, name, tuple(strata), family, kind, build, True, versions))
        return build

    return wrap


def analyses(version: str | None = None) -> dict[int, Analysis]:
    """All registered analyses by number, optionally of one model version."""
    import popscan.analyses  # noqa: F401 - registers the built-in analyses

    return {
        i: _REGISTRY[i] for i in sorted(_REGISTRY) if version is None or version in _REGISTRY[i].versions
    }


def stratified(cdm: Cdm, ids: Iterable[int]) -> DataFrame:
    """Analyses that group the events of one domain, from one pass over them: ``analysis_id, stratum_1.., count_value``."""
    wanted = {i: analyses()[i].grouping for i in ids}
    if None in wanted.values() or len({d for d, _ in wanted.values()}) != 1:
        raise ValueError(f"not groupings of one event table: {sorted(wanted)}")
    domain = next(iter(wanted.values()))[0]
    return _shape(stratify(cdm.events(domain), {i: s for i, (_, s) in wanted.items()}))


def checked(cdm: Cdm, ids: Iterable[int]) -> DataFrame:
    """Integrity checks of one fact table, from one scan of it: ``analysis_id, count_value``."""
    wanted = {i: analyses()[i].check for i in ids}
    if None in wanted.values() or len({t for t, _ in wanted.values()}) != 1:
        raise ValueError(f"not checks of one table: {sorted(wanted)}")
    table = next(iter(wanted.values()))[0]
    return _shape(check_all(cdm[table], {i: c for i, (_, c) in wanted.items()}, cdm.tables))


def frames(cdm: Cdm, ids: Iterable[int]) -> list[tuple[str, DataFrame]]:
    """``(kind, frame)`` for the given analyses, in full result schemas.

    Analyses of one shared builder come from a single frame and thus one scan,
    and so do those that group the events of one domain or check one table.
    """
    known = analyses()
    out: list[tuple[str, DataFrame]] = []
    shared: dict[Callable, list[int]] = {}
    grouped: dict[tuple[Callable, Domain | str], list[int]] = {}
    for i in ids:
        entry = known[i]
        if entry.shared:
            shared.setdefault(entry.build, []).append(i)
        elif entry.grouping:
            grouped.setdefault((stratified, entry.grouping[0]), []).append(i)
        elif entry.check:
            grouped.setdefault((checked, entry.check[0]), []).append(i)
        else:
            frame = entry.frame(cdm)
            for kind in (RESULTS, DIST) if entry.kind == BOTH else (entry.kind,):
                out.append((kind, pad(frame, kind)))
    for (together, _), wanted in grouped.items():
        alone = len(wanted) == 1
        out.append((RESULTS, pad(known[wanted[0]].frame(cdm) if alone else together(cdm, wanted), RESULTS)))
    for build, wanted in shared.items():
        out.append((known[wanted[0]].kind, pad(_shape(build(cdm, wanted)), known[wanted[0]].kind)))
    return out


def analysis_catalogue(spark: SparkSession) -> DataFrame:
    """The catalogue as a DataFrame (number, name, stratum names)."""
    rows = [
        (a.id, a.name, *(list(a.stratum_names) + [None] * 5)[:5]) for a in analyses().values()
    ]
    return spark.createDataFrame(rows, schemas.ANALYSIS)
