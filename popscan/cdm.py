"""Access to one clinical data set: its tables and the views analyses share."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popscan.functions import month_key

DEFAULT_SOURCE_NAME = "CMS"  # fixed value: the source name used when none is given


@dataclass(frozen=True)
class Domain:
    """An event table and the columns the common analyses use."""

    table: str
    concept: str
    start: str
    end: str | None = None
    type: str | None = None
    unit: str | None = None


@dataclass(frozen=True)
class Cdm:
    """Tables of one data set, all under version 5 column names.

    ``version`` selects the quantile rule and the version-specific analyses.
    ``rollups`` may hold event tables already reduced by ``rollup``, ``days``
    those by ``day_rollup``, clustered by person.
    """

    tables: Mapping[str, DataFrame]
    source_name: str = DEFAULT_SOURCE_NAME
    version: str = "v5"
    rollups: Mapping[str, DataFrame] = field(default_factory=dict)
    days: Mapping[str, DataFrame] = field(default_factory=dict)

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    @property
    def legacy(self) -> bool:
        return self.version == "v4"

    def persons(self) -> DataFrame:
        return self["person"].select("person_id", "gender_concept_id", "year_of_birth")

    def _events(self, domain: Domain) -> DataFrame:
        empty = F.lit(None).cast("int")
        return self[domain.table].select(
            "person_id",
            F.col(domain.concept).alias("concept_id"),
            month_key(F.col(domain.start)).alias("month"),
            (F.col(domain.type) if domain.type else empty).alias("type_id"),
            (F.col(domain.unit) if domain.unit else empty).alias("unit_id"),
            # like count(person_id): rows without a person do not count
            F.when(F.col("person_id").isNotNull(), 1).otherwise(0).alias("n"),
        )

    def events(self, domain: Domain) -> DataFrame:
        """``person_id, concept_id, month, type_id, unit_id, n`` of an event table.

        ``n`` is the number of records a row stands for, so the analyses read
        the raw table and its rollup alike.
        """
        if domain.table in self.rollups:
            return self.rollups[domain.table]
        return self._events(domain)

    def rollup(self, domain: Domain) -> DataFrame:
        """One row per person, concept, month, type and unit.

        Persons stay in the key, so distinct-person counts over any of the
        other columns remain exact. Written once, it replaces the raw table for
        the ten or so analyses of a domain.
        """
        keys = ["person_id", "concept_id", "month", "type_id", "unit_id"]
        return self._events(domain).groupBy(*keys).agg(F.sum("n").alias("n"))

    def day_rollup(self, domain: Domain) -> DataFrame:
        """``person_id, day, n``: records of an event table per person and day."""
        day = F.col(domain.start).alias("day")
        return self[domain.table].groupBy("person_id", day).agg(F.count(F.lit(1)).alias("n"))

    def with_rollups(self, rollups: Mapping[str, DataFrame]) -> Cdm:
        return replace(self, rollups={**self.rollups, **rollups})
