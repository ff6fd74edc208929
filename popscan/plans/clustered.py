"""Person-clustered tables: bucketed by person and sorted, so that person-level work needs no fact-sized exchange.

Most analyses first reduce events per person, join the person table and only then count by strata. Over tables that are
bucketed alike by ``person_id`` the distinct, the join and the windows per person find their rows where they are; what
crosses the network is the counted strata. Clustering costs one exchange of each reduced table when it is written, which
pays from the second analysis on.

The bucket layout lives in the session's catalogue, the files in the shared folder. ``release`` takes the entries out again;
files stay, as those of other rollups do.
"""

from __future__ import annotations

import uuid
from collections import ChainMap
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from popscan.cdm import Cdm, Domain

PERSON = "person_id"


@dataclass
class Clusters:
    """Writes clustered tables below ``folder``, all with the same number of buckets."""

    spark: SparkSession
    folder: str
    buckets: int
    names: list[str] = field(default_factory=list)

    def store(self, df: DataFrame, name: str, sort: Sequence[str] = ()) -> DataFrame:
        table = f"popscan_{name}_{uuid.uuid4().hex[:12]}"
        (
            df.repartition(self.buckets, PERSON)  # one file for each bucket
            .write.bucketBy(self.buckets, PERSON)
            .sortBy(PERSON, *sort)
            .option("path", f"{self.folder}/{name}")
            .saveAsTable(table, format="parquet")
        )
        self.names.append(table)
        return self.spark.table(table)

    def release(self) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.names.clear()


def clustered(cdm: Cdm, domains: Iterable[Domain], folder: str, buckets: int | None = None) -> tuple[Cdm, Clusters]:
    """``cdm`` with persons, observation periods and the rollups of ``domains`` clustered by person.

    ``buckets`` defaults to the shuffle partitions: as many tasks as an exchange would have.
    """
    spark = cdm["person"].sparkSession
    out = Clusters(spark, folder, buckets or int(spark.conf.get("spark.sql.shuffle.partitions")))
    tables = {
        "person": out.store(cdm["person"], "person"),
        "observation_period": out.store(cdm["observation_period"], "observation_period", ["observation_period_start_date"]),
    }
    rollups, days = dict(cdm.rollups), dict(cdm.days)
    for d in domains:
        rollups[d.table] = out.store(cdm.rollup(d), f"rollup_{d.table}", ["concept_id", "month"])
        days[d.table] = out.store(cdm.day_rollup(d), f"days_{d.table}", ["day"])
    return replace(cdm, tables=ChainMap(tables, cdm.tables), rollups=rollups, days=days), out
