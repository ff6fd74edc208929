"""Intermediate tables in the folder that the cluster shares, named by ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where unset, as in tests on one machine, one of our own.

    On a cluster a folder of our own would be another one on each node, so there the setting is asked for.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError(f"spark.checkpoint.dir names no folder that the executors of {master} share")
        app = spark.sparkContext.applicationId
        folder = _own[app] = _own.get(app) or tempfile.mkdtemp(prefix="popscan-")
    return folder.rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """``df`` written as Parquet and read again: cuts the plan, and survives lost executors."""
    path = fresh(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, name: str, key: str, codec: str = "zstd") -> DataFrame:
    """:func:`stored`, bucketed by ``key`` as a shuffle would deal it out: a join on ``key`` leaves these rows where they are.

    Buckets are known to the catalogue only, so the table is named there until it is read; its files stay in the folder.
    """
    spark = df.sparkSession
    path = fresh(spark, name)
    table = f"popscan_stored_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").bucketBy(n, key).options(path=path, compression=codec).saveAsTable(table)
    try:
        return spark.table(table)
    finally:
        spark.sql(f"DROP TABLE {table}")
