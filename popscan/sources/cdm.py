"""Reading clinical tables: load, normalise dates, adapt version 4, check schemas."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from popscan import schemas
from popscan.cdm import DEFAULT_SOURCE_NAME, Cdm

_DATE_FORMATS = ("yyyy-MM-dd", "M/d/yyyy", "yyyy-M-d")


def parse_date(c: Column) -> Column:
    """ISO or ``M/D/YYYY`` text to a date; anything else becomes NULL."""
    # a trailing time of day is dropped
    text = F.substring_index(F.trim(c), " ", 1)
    return F.coalesce(*[F.try_to_date(text, f) for f in _DATE_FORMATS])


def normalise_dates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Turn text and timestamp columns into dates; by default every ``*_date``."""
    wanted = [c for c in df.columns if c.lower().endswith("_date")] if columns is None else columns
    types = {f.name: f.dataType for f in df.schema.fields}
    changed = {}
    for c in wanted:
        if isinstance(types[c], T.StringType):
            changed[c] = parse_date(F.col(c))
        elif not isinstance(types[c], T.DateType):
            changed[c] = F.col(c).cast("date")
    return df.withColumns(changed) if changed else df


def adapt_v4(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Give version 4 tables the column names of version 5."""
    return {
        name: df.withColumnsRenamed(schemas.V4_RENAMES[name]) if name in schemas.V4_RENAMES else df
        for name, df in tables.items()
    }


def load_tables(spark: SparkSession, location: str, version: str = "v5", format: str = "parquet") -> dict[str, DataFrame]:
    """Tables of the model found under ``location``.

    ``location`` is a folder with one sub-folder or ``<table>.<format>`` file
    per table, or ``db:<name>`` for tables of the session catalogue. Only
    metadata is read; missing tables are left out, and a warning names them
    (see ``validate_schema``).
    """
    names = schemas.CDM[version]
    out: dict[str, DataFrame] = {}
    if location.startswith("db:"):
        database = location[3:]
        present = {t.name.lower() for t in spark.catalog.listTables(database)}
        _warn_missing(location, [n for n in names if n not in present])
        return {n: _lower(spark.table(f"{database}.{n}")) for n in names if n in present}
    for n in names:
        reader = spark.read.format(format)
        if format == "csv":
            text = T.StructType([T.StructField(f.name, T.StringType()) for f in names[n].fields])
            reader = reader.option("header", True).option("enforceSchema", False).schema(text)
        df = _first_found(reader, [f"{location.rstrip('/')}/{name}{end}" for end in ("", f".{format}") for name in (n, n.upper())])
        if df is not None:
            out[n] = _typed(df, names[n]) if format == "csv" else _lower(df)
    if not out:
        raise FileNotFoundError(f"{location} holds no table of the model")
    _warn_missing(location, [n for n in names if n not in out])
    return out


def _first_found(reader: DataFrameReader, paths: list[str]) -> DataFrame | None:
    for path in paths:
        try:
            return reader.load(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return None


def _warn_missing(location: str, names: list[str]) -> None:
    if names:
        warnings.warn(f"{location} lacks tables, and analyses on them cannot run: {names}", stacklevel=3)


def _lower(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast text columns to the declared types; unreadable values become NULL."""
    return df.select(
        *[
            (parse_date(F.col(f.name)) if isinstance(f.dataType, T.DateType) else F.col(f.name).try_cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def load_cdm(
    spark: SparkSession,
    location: str,
    version: str = "v5",
    source_name: str = DEFAULT_SOURCE_NAME,
    format: str = "parquet",
) -> Cdm:
    """A data set ready for analysis: dates normalised, version 4 names adapted."""
    tables = {n: normalise_dates(df) for n, df in load_tables(spark, location, version, format).items()}
    if version == "v4":
        tables = adapt_v4(tables)
    return Cdm(tables, source_name=source_name, version=version)


def schema_defects(cdm: Cdm) -> list[str]:
    """Missing tables, and missing columns as ``table.column``, of a loaded data set; from schemas alone."""
    out = []
    for name, schema in schemas.CDM[cdm.version].items():
        if name not in cdm.tables:
            out.append(name)
            continue
        renames = schemas.V4_RENAMES.get(name, {}) if cdm.version == "v4" else {}
        have = {c.lower() for c in cdm[name].columns}
        out += [f"{name}.{c}" for f in schema.fields if (c := renames.get(f.name, f.name)) not in have]
    return out


def validate_schema(spark: SparkSession, tables: Mapping[str, DataFrame], version: str = "v5") -> DataFrame:
    """One row per expected column: ``table_name, column_name, expected, found, status``.

    Status is ``ok``, ``type differs`` (readable, but not the declared type),
    ``missing column`` or ``missing table``. Only schemas are compared, no
    data is read. Pass tables under the names of ``version``.
    """
    rows = []
    for name, schema in schemas.CDM[version].items():
        df = tables[name] if name in tables else None
        found = {} if df is None else {f.name.lower(): f.dataType for f in df.schema.fields}
        for f in schema.fields:
            have = found.get(f.name)
            if df is None:
                status = "missing table"
            elif have is None:
                status = "missing column"
            else:
                status = "ok" if have == f.dataType else "type differs"
            rows.append(
                (name, f.name, f.dataType.simpleString(), have.simpleString() if have else None, status)
            )
    return spark.createDataFrame(
        rows, "table_name string, column_name string, expected string, found string, status string"
    )
