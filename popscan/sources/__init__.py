"""Sources: clinical tables from files or a database, and the derived data set."""

from popscan.sources.cdm import (
    adapt_v4,
    load_cdm,
    load_tables,
    normalise_dates,
    parse_date,
    validate_schema,
)
from popscan.sources.derived import DerivedTables, StoredTables

__all__ = [
    "DerivedTables",
    "StoredTables",
    "adapt_v4",
    "load_cdm",
    "load_tables",
    "normalise_dates",
    "parse_date",
    "validate_schema",
]
