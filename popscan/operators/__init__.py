"""Reusable dataflow operators; each maps DataFrames to a DataFrame."""

from popscan.operators.banding import relative_to_range
from popscan.operators.calendar import calendar_coverage, disjoint_segments
from popscan.operators.counts import (
    by_demographics,
    count_distinct,
    count_of_counts,
    count_records,
    count_rows,
    count_via,
    count_where,
    first_period,
)
from popscan.operators.dist import STATISTICS, distribution, histogram
from popscan.operators.grouping import PERSONS, RECORDS, Stratum, stratify
from popscan.operators.integrity import (
    Check,
    check_all,
    inverted_check,
    inverted_dates,
    no_value,
    no_value_check,
    orphan_check,
    orphans,
    outside_period,
    outside_period_clustered,
)
from popscan.operators.joins import heavy_keys, spread_join

__all__ = [
    "PERSONS",
    "RECORDS",
    "STATISTICS",
    "Check",
    "Stratum",
    "by_demographics",
    "calendar_coverage",
    "check_all",
    "count_distinct",
    "count_of_counts",
    "count_records",
    "count_rows",
    "count_via",
    "count_where",
    "disjoint_segments",
    "distribution",
    "first_period",
    "heavy_keys",
    "histogram",
    "inverted_check",
    "inverted_dates",
    "no_value",
    "no_value_check",
    "orphan_check",
    "orphans",
    "outside_period",
    "outside_period_clustered",
    "relative_to_range",
    "spread_join",
    "stratify",
]
