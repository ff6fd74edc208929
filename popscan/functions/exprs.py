"""Column expressions: calendar keys, ages, labels, ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_key(date: Column) -> Column:
    """Calendar month as the integer ``yyyymm``."""
    return F.year(date) * 100 + F.month(date)


def month_index(date: Column) -> Column:
    """Months since year 0, so that neighbouring months differ by one."""
    return F.year(date) * 12 + F.month(date) - 1


def month_key_of_index(index: Column) -> Column:
    """Turn a month index back into ``yyyymm``."""
    return F.floor(index / 12) * 100 + index % 12 + 1


def first_of_month(date: Column) -> Column:
    """First day of the month as ``yyyy-MM-dd`` text."""
    return F.date_format(F.trunc(date, "month"), "yyyy-MM-dd")


def age_decile(year: Column, year_of_birth: Column) -> Column:
    """Ten-year age band; floors, so an age of -5 lies in band -1."""
    return F.floor((year - year_of_birth) / 10)


def decile_label(decile: Column) -> Column:
    """``3`` -> ``30-39``."""
    low = decile.try_cast("int") * 10
    return F.concat_ws("-", low.cast("string"), (low + 9).cast("string"))


def ratio(numerator: Column, denominator: Column, scale: int = 1, digits: int | None = 5) -> Column:
    """``scale * numerator / denominator`` as a double, NULL for a zero denominator."""
    value = numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))
    if scale != 1:
        value = F.lit(float(scale)) * value
    return value if digits is None else F.round(value, digits)
