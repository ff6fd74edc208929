"""Column expressions shared by the operators."""

from popscan.functions.exprs import (
    age_decile,
    decile_label,
    first_of_month,
    month_index,
    month_key,
    month_key_of_index,
    ratio,
)

__all__ = [
    "age_decile",
    "decile_label",
    "first_of_month",
    "month_index",
    "month_key",
    "month_key_of_index",
    "ratio",
]
