"""Rendering of check queries over the derived clinical tables."""

from __future__ import annotations

import re

from popscan.sources.derived import DERIVED, ctes

_NAMES = re.compile(r"\b(" + "|".join(DERIVED) + r")\b")


def with_tables(body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix a query with the derived tables it (or ``extra``) mentions."""
    extra = extra or []
    text = body + " ".join(sql for _, sql in extra)
    parts = ctes(list(dict.fromkeys(_NAMES.findall(text)))) + extra
    if not parts:
        return body
    return "WITH " + ",\n".join(f"{name} AS MATERIALIZED ({sql})" for name, sql in parts) + "\n" + body


# A third of the last kept digit: halves that are exact in the data (a mean over
# 64 records, say) would otherwise round by the order of summation.
OFF_HALF = 3.3e-8


def stable(x: str) -> str:
    """A mean or deviation cut to six decimals, away from exact halves."""
    return rounded(f"({x} + {OFF_HALF})", 6)


def rounded(x: str, digits: int) -> str:
    """Round the shortest decimal text of a double, halves away from zero."""
    return f"CAST(round(CAST(CAST({x} AS varchar) AS decimal(38, 15)), {digits}) AS double)"
