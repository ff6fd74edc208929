"""Result tables for the check queries: the wanted analyses as WITH clauses."""

from __future__ import annotations

import re

from popscan_checks.analyses import Q, analysis_sql
from popscan_checks.base import with_tables

_STATS = ("min_value", "max_value", "avg_value", "stdev_value", *Q.values())


def _padded(body: str, stats: bool) -> str:
    have = set(re.findall(r"AS (stratum_\d)", body))
    cols = ["analysis_id"]
    cols += [s if s in have else f"CAST(NULL AS varchar) AS {s}" for s in (f"stratum_{i}" for i in range(1, 5))]
    cols += ["count_value", *(_STATS if stats else ())]
    return f"SELECT {', '.join(cols)} FROM ({body}) AS b"


def with_results(body: str, counts: tuple[int, ...] = (), dists: tuple[int, ...] = ()) -> str:
    """Give a query ``res`` (counts) and ``dst`` (distributions) of the given analyses.

    Means and deviations keep all digits here.
    """
    sql = analysis_sql()
    raw = re.compile(r"CAST\(round\(CAST\(CAST\(\(((?:avg|stddev_samp)\(v\)) \+ [^)]*\) AS varchar\) AS decimal\(38, 15\)\), 6\) AS double\)")
    extra = []
    if counts:
        extra.append(("res", " UNION ALL ".join(_padded(sql[i], False) for i in counts)))
    if dists:
        extra.append(("dst", " UNION ALL ".join(_padded(raw.sub(r"\1", sql[i]), True) for i in dists)))
    return with_tables(body, extra)
