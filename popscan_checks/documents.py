"""Check queries for documents: how many entries each section holds, and every value in its place."""

from __future__ import annotations

from popscan.reports.documents import DETAILS, DOCUMENTS, Histogram
from popscan.reports.queries import REPORTS
from popscan_checks.base import rounded
from popscan_checks.reports import report_sql


def summary_entries(name: str) -> str:
    sql = report_sql()
    parts = []
    for key, part in DOCUMENTS[name].items():
        query = part.data.query if isinstance(part, Histogram) else part.query
        parts.append(
            f"SELECT '{name}.json' AS path, '{key}' AS section, CAST(count(*) AS integer) AS entries FROM ({sql[query]}) AS q"
        )
    return "\nUNION ALL\n".join(parts)


def detail_entries(domain: str) -> str:
    sql = report_sql()
    folder, prefix, sections = DETAILS[domain]
    tree = sql[f"{domain}_treemap"]
    parts = []
    for key, s in sections.items():
        parts.append(
            f"SELECT '{folder}/{prefix}_' || t.concept_id || '.json' AS path, '{key}' AS section, "
            f"CAST(count(s.k) AS integer) AS entries FROM (SELECT DISTINCT concept_id FROM ({tree}) AS x) AS t "
            f"LEFT JOIN (SELECT {s.concept} AS k FROM ({sql[s.query]}) AS y) AS s ON s.k = t.concept_id GROUP BY t.concept_id"
        )
    return "\nUNION ALL\n".join(parts)


def _number(x: str) -> str:
    return f"CASE WHEN try_cast({x} AS double) IS NOT NULL THEN {rounded(f'try_cast({x} AS double)', 5)} END"


def _apart(values: str) -> str:
    """Rows of ``path, section, position, field, value`` with numbers in a column of their own."""
    return (
        "SELECT path, section, CAST(position AS integer) AS position, field, "
        "CASE WHEN try_cast(value AS double) IS NULL THEN value END AS text, "
        f"{_number('value')} AS number FROM (\n{values}\n) AS v"
    )


def _unpivot(columns) -> str:
    pairs = ", ".join(f"{{'field': '{c.upper()}', 'value': CAST({c} AS varchar)}}" for c in columns)
    return f"unnest([{pairs}], recursive := true)"


def _ordered(section, partition: str = "") -> str:
    way = "DESC NULLS LAST" if section.descending else "ASC NULLS FIRST"
    order = ", ".join(f"{c} {way}" for c in section.columns)
    return f"row_number() OVER ({partition}ORDER BY {order}) - 1 AS position"


def summary_values(name: str) -> str:
    sql = dict(report_sql())
    # the document is made from a version 5 run, which does not hold this version 4 analysis
    sql["heel_messages"] = f"SELECT * FROM ({sql['heel_messages']}) AS m WHERE attributename <> 1609"
    parts = []
    for key, part in DOCUMENTS[name].items():
        section = part.data if isinstance(part, Histogram) else part
        parts.append(
            f"SELECT '{name}.json' AS path, '{key}' AS section, position, {_unpivot(section.columns)} "
            f"FROM (SELECT *, {_ordered(section)} FROM ({sql[section.query]}) AS q) AS o"
        )
        if isinstance(part, Histogram):
            axis = (
                "SELECT {} AS lo, {} AS hi, {} AS size".format(*part.fixed)
                if part.fixed
                else f"SELECT min_value AS lo, max_value AS hi, interval_size AS size FROM ({sql[part.stats]}) AS q"
            )
            pairs = ", ".join(
                f"{{'field': '{f}', 'value': CAST({x} AS varchar)}}"
                for f, x in (("MIN", "lo"), ("MAX", "hi"), ("INTERVAL_SIZE", "size"), ("INTERVALS", "(hi - lo) / CAST(size AS double)"))
            )
            parts.append(
                f"SELECT '{name}.json' AS path, '{key}' AS section, -1 AS position, unnest([{pairs}], recursive := true) FROM ({axis}) AS a"
            )
    return _apart("\nUNION ALL\n".join(parts))


def detail_values(domain: str) -> str:
    sql = report_sql()
    folder, prefix, sections = DETAILS[domain]
    parts = []
    for key, s in sections.items():
        if "v5" not in REPORTS[s.query].versions:
            continue
        parts.append(
            f"SELECT '{folder}/{prefix}_' || {s.concept} || '.json' AS path, '{key}' AS section, position, {_unpivot(s.columns)} "
            f"FROM (SELECT *, {_ordered(s, f'PARTITION BY {s.concept} ')} FROM ({sql[s.query]}) AS q "
            f"WHERE {s.concept} IN (SELECT concept_id FROM ({sql[f'{domain}_treemap']}) AS t)) AS o"
        )
    return _apart("\nUNION ALL\n".join(parts))


def treemap_values(domain: str, columns) -> str:
    tree = report_sql()[f"{domain}_treemap"]
    return _apart(
        f"SELECT '{domain}_treemap.json' AS path, CAST(concept_id AS varchar) AS section, -1 AS position, {_unpivot(columns)} "
        f"FROM ({tree}) AS q"
    )
