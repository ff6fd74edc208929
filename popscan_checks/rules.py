"""Check queries for the quality rules, one statement per rule."""

from __future__ import annotations

from popscan.catalogue import analyses
from popscan_checks.ids import (
    ACCEPTED,
    AFTER_DEATH,
    BY_CONCEPT,
    BY_CONCEPT_AND_MONTH,
    BY_MONTH,
    BY_TYPE,
    COUNTED_DEFECTS,
    NEVER_NEGATIVE,
)
from popscan_checks.stored import with_results

THIS_YEAR = 2026


def _name(ids: tuple[int, ...]) -> str:
    cases = " ".join("WHEN {} THEN '{}'".format(i, analyses()[i].name.replace("'", "''")) for i in ids)
    return f"CASE analysis_id {cases} END"


def _row(rule: int, ids: tuple[int, ...], severity: str, sep: str, tail: str, count: str, source: str) -> str:
    return (
        f"SELECT CAST(analysis_id AS integer) AS analysis_id, '{severity}: ' || analysis_id || '{sep}' || {_name(ids)} || "
        f"{tail} AS heel_warning, CAST({rule} AS integer) AS rule_id, CAST({count} AS bigint) AS record_count FROM {source}"
    )


def rule_sql() -> dict[int, str]:
    out: dict[int, str] = {}
    out[1] = with_results(
        _row(1, COUNTED_DEFECTS, "ERROR", "-", "'; count (n=' || count_value || ') should not be > 0'", "count_value",
             "res WHERE count_value > 0"), COUNTED_DEFECTS)
    for rule, ids, severity, sep, col, test, words in (
        (2, NEVER_NEGATIVE, "ERROR", " - ", "min_value", "< 0", "min value should not be negative"),
        (3, AFTER_DEATH, "WARNING", "-", "max_value", "> 30",
         "max value should not be positive, otherwise its a zombie with data >1mo after death "),
        (24, (715,), "WARNING", "-", "max_value", "> 180", "max value should not be > 180"),
        (25, (716,), "WARNING", "-", "max_value", "> 10", "max value should not be > 10"),
        (26, (717,), "WARNING", "-", "max_value", "> 600", "max value should not be > 600"),
    ):
        out[rule] = with_results(
            _row(rule, ids, severity, sep, f"' (count = ' || count({col}) || '); {words}'", f"count({col})",
                 f"dst WHERE {col} {test} GROUP BY analysis_id"), dists=ids)
    for rule, ids, s in ((4, BY_CONCEPT, "stratum_1"), (5, BY_TYPE, "stratum_2")):
        out[rule] = with_results(
            _row(rule, ids, "ERROR", "-", f"'; ' || count(DISTINCT {s}) || ' concepts in data are not in vocabulary'",
                 f"count(DISTINCT {s})",
                 f"res LEFT JOIN concept c ON res.{s} = CAST(c.concept_id AS varchar) WHERE res.{s} IS NOT NULL "
                 "AND c.concept_id IS NULL GROUP BY analysis_id"), ids)  # fmt: skip
    out[6] = with_results(
        _row(6, BY_CONCEPT, "WARNING", "-", "'; data with unmapped concepts'", "NULL",
             "res WHERE stratum_1 = '0' GROUP BY analysis_id"), BY_CONCEPT)
    for rule, (ids, column, accepted, words) in ACCEPTED.items():
        quoted = ", ".join(f"'{a}'" for a in accepted)
        zero = "" if column == "vocabulary_id" else " AND c.concept_id <> 0"
        out[rule] = with_results(
            _row(rule, ids, "ERROR", "-",
                 f"'; ' || count(DISTINCT stratum_1) || ' concepts in data are not in correct vocabulary{words}'",
                 "count(DISTINCT stratum_1)",
                 "res JOIN concept c ON res.stratum_1 = CAST(c.concept_id AS varchar) WHERE "
                 f"lower(CAST(c.{column} AS varchar)) NOT IN ({quoted}){zero} GROUP BY analysis_id"), ids)  # fmt: skip
    for rule, number, test, words in (
        (18, 3, f"> {THIS_YEAR}", "should not have year of birth in the future"),
        (19, 3, "< 1800", "should not have year of birth < 1800"),
        (20, 101, "< 0", "should not have age < 0"),
        (21, 101, "> 150", "should not have age > 150"),
    ):
        out[rule] = with_results(
            _row(rule, (number,), "ERROR", "-", f"'; {words}, (n=' || sum(count_value) || ')'", "sum(count_value)",
                 f"res WHERE CAST(stratum_1 AS integer) {test} GROUP BY analysis_id"), (number,))

    def pairs(month: str, same: str) -> str:
        a, b = f"CAST(a.{month} AS integer)", f"CAST(b.{month} AS integer)"
        return (
            f"(SELECT a.analysis_id, a.stratum_1 FROM res a JOIN res b ON a.analysis_id = b.analysis_id{same} "
            f"WHERE ({a} + 1 = {b} OR {a} + 89 = {b}) AND a.count_value > 10 "
            "AND abs(b.count_value - a.count_value) > a.count_value) p GROUP BY analysis_id"
        )

    out[22] = with_results(
        _row(22, BY_MONTH, "WARNING", "-", "'; theres a 100% change in monthly count of events'", "NULL",
             pairs("stratum_1", "")), BY_MONTH)
    out[23] = with_results(
        _row(23, BY_CONCEPT_AND_MONTH, "WARNING", "-",
             "'; ' || count(DISTINCT stratum_1) || ' concepts have a 100% change in monthly count of events'",
             "count(DISTINCT stratum_1)", pairs("stratum_2", " AND a.stratum_1 = b.stratum_1")),
        BY_CONCEPT_AND_MONTH)
    return out
