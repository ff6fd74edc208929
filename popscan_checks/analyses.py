"""One check query per analysis number."""

from __future__ import annotations

from popscan_checks.base import stable

Q = {10: "p10_value", 25: "p25_value", 50: "median_value", 75: "p75_value", 90: "p90_value"}


def _select(number: int, source: str, strata: list[str], count: str, group: bool = True, tail: str = "") -> str:
    cols = [f"CAST({s} AS varchar) AS stratum_{i}" for i, s in enumerate(strata, 1)]
    by = f" GROUP BY {', '.join(strata)}" if strata and group else ""
    head = ", ".join([f"CAST({number} AS integer) AS analysis_id", *cols, f"CAST({count} AS bigint) AS count_value"])
    return f"SELECT {head} FROM {source}{by}{tail}"


class _Mode:
    legacy = False  # version 4: the legacy quantile everywhere


def dist(number: int, raw: str, strata: int, legacy: bool = False) -> str:
    """Statistics of ``raw`` (columns s1.., v) by numbering every row."""
    legacy = legacy or _Mode.legacy
    keys = [f"s{i}" for i in range(1, strata + 1)]
    part = f"PARTITION BY {', '.join(keys)} " if keys else ""
    keep = " AND ".join(f"{k} IS NOT NULL" for k in keys) if keys and not legacy else "true"
    if legacy:
        quants = [f"max(CASE WHEN rn * 100 <= {q} * (n + 1) THEN v ELSE -9999 END)" for q in Q]
        count = "count(v)"
    else:
        quants = [f"min(CASE WHEN rn * 100 >= {q} * n THEN v ELSE top END)" for q in Q]
        count = "count(*)"
    cols = [f"CAST({k} AS varchar) AS stratum_{k[1:]}" for k in keys]
    stats = [
        f"CAST({count} AS bigint) AS count_value",
        "CAST(min(v) AS double) AS min_value",
        "CAST(max(v) AS double) AS max_value",
        stable("avg(v)") + " AS avg_value",
        stable("stddev_samp(v)") + " AS stdev_value",
        *[f"CAST({e} AS double) AS {name}" for e, name in zip(quants, Q.values())],
    ]
    by = f" GROUP BY {', '.join(keys)}" if keys else ("" if legacy else " HAVING count(*) > 0")
    return (
        f"SELECT {', '.join([f'CAST({number} AS integer) AS analysis_id', *cols, *stats])} FROM ("
        f"SELECT *, row_number() OVER ({part}ORDER BY v NULLS LAST) AS rn, count(*) OVER ({part}) AS n, "
        f"max(v) OVER ({part}) AS top FROM ("
        f"SELECT {', '.join([*keys, 'CAST(v AS double) AS v'])} FROM ({raw}) AS r0 WHERE {keep}) AS r1) AS r2{by}"
    )


def _month(c: str) -> str:
    return f"(year({c}) * 100 + month({c}))"


def _decile(year: str) -> str:
    return f"CAST(floor(({year} - p.year_of_birth) / 10.0) AS integer)"


def _anti(number: int, table: str, fk: str, parent: str, pk: str, counted: str, keep_null: bool = False) -> str:
    extra = "" if keep_null else f" AND f.{fk} IS NOT NULL"
    return _select(
        number, f"{table} f LEFT JOIN {parent} p ON f.{fk} = p.{pk} WHERE p.{pk} IS NULL{extra}", [],
        f"count(f.{counted})",
    )


def _outside(number: int, table: str, date: str) -> str:
    return _select(
        number,
        f"{table} f WHERE NOT EXISTS (SELECT 1 FROM observation_period o WHERE o.person_id = f.person_id "
        f"AND f.{date} >= o.observation_period_start_date AND f.{date} <= o.observation_period_end_date)",
        [], "count(f.person_id)",
    )


def _inverted(number: int, table: str, start: str, end: str, counted: str = "person_id") -> str:
    return _select(number, f"{table} WHERE {end} < {start}", [], f"count({counted})")


def _domain(base: int, table: str, concept: str, start: str, kind: str | None, unit: str | None) -> dict[int, str]:
    m = _month(start)
    out = {
        base: _select(base, table, [concept], "count(DISTINCT person_id)"),
        base + 1: _select(base + 1, table, [concept], "count(person_id)"),
        base + 2: _select(base + 2, table, [concept, m], "count(DISTINCT person_id)"),
        base + 3: dist(base + 3, f"SELECT count(DISTINCT {concept}) AS v FROM {table} GROUP BY person_id", 0),
        base + 4: _select(
            base + 4, f"{table} f JOIN person p ON f.person_id = p.person_id",
            [concept, f"year({start})", "p.gender_concept_id", _decile(f"year({start})")],
            "count(DISTINCT p.person_id)",
        ),
        base + 6: dist(
            base + 6,
            f"SELECT f.c AS s1, p.gender_concept_id AS s2, f.y - p.year_of_birth AS v FROM person p JOIN "
            f"(SELECT person_id, {concept} AS c, min(year({start})) AS y FROM {table} GROUP BY person_id, {concept}) f "
            "ON p.person_id = f.person_id", 2,
        ),
        base + 20: _select(base + 20, table, [m], "count(person_id)"),
    }
    if kind:
        out[base + 5] = _select(base + 5, table, [concept, kind], "count(person_id)")
    if unit:
        out[base + 7] = _select(base + 7, table, [concept, unit], "count(person_id)")
    return out


def _calendar(number: int, table: str, start: str, end: str, unit: str, mode: str, persons: bool, demo: bool) -> str:
    key = f"year({start})" if unit == "year" else _month(start)
    key_end = f"year({end})" if unit == "year" else _month(end)
    first = f"make_date(year({start}), 1, 1)" if unit == "year" else f"CAST(date_trunc('month', {start}) AS date)"
    last = f"make_date(year({start}), 12, 31)" if unit == "year" else f"last_day({start})"
    cal = f"(SELECT DISTINCT {key} AS u, {first} AS u_first, {last} AS u_last FROM {table} WHERE {start} IS NOT NULL) c"
    within = (
        f"o.{start} <= c.u_first AND o.{end} >= c.u_last"
        if mode == "contain"
        else f"{key.replace(start, 'o.' + start)} <= c.u AND {key_end.replace(end, 'o.' + end)} >= c.u"
    )
    source = f"{table} o JOIN {cal} ON {within}"
    if persons:
        source += " JOIN person p ON o.person_id = p.person_id"
    strata = ["c.u", "p.gender_concept_id", _decile("c.u")] if demo else ["c.u"]
    return _select(number, source, strata, "count(DISTINCT o.person_id)")


def _first_period(table: str, prefix: str) -> str:
    return (
        f"(SELECT person_id, {prefix}_start_date AS d0, {prefix}_end_date AS d1, row_number() OVER "
        f"(PARTITION BY person_id ORDER BY {prefix}_start_date, {prefix}_end_date, {prefix}_id) AS rn FROM {table}) f"
    )


def _periods() -> dict[int, str]:
    t, s, e = "observation_period", "observation_period_start_date", "observation_period_end_date"
    first_age = (
        f"(SELECT person_id, min({s}) AS d FROM {t} GROUP BY person_id) f JOIN person p ON p.person_id = f.person_id"
    )
    age = "year(f.d) - p.year_of_birth"
    first = f"{_first_period(t, t)} JOIN person p ON p.person_id = f.person_id WHERE f.rn = 1"
    return {
        101: _select(101, first_age, [age], "count(p.person_id)"),
        102: _select(102, first_age, ["p.gender_concept_id", age], "count(p.person_id)"),
        103: dist(103, f"SELECT {age} AS v FROM {first_age}", 0),
        104: dist(104, f"SELECT p.gender_concept_id AS s1, {age} AS v FROM {first_age}", 1),
        105: dist(105, f"SELECT date_diff('day', f.d0, f.d1) AS v FROM {_first_period(t, t)} WHERE f.rn = 1", 0),
        106: dist(106, f"SELECT p.gender_concept_id AS s1, date_diff('day', f.d0, f.d1) AS v FROM {first}", 1),
        107: dist(107, f"SELECT {_decile('year(f.d0)')} AS s1, date_diff('day', f.d0, f.d1) AS v FROM {first}", 1),
        108: _select(108, first, ["CAST(floor(date_diff('day', f.d0, f.d1) / 30.0) AS integer)"],
                     "count(DISTINCT p.person_id)"),
        109: _calendar(109, t, s, e, "year", "contain", False, False),
        110: _calendar(110, t, s, e, "month", "contain", False, False),
        111: _select(111, t, [_month(s)], "count(DISTINCT person_id)"),
        112: _select(112, t, [_month(e)], "count(DISTINCT person_id)"),
        113: _select(113, f"(SELECT person_id, count({s}) AS k FROM {t} GROUP BY person_id) g", ["k"],
                     "count(DISTINCT person_id)"),
        114: _select(114, f"{first_age} WHERE p.year_of_birth > year(f.d)", [], "count(DISTINCT p.person_id)"),
        115: _inverted(115, t, s, e),
        116: _calendar(116, t, s, e, "year", "overlap", True, True),
        117: _calendar(117, t, s, e, "month", "overlap", False, False),
        118: _anti(118, t, "person_id", "person", "person_id", "person_id", True),
    }


def _payer() -> dict[int, str]:
    t, s, e = "payer_plan_period", "payer_plan_period_start_date", "payer_plan_period_end_date"
    known = f"{t} f JOIN person p ON p.person_id = f.person_id"
    first = f"{_first_period(t, t)} JOIN person p ON p.person_id = f.person_id WHERE f.rn = 1"
    first_age = (
        f"(SELECT person_id, min({s}) AS d FROM {t} GROUP BY person_id) f JOIN person p ON p.person_id = f.person_id"
    )
    return {
        1406: dist(1406, f"SELECT p.gender_concept_id AS s1, date_diff('day', f.d0, f.d1) AS v FROM {first}", 1),
        1407: dist(1407, f"SELECT {_decile('year(f.d0)')} AS s1, date_diff('day', f.d0, f.d1) AS v FROM {first}", 1),
        1408: _select(1408, first, ["CAST(floor(date_diff('day', f.d0, f.d1) / 30.0) AS integer)"],
                      "count(DISTINCT p.person_id)"),
        1409: _calendar(1409, t, s, e, "year", "overlap", True, False),
        1410: _calendar(1410, t, s, e, "month", "contain", True, False),
        1411: _select(1411, known, [f"strftime(f.{s}, '%Y-%m-01')"], "count(DISTINCT p.person_id)"),
        1412: _select(1412, known, [f"strftime(f.{e}, '%Y-%m-01')"], "count(DISTINCT p.person_id)"),
        1413: _select(
            1413,
            f"(SELECT person_id, count({s}) AS k FROM {t} GROUP BY person_id) f JOIN person p ON p.person_id = f.person_id",
            ["f.k"], "count(DISTINCT p.person_id)"),
        1414: _select(1414, f"{first_age} WHERE p.year_of_birth > year(f.d)", [], "count(DISTINCT p.person_id)"),
        1415: _inverted(1415, t, s, e),
    }


def _death() -> dict[int, str]:
    def last(number: int, table: str, date: str, legacy: bool = False) -> str:
        raw = (
            f"SELECT date_diff('day', d.death_date, f.d) AS v FROM death d JOIN (SELECT person_id, max({date}) AS d "
            f"FROM {table} GROUP BY person_id) f ON d.person_id = f.person_id"
        )
        return dist(number, raw, 0, legacy)

    return {
        500: _select(500, "death", ["cause_concept_id"], "count(DISTINCT person_id)"),
        501: _select(501, "death", ["cause_concept_id"], "count(person_id)"),
        502: _select(502, "death", [_month("death_date")], "count(DISTINCT person_id)"),
        504: _select(504, "death f JOIN person p ON f.person_id = p.person_id",
                     ["year(death_date)", "p.gender_concept_id", _decile("year(death_date)")],
                     "count(DISTINCT p.person_id)"),
        505: _select(505, "death", ["death_type_concept_id"], "count(person_id)"),
        506: dist(506, "SELECT p.gender_concept_id AS s1, f.y - p.year_of_birth AS v FROM person p JOIN (SELECT person_id, "
                  "min(year(death_date)) AS y FROM death GROUP BY person_id) f ON p.person_id = f.person_id", 1),
        509: _anti(509, "death", "person_id", "person", "person_id", "person_id", True),
        510: _outside(510, "death", "death_date"),
        511: last(511, "condition_occurrence", "condition_start_date", True),
        512: last(512, "drug_exposure", "drug_exposure_start_date"),
        513: last(513, "visit_occurrence", "visit_start_date"),
        514: last(514, "procedure_occurrence", "procedure_date"),
        515: last(515, "observation", "observation_date"),
    }


def _values() -> dict[int, str]:
    out = {
        211: dist(211, "SELECT visit_concept_id AS s1, date_diff('day', visit_start_date, visit_end_date) AS v "
                  "FROM visit_occurrence", 1),
        907: dist(907, "SELECT drug_concept_id AS s1, date_diff('day', drug_era_start_date, drug_era_end_date) AS v "
                  "FROM drug_era", 1),
        1007: dist(1007, "SELECT condition_concept_id AS s1, date_diff('day', condition_era_start_date, "
                   "condition_era_end_date) AS v FROM condition_era", 1),
    }
    for number, c in ((715, "days_supply"), (716, "refills"), (717, "quantity")):
        out[number] = dist(
            number, f"SELECT drug_concept_id AS s1, {c} AS v FROM drug_exposure WHERE {c} IS NOT NULL", 1
        )
    for base, table in ((800, "observation"), (1800, "measurement")):
        concept = f"{table}_concept_id"
        full = "unit_concept_id IS NOT NULL AND value_as_number IS NOT NULL"
        both = f"{full} AND range_low IS NOT NULL AND range_high IS NOT NULL"
        old = base == 800
        for offset, c, where in ((15, "value_as_number", full), (16, "range_low", both), (17, "range_high", both)):
            raw = f"SELECT {concept} AS s1, unit_concept_id AS s2, {c} AS v FROM {table} WHERE {where}"
            out[base + offset] = dist(base + offset, raw, 2, legacy=old and offset > 15)
        band = (
            "CASE WHEN value_as_number < range_low THEN 'Below Range Low' WHEN value_as_number <= range_high "
            "THEN 'Within Range' ELSE 'Above Range High' END"
        )
        out[base + 18] = _select(
            base + 18, f"(SELECT *, {band} AS band FROM {table} WHERE {both}) f",
            [concept, "unit_concept_id", "band"], "count(person_id)",
        )
        none = "value_as_number IS NULL AND value_as_concept_id IS NULL"
        if old:
            none += " AND value_as_string IS NULL"
        out[base + 14] = _select(base + 14, f"{table} WHERE {none}", [], "count(person_id)")
    return out


def _costs() -> dict[int, str]:
    columns = [
        "paid_copay", "paid_coinsurance", "paid_toward_deductible", "paid_by_payer",
        "paid_by_coordination_benefits", "total_out_of_pocket", "total_paid", "ingredient_cost",
        "dispensing_fee", "average_wholesale_price",
    ]
    out = {}
    for base, cost, event, key, concept, n in (
        (1500, "drug_cost", "drug_exposure", "drug_exposure_id", "drug_concept_id", 10),
        (1600, "procedure_cost", "procedure_occurrence", "procedure_occurrence_id", "procedure_concept_id", 7),
    ):
        out[base] = _anti(base, cost, key, event, key, f"{cost}_id", True)
        out[base + 1] = _anti(
            base + 1, cost, "payer_plan_period_id", "payer_plan_period", "payer_plan_period_id", f"{cost}_id"
        )
        for i, c in enumerate(columns[:n], base + 2):
            raw = (
                f"SELECT e.{concept} AS s1, c.{c} AS v FROM {cost} c JOIN {event} e ON c.{key} = e.{key} "
                f"WHERE e.{concept} <> 0 AND c.{c} IS NOT NULL"
            )
            out[i] = dist(i, raw, 1)
    for number, c in ((1609, "disease_class_concept_id"), (1610, "revenue_code_concept_id")):
        out[number] = _select(
            number, f"(SELECT * FROM procedure_cost WHERE {c} IS NOT NULL) f", [c], "count(procedure_cost_id)"
        )
    return out


def _person() -> dict[int, str]:
    def located(number: int, table: str, key: str, column: str) -> str:
        source = f"{table} f JOIN location l ON f.location_id = l.location_id"
        return _select(number, source, [column], f"count(DISTINCT f.{key})")

    def placed(number: int, table: str, counted: str) -> str:
        source = f"{table} f JOIN care_site c ON f.care_site_id = c.care_site_id"
        return _select(number, source, ["c.place_of_service_concept_id"], f"count(f.{counted})")

    return {
        0: _select(0, "person", ["'CMS'"], "count(DISTINCT person_id)", group=False),
        1: _select(1, "person", [], "count(DISTINCT person_id)"),
        2: _select(2, "person", ["gender_concept_id"], "count(DISTINCT person_id)"),
        3: _select(3, "person", ["year_of_birth"], "count(DISTINCT person_id)"),
        4: _select(4, "person", ["race_concept_id"], "count(DISTINCT person_id)"),
        5: _select(5, "person", ["ethnicity_concept_id"], "count(DISTINCT person_id)"),
        7: _anti(7, "person", "provider_id", "provider", "provider_id", "person_id"),
        8: _anti(8, "person", "location_id", "location", "location_id", "person_id"),
        9: _anti(9, "person", "care_site_id", "care_site", "care_site_id", "person_id"),
        300: _select(300, "provider", [], "count(DISTINCT provider_id)"),
        301: _select(301, "provider", ["specialty_concept_id"], "count(DISTINCT provider_id)"),
        302: _anti(302, "provider", "care_site_id", "care_site", "care_site_id", "provider_id"),
        1100: located(1100, "person", "person_id", "substr(l.zip, 1, 3)"),
        1101: located(1101, "person", "person_id", "l.state"),
        1102: located(1102, "care_site", "care_site_id", "substr(l.zip, 1, 3)"),
        1103: located(1103, "care_site", "care_site_id", "l.state"),
        1200: placed(1200, "person", "person_id"),
        1201: placed(1201, "visit_occurrence", "visit_occurrence_id"),
        1202: _select(1202, "care_site", ["place_of_service_concept_id"], "count(care_site_id)"),
        1300: _select(1300, "organization", ["place_of_service_concept_id"], "count(organization_id)",
                      tail=" HAVING place_of_service_concept_id IS NOT NULL"),
        1700: _select(1700, "cohort", ["cohort_definition_id"], "count(subject_id)"),
        1701: _inverted(1701, "cohort", "cohort_start_date", "cohort_end_date", "subject_id"),
    }


def _checks() -> dict[int, str]:
    out = {}
    for table, person, outside, start in (
        ("visit_occurrence", 207, 208, "visit_start_date"),
        ("condition_occurrence", 409, 410, "condition_start_date"),
        ("procedure_occurrence", 609, 610, "procedure_date"),
        ("drug_exposure", 709, 710, "drug_exposure_start_date"),
        ("observation", 809, 810, "observation_date"),
        ("drug_era", 908, 909, "drug_era_start_date"),
        ("condition_era", 1008, 1009, "condition_era_start_date"),
        ("measurement", 1809, 1810, "measurement_date"),
    ):
        out[person] = _anti(person, table, "person_id", "person", "person_id", "person_id", True)
        out[outside] = _outside(outside, table, start)
    for number, table, prefix in (
        (209, "visit_occurrence", "visit"), (411, "condition_occurrence", "condition"),
        (711, "drug_exposure", "drug_exposure"), (910, "drug_era", "drug_era"),
        (1010, "condition_era", "condition_era"),
    ):
        out[number] = _inverted(number, table, f"{prefix}_start_date", f"{prefix}_end_date")
    out[210] = _anti(210, "visit_occurrence", "care_site_id", "care_site", "care_site_id", "person_id")
    for base, table in (
        (412, "condition_occurrence"), (612, "procedure_occurrence"), (712, "drug_exposure"),
        (812, "observation"), (1812, "measurement"),
    ):
        out[base] = _anti(base, table, "provider_id", "provider", "provider_id", "person_id")
        out[base + 1] = _anti(
            base + 1, table, "visit_occurrence_id", "visit_occurrence", "visit_occurrence_id", "person_id"
        )
    return out


def analysis_sql(version: str = "v5") -> dict[int, str]:
    """Check query bodies by analysis number, without the table prefix."""
    _Mode.legacy = version == "v4"
    try:
        return _all()
    finally:
        _Mode.legacy = False


def _all() -> dict[int, str]:
    out: dict[int, str] = {}
    for part in (_person(), _periods(), _payer(), _death(), _values(), _costs(), _checks()):
        out.update(part)
    for row in (
        (200, "visit_occurrence", "visit_concept_id", "visit_start_date", None, None),
        (400, "condition_occurrence", "condition_concept_id", "condition_start_date", "condition_type_concept_id", None),
        (600, "procedure_occurrence", "procedure_concept_id", "procedure_date", "procedure_type_concept_id", None),
        (700, "drug_exposure", "drug_concept_id", "drug_exposure_start_date", "drug_type_concept_id", None),
        (800, "observation", "observation_concept_id", "observation_date", "observation_type_concept_id",
         "unit_concept_id"),
        (900, "drug_era", "drug_concept_id", "drug_era_start_date", None, None),
        (1000, "condition_era", "condition_concept_id", "condition_era_start_date", None, None),
        (1800, "measurement", "measurement_concept_id", "measurement_date", "measurement_type_concept_id",
         "unit_concept_id"),
    ):
        out.update(_domain(*row))
    return out
