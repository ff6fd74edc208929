"""Check queries for the report tables."""

from __future__ import annotations

from popscan_checks.base import rounded
from popscan_checks.rules import rule_sql
from popscan_checks.stored import with_results

BOX = "min_value, p10_value, p25_value, median_value, p75_value, p90_value, max_value"
TOTAL = "(SELECT count_value FROM res WHERE analysis_id = 1)"
DECILE = (
    "CAST(CAST({0} AS integer) * 10 AS varchar) || '-' || CAST((CAST({0} AS integer) + 1) * 10 - 1 AS varchar)"
)


def _share(n: str, d: str, digits: int | None = 5, scale: int = 1) -> str:
    x = f"CAST({n} AS double) / CAST({d} AS double)"
    if scale != 1:
        x = f"{float(scale)} * ({x})"
    return x if digits is None else rounded(f"({x})", digits)


def _concept(alias: str, stratum: str) -> str:
    return f"JOIN concept {alias} ON {stratum} = CAST({alias}.concept_id AS varchar)"


def _box(number: int, head: str = "concept_id", category: str | None = None, one: bool = False) -> str:
    joins, cols = "", []
    if not one:
        joins += f" {_concept('c1', 'd.stratum_1')}"
        cols.append(f"c1.concept_id AS {head}")
    if category is None:
        joins += f" {_concept('c2', 'd.stratum_1' if one else 'd.stratum_2')}"
        cols.append("c2.concept_name AS category")
    else:
        cols.append(f"{category} AS category")
    return with_results(f"SELECT {', '.join(cols)}, {BOX} FROM dst d{joins}", dists=(number,))


def _label(number: int, where: str = "") -> str:
    return with_results(
        f"SELECT c.concept_id, c.concept_name, r.count_value FROM res r {_concept('c', 'r.stratum_1')}{where}", (number,)
    )


def _two(number: int, first: str, name: bool = True, joiner: str | None = None) -> str:
    second = "c2.concept_name" if joiner is None else f"c2.concept_name || '{joiner}' || r.stratum_3"
    named = f"c1.concept_name AS {first}_concept_name, " if name else ""
    return with_results(
        f"SELECT c1.concept_id AS {first}_concept_id, {named}c2.concept_id AS concept_id, {second} AS concept_name, "
        f"r.count_value FROM res r {_concept('c1', 'r.stratum_1')} {_concept('c2', 'r.stratum_2')}", (number,),
    )


def _by_year(number: int, name: bool = True, concept: bool = True) -> str:
    k = 1 if concept else 0
    y, g, d = (f"n.stratum_{i + k}" for i in (1, 2, 3))
    head = ("c1.concept_id AS concept_id, " + ("c1.concept_name AS concept_name, " if name else "")) if concept else ""
    joins = _concept("c2", g) + (f" {_concept('c1', 'n.stratum_1')}" if concept else "")
    return with_results(
        f"SELECT {head}{DECILE.format(d)} AS trellis_name, c2.concept_name AS series_name, {y} AS x_calendar_year, "
        f"{_share('n.count_value', 'o.count_value', 5, 1000)} AS y_prevalence_1000pp "
        f"FROM (SELECT * FROM res WHERE analysis_id = {number}) n JOIN (SELECT * FROM res WHERE analysis_id = 116) o "
        f"ON {y} = o.stratum_1 AND {g} = o.stratum_2 AND {d} = o.stratum_3 {joins} WHERE {g} IN ('8507', '8532')",
        (number, 116),
    )


def _by_month(number: int, name: bool = True, concept: bool = True, digits: int | None = 5) -> str:
    m = "n.stratum_2" if concept else "n.stratum_1"
    head = ("c1.concept_id AS concept_id, " + ("c1.concept_name AS concept_name, " if name else "")) if concept else ""
    joins = _concept("c1", "n.stratum_1") if concept else ""
    return with_results(
        f"SELECT {head}{m} AS x_calendar_month, {_share('n.count_value', 'o.count_value', digits, 1000)} "
        f"AS y_prevalence_1000pp FROM (SELECT * FROM res WHERE analysis_id = {number}) n "
        f"JOIN (SELECT * FROM res WHERE analysis_id = 117) o ON {m} = o.stratum_1 {joins}", (number, 117),
    )


def _histogram(number: int, index: str = "interval_index", shift: bool = False) -> str:
    low = f" - (SELECT min(CAST(stratum_1 AS integer)) FROM res WHERE analysis_id = {number})" if shift else ""
    return with_results(
        f"SELECT CAST(stratum_1 AS integer){low} AS {index}, count_value, {_share('count_value', TOTAL)} AS percent_value "
        f"FROM res WHERE analysis_id = {number}", (number, 1),
    )


def _stats(number: int, size: int) -> str:
    return with_results(
        f"SELECT min(CAST(stratum_1 AS integer)) * {size} AS min_value, max(CAST(stratum_1 AS integer)) * {size} "
        f"AS max_value, {size} AS interval_size FROM res", (number,),
    )


def _tree(base: int, tree: str, digits: int | None, era: bool = False) -> str:
    if era:
        second = "(SELECT stratum_1, avg_value AS x FROM dst) b"
        last = rounded("b.x", 5) + " AS length_of_era"  # compared to five digits on both sides
    else:
        second = f"(SELECT stratum_1, count_value AS x FROM res WHERE analysis_id = {base + 1}) b"
        last = f"{_share('b.x', 'a.count_value', digits)} AS records_per_person"
    return with_results(
        f"SELECT h.concept_id, h.concept_path, a.count_value AS num_persons, "
        f"{_share('a.count_value', TOTAL, digits)} AS percent_persons, {last} "
        f"FROM (SELECT * FROM res WHERE analysis_id = {base}) a JOIN {second} ON a.stratum_1 = b.stratum_1 "
        f"JOIN ({tree}) h ON a.stratum_1 = CAST(h.concept_id AS varchar)",
        (base, 1) if era else (base, base + 1, 1), (base + 7,) if era else (),
    )


def _top(child: str, parent: str, step: str = "") -> str:
    """The largest matching ancestor, picked by ranking instead of grouping."""
    return (
        "(SELECT child, name, parent FROM (SELECT k.concept_id AS child, k.concept_name AS name, t.concept_id AS parent, "
        "row_number() OVER (PARTITION BY k.concept_id ORDER BY t.concept_id DESC) AS rn FROM concept_ancestor l "
        f"JOIN concept k ON l.descendant_concept_id = k.concept_id JOIN concept t ON l.ancestor_concept_id = t.concept_id "
        f"WHERE {child.format('k')} AND {parent.format('t')}{step}) AS x WHERE rn = 1)"
    )


def _conditions() -> str:
    medra, direct = "{}.vocabulary_id = 'MedDRA'", " AND l.min_levels_of_separation = 1"
    step = _top(medra, medra, direct)
    return (
        "SELECT s.concept_id, concat_ws('||', coalesce(o.concept_name, 'NA'), coalesce(g.name, 'NA'), "
        "coalesce(h.name, 'NA'), coalesce(p.name, 'NA'), coalesce(s.concept_name, 'NA')) AS concept_path "
        "FROM (SELECT * FROM concept WHERE domain_id = 'Condition') s "
        f"LEFT JOIN {_top(chr(123) + chr(125) + '.domain_id = ' + repr('Condition'), medra, direct)} u ON s.concept_id = u.child "
        f"LEFT JOIN {step} p ON u.parent = p.child LEFT JOIN {step} h ON p.parent = h.child "
        f"LEFT JOIN {step} g ON h.parent = g.child LEFT JOIN concept o ON g.parent = o.concept_id"
    )


def _atc(start: str, key: str) -> str:
    ingredient = "{0}.domain_id = 'Drug' AND {0}.concept_class_id = 'Ingredient'"
    level = "{{0}}.vocabulary_id = 'ATC' AND {{0}}.concept_class_id = 'ATC {}'"
    a4, a2, a1 = level.format("4th"), level.format("2nd"), level.format("1st")
    return (
        f"{start} LEFT JOIN {_top(ingredient, a4)} u ON {key} = u.child LEFT JOIN {_top(a4, a2)} p ON u.parent = p.child "
        f"LEFT JOIN {_top(a2, a1)} h ON p.parent = h.child LEFT JOIN concept o ON h.parent = o.concept_id"
    )


_ATC_PATH = "coalesce(o.concept_name, 'NA'), coalesce(h.name, 'NA'), coalesce(p.name, 'NA')"


def _drugs() -> str:
    start = (
        "(SELECT d.concept_id, d.concept_name, i.concept_id AS iid, i.concept_name AS iname FROM concept d "
        "JOIN concept_ancestor l ON d.concept_id = l.descendant_concept_id AND d.domain_id = 'Drug' "
        "JOIN concept i ON l.ancestor_concept_id = i.concept_id AND i.domain_id = 'Drug' "
        "AND i.concept_class_id = 'Ingredient') s"
    )
    path = f"concat_ws('||', {_ATC_PATH}, coalesce(s.iname, 'NA'), s.concept_name)"
    return f"SELECT s.concept_id, {path} AS concept_path FROM {_atc(start, 's.iid')}"


def _ingredients() -> str:
    start = "(SELECT * FROM concept WHERE domain_id = 'Drug' AND concept_class_id = 'Ingredient') s"
    path = f"concat_ws('||', {_ATC_PATH}, coalesce(s.concept_name, '||'))"
    return f"SELECT s.concept_id, {path} AS concept_path FROM {_atc(start, 's.concept_id')}"


def _procedures() -> str:
    def step(levels: int) -> str:
        return (
            "(SELECT c2.concept_id AS id, c2.concept_name AS name, max(a.descendant_concept_id) AS parent "
            "FROM concept_ancestor a JOIN concept_ancestor b ON a.descendant_concept_id = b.ancestor_concept_id "
            "JOIN concept c2 ON b.descendant_concept_id = c2.concept_id "
            f"WHERE a.ancestor_concept_id = 4040390 AND a.min_levels_of_separation = {levels} "
            "AND b.min_levels_of_separation = 1 GROUP BY c2.concept_id, c2.concept_name)"
        )

    return (
        "SELECT c.concept_id, concat_ws('||', coalesce(l1.concept_name, 'NA'), coalesce(l2.name, 'NA'), "
        "coalesce(l3.name, 'NA'), v.vocabulary_name || ' ' || c.concept_code || ': ' || c.concept_name) AS concept_path "
        "FROM concept c JOIN vocabulary v ON c.vocabulary_id = v.vocabulary_id AND c.domain_id = 'Procedure' "
        "LEFT JOIN (SELECT a.descendant_concept_id AS d, max(a.ancestor_concept_id) AS t FROM concept_ancestor a "
        f"JOIN {step(2)} t3 ON a.ancestor_concept_id = t3.id GROUP BY a.descendant_concept_id) m ON c.concept_id = m.d "
        f"LEFT JOIN {step(2)} l3 ON m.t = l3.id LEFT JOIN {step(1)} l2 ON l3.parent = l2.id "
        "LEFT JOIN concept l1 ON l2.parent = l1.concept_id"
    )


def _levels(where: str) -> str:
    joins = ""
    for i in (1, 2, 3):
        key = "s.concept_id" if i == 1 else f"c{i - 1}.concept_id"
        joins += (
            f" LEFT JOIN concept_ancestor a{i} ON {key} = a{i}.descendant_concept_id AND a{i}.min_levels_of_separation = 1"
            f" LEFT JOIN concept c{i} ON a{i}.ancestor_concept_id = c{i}.concept_id"
        )
    names = ", ".join(f"coalesce(max(c{i}.concept_name), 'NA')" for i in (3, 2, 1))
    return (
        f"SELECT s.concept_id, concat_ws('||', CAST(s.concept_id AS varchar), {names}, coalesce(s.concept_name, 'NA')) "
        f"AS concept_path FROM (SELECT * FROM concept{where}) s{joins} GROUP BY s.concept_id, s.concept_name"
    )


_SERIES = {
    220: "Visit occurrence", 420: "Condition occurrence", 502: "Death", 620: "Procedure occurrence",
    720: "Drug exposure", 820: "Observation", 920: "Drug era", 1020: "Condition era",
    111: "Observation period",
}
_SERIES_NAME = "CASE r.analysis_id " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in _SERIES.items()) + " END"
_CONCEPTS = {
    403: "Condition occurrence", 603: "Procedure occurrence", 703: "Drug exposure", 803: "Observation",
    903: "Drug era", 1003: "Condition era",
}


def _conditions_by_type() -> str:
    claim = "(concept_name LIKE 'Inpatient%' OR concept_name LIKE 'Outpatient%')"
    first = "(concept_name LIKE '%primary%' OR concept_name LIKE '%1st position%')"
    types = (
        "SELECT concept_id AS t, CASE WHEN concept_name LIKE 'Inpatient%' THEN '10' WHEN concept_name LIKE 'Outpatient%' "
        f"THEN '20' ELSE CAST(concept_id AS varchar) END || CASE WHEN {claim} AND {first} THEN '1' WHEN {claim} THEN '2' "
        "ELSE '0' END AS gid, CASE WHEN concept_name LIKE 'Inpatient%' THEN 'Claim- Inpatient: ' WHEN concept_name LIKE "
        f"'Outpatient%' THEN 'Claim- Outpatient: ' ELSE concept_name END || ' ' || CASE WHEN {claim} AND {first} THEN "
        f"'Primary diagnosis' WHEN {claim} THEN 'Secondary diagnosis' ELSE '' END AS gname FROM concept "
        "WHERE lower(domain_id) IN ('condition', 'condition type')"
    )
    return with_results(
        "SELECT c1.concept_id AS condition_concept_id, c1.concept_name AS condition_concept_name, g.gid AS concept_id, "
        "g.gname AS concept_name, CAST(sum(r.count_value) AS bigint) AS count_value FROM res r "
        f"{_concept('c1', 'r.stratum_1')} JOIN ({types}) g ON r.stratum_2 = CAST(g.t AS varchar) "
        "GROUP BY c1.concept_id, c1.concept_name, g.gid, g.gname", (405,),
    )


def report_sql() -> dict[str, str]:
    out = {
        "condition_age_at_first_diagnosis": _box(406),
        "condition_treemap": _tree(400, _conditions(), 5),
        "condition_by_type": _conditions_by_type(),
        "condition_prevalence_by_gender_age_year": _by_year(404),
        "condition_prevalence_by_month": _by_month(402),
        "conditionera_age_at_first_diagnosis": _box(1006),
        "conditionera_treemap": _tree(1000, _conditions(), 5, era=True),
        "conditionera_length_of_era": _box(1007, category="'Length of era'"),
        "conditionera_prevalence_by_gender_age_year": _by_year(1004, name=False),
        "conditionera_prevalence_by_month": _by_month(1002, name=False),
        "datadensity_concepts_per_person": with_results(
            "SELECT DISTINCT CASE analysis_id " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in _CONCEPTS.items())
            + f" END AS category, {BOX} FROM dst", dists=tuple(_CONCEPTS)),
        "datadensity_records_per_person": with_results(
            f"SELECT {_SERIES_NAME} AS series_name, r.stratum_1 AS x_calendar_month, "
            f"{_share('r.count_value', 'r.persons')} AS y_record_count FROM (SELECT *, max(CASE WHEN analysis_id = 117 "
            "THEN count_value END) OVER (PARTITION BY stratum_1) AS persons FROM res) r "
            "WHERE analysis_id <> 117 AND persons IS NOT NULL", (*_SERIES, 117)),
        "datadensity_total_records": with_results(
            f"SELECT {_SERIES_NAME} AS series_name, r.stratum_1 AS x_calendar_month, r.count_value AS y_record_count "
            "FROM res r", tuple(_SERIES)),
        "death_age_at_death": _box(506, one=True),
        "death_by_type": _label(505),
        "death_prevalence_by_gender_age_year": _by_year(504, concept=False),
        "death_prevalence_by_month": _by_month(502, concept=False, digits=None),
        "drug_age_at_first_exposure": _box(706, "drug_concept_id"),
        "drug_days_supply_distribution": _box(715, "drug_concept_id", "'Days supply'"),
        "drug_treemap": _tree(700, _drugs(), 5),
        "drug_by_type": _two(705, "drug", name=False),
        "drug_prevalence_by_gender_age_year": _by_year(704),
        "drug_prevalence_by_month": _by_month(702),
        "drug_quantity_distribution": _box(717, "drug_concept_id", "'Quantity'"),
        "drug_refills_distribution": _box(716, "drug_concept_id", "'Refills'"),
        "drugera_age_at_first_exposure": _box(906),
        "drugera_treemap": _tree(900, _ingredients(), None, era=True),
        "drugera_length_of_era": _box(907, category="'Length of era'"),
        "drugera_prevalence_by_gender_age_year": _by_year(904, name=False),
        "drugera_prevalence_by_month": _by_month(902, name=False),
        "measurement_age_at_first_occurrence": _box(1806),
        "measurement_lower_limit_distribution": _box(1816),
        "measurement_treemap": _tree(1800, _levels(""), None),
        "measurement_value_distribution": _box(1815),
        "measurement_by_type": _two(1805, "measurement"),
        "measurement_prevalence_by_gender_age_year": _by_year(1804),
        "measurement_prevalence_by_month": _by_month(1802),
        "measurement_records_by_unit": _two(1807, "measurement"),
        "measurement_upper_limit_distribution": _box(1817),
        "measurement_values_relative_to_norm": _two(1818, "measurement", joiner=":"),
        "observation_age_at_first_occurrence": _box(806),
        "observation_treemap": _tree(800, _levels(" WHERE domain_id = 'Observation'"), None),
        "observation_by_type": _two(805, "observation"),
        "observation_prevalence_by_gender_age_year": _by_year(804),
        "observation_prevalence_by_month": _by_month(802),
        "observation_lower_limit_distribution": _box(816),
        "observation_value_distribution": _box(815),
        "observation_records_by_unit": _two(807, "observation"),
        "observation_upper_limit_distribution": _box(817),
        "observation_values_relative_to_norm": _two(818, "observation", joiner=": "),
        "observationperiod_age_at_first": _histogram(101),
        "observationperiod_age_by_gender": _box(104, one=True),
        "observationperiod_cumulative_duration": with_results(
            "SELECT 'Length of observation' AS series_name, CAST(a.stratum_1 AS integer) * 30 AS x_length_of_observation, "
            f"{_share('sum(b.count_value)', TOTAL)} AS y_percent_persons FROM (SELECT * FROM res WHERE analysis_id = 108) a "
            "JOIN (SELECT * FROM res WHERE analysis_id = 108) b ON CAST(a.stratum_1 AS integer) <= CAST(b.stratum_1 AS "
            "integer) GROUP BY CAST(a.stratum_1 AS integer) * 30", (108, 1)),
        "observationperiod_length_data": _histogram(108),
        "observationperiod_length_stats": _stats(108, 30),
        "observationperiod_length_by_age": _box(107, category=DECILE.format("d.stratum_1"), one=True),
        "observationperiod_length_by_gender": _box(106, one=True),
        "observationperiod_observed_by_month": _histogram(110, "month_year"),
        "observationperiod_observed_by_year_data": _histogram(109, shift=True),
        "observationperiod_observed_by_year_stats": _stats(109, 1),
        "observationperiod_periods_per_person": with_results(
            "SELECT row_number() OVER (ORDER BY stratum_1) AS concept_id, stratum_1 AS concept_name, count_value FROM res",
            (113,)),
        "person_ethnicity": _label(5),
        "person_gender": _label(2, " WHERE c.concept_id IN (8507, 8532)"),
        "person_population": with_results(
            "SELECT 'Source name' AS attribute_name, stratum_1 AS attribute_value FROM res WHERE analysis_id = 0 UNION "
            "SELECT 'Number of persons', CAST(count_value AS varchar) FROM res WHERE analysis_id = 1", (0, 1)),
        "person_race": _label(4),
        "person_year_of_birth_data": _histogram(3, shift=True),
        "person_year_of_birth_stats": _stats(3, 1),
        "procedure_age_at_first_occurrence": _box(606),
        "procedure_prevalence_by_gender_age_year": _by_year(604),
        "procedure_prevalence_by_month": _by_month(602),
        "procedure_treemap": _tree(600, _procedures(), None),
        "procedure_by_type": _two(605, "procedure"),
        "visit_age_at_first_occurrence": _box(206),
        "visit_prevalence_by_gender_age_year": _by_year(204),
        "visit_prevalence_by_month": _by_month(202, digits=None),
        "visit_duration_by_type": _box(211, category="'Length of stay'"),
        "visit_treemap": _tree(200, "SELECT concept_id, concept_name AS concept_path FROM concept", None),
    }
    heel = "\nUNION ALL\n".join(f"SELECT * FROM ({sql}) AS h{r}" for r, sql in rule_sql().items() if r not in (15, 16))
    out["heel_messages"] = (
        f"SELECT analysis_id AS attributename, heel_warning AS attributevalue FROM (\n{heel}\n) AS all_rules"
    )
    return out
