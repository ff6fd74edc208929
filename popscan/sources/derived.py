"""A clinical data set derived from TPC-H-like tables.

Every clinical table is one SQL text over the driver's tables or over an
earlier derived table. The texts use only constructs that mean the same in
Spark and DuckDB, so the check SQL reads exactly the same clinical data:
``spark_tables`` runs them lazily on Spark, ``ctes`` renders them as
``WITH`` clauses. Defects (orphans, inverted dates, unmapped concepts, births
in the future) are woven in on purpose.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

SOURCE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# name -> SQL; {x} refers to a source table or to another derived table.
DERIVED: dict[str, str] = {}

DERIVED["person"] = """
SELECT c_custkey AS person_id,
  CASE WHEN c_custkey % 53 = 0 THEN 0 WHEN c_custkey % 59 = 0 THEN 8551
       WHEN c_custkey % 2 = 0 THEN 8507 ELSE 8532 END AS gender_concept_id,
  CAST(CASE WHEN c_custkey % 401 = 0 THEN 2090 WHEN c_custkey % 307 = 0 THEN 1780
       ELSE 1930 + (c_custkey * 7) % 75 END AS int) AS year_of_birth,
  CAST(8515 + c_nationkey % 3 AS int) AS race_concept_id,
  CAST(38003563 + c_custkey % 2 AS int) AS ethnicity_concept_id,
  CASE WHEN c_custkey % 97 = 0 THEN 999 ELSE c_nationkey END AS location_id,
  CASE WHEN c_custkey % 10 = 0 THEN NULL WHEN c_custkey % 17 = 0 THEN 9999
       ELSE c_custkey % 10 END AS provider_id,
  CASE WHEN c_custkey % 89 = 0 THEN 998 ELSE c_nationkey END AS care_site_id
FROM {customer}"""

DERIVED["observation_period"] = """
SELECT person_id * 10 + grp AS observation_period_id, person_id,
  first_day AS observation_period_start_date,
  CASE WHEN (person_id * 10 + grp) % 101 = 0 THEN first_day + CAST(-1 AS int) ELSE last_day END
    AS observation_period_end_date
FROM (
  SELECT o_custkey AS person_id, CAST(floor((year(o_orderdate) - 1995) / 4.0) AS int) AS grp,
    min(CAST(o_orderdate AS date)) AS first_day, max(CAST(o_orderdate AS date)) AS last_day
  FROM {orders}
  GROUP BY o_custkey, CAST(floor((year(o_orderdate) - 1995) / 4.0) AS int)
  UNION ALL
  SELECT CAST(900000 AS bigint) AS person_id, 0 AS grp,
    min(CAST(o_orderdate AS date)) AS first_day, max(CAST(o_orderdate AS date)) AS last_day
  FROM {orders}
) AS g"""

DERIVED["visit_occurrence"] = """
SELECT o_orderkey AS visit_occurrence_id,
  CASE WHEN o_orderkey % 499 = 0 THEN 900000 ELSE o_custkey END AS person_id,
  CASE WHEN o_orderkey % 223 = 0 THEN 0 ELSE 9200 + CAST(substr(o_orderpriority, 1, 1) AS int) END
    AS visit_concept_id,
  CAST(o_orderdate AS date) AS visit_start_date,
  CAST(o_orderdate AS date) + CAST(o_orderkey % 9 - 1 AS int) AS visit_end_date,
  o_orderkey % 30 AS care_site_id
FROM {orders}"""

DERIVED["condition_occurrence"] = """
SELECT o_orderkey AS condition_occurrence_id,
  CASE WHEN o_orderkey % 499 = 0 THEN 900000 ELSE o_custkey END AS person_id,
  CAST(CASE WHEN o_orderkey % 211 = 0 THEN 0 WHEN o_orderkey % 197 = 0 THEN 100999
       ELSE 100000 + o_orderkey % 40 END AS int) AS condition_concept_id,
  started AS condition_start_date,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE started + CAST(o_orderkey % 11 - 1 AS int) END
    AS condition_end_date,
  CAST(CASE WHEN o_orderkey % 251 = 0 THEN 44999 ELSE 44000 + o_orderkey % 3 END AS int)
    AS condition_type_concept_id,
  CASE WHEN o_orderkey % 101 = 0 THEN 9998 ELSE o_orderkey % 12 END AS provider_id,
  CASE WHEN o_orderkey % 61 = 0 THEN -1 ELSE o_orderkey END AS visit_occurrence_id
FROM (
  SELECT o_orderkey, o_custkey, CAST(o_orderdate AS date) + CAST(o_orderkey % 5 +
    CASE WHEN year(o_orderdate) = 1998 AND month(o_orderdate) = 12 AND o_orderkey % 6 <> 0 THEN 31 ELSE 0 END
    AS int) AS started
  FROM {orders}
) AS o"""

_LINE = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate", "l_returnflag", "l_linestatus")

# every order line, one to one: the driver's pairs of order and line number repeat a few times, so the rank among equal
# pairs by all other columns completes the id; rows that agree in everything may swap ranks, which changes nothing
DERIVED["order_line"] = f"""
SELECT (l.l_orderkey * 10 + l.l_linenumber) * 1009 + l.nth AS line_id, l.l_orderkey, l.l_linenumber, o.o_custkey,
  l.l_partkey AS partkey, l.l_suppkey AS suppkey, l.l_quantity AS quantity, l.l_extendedprice AS price,
  l.l_discount AS discount, l.l_tax AS tax, CAST(l.l_shipdate AS date) AS shipdate
FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber ORDER BY {", ".join(f"{c} NULLS FIRST" for c in _LINE)}) - 1 AS nth
  FROM {{lineitem}}
) AS l JOIN {{orders}} AS o ON l.l_orderkey = o.o_orderkey"""

DERIVED["drug_exposure"] = """
SELECT line_id AS drug_exposure_id,
  CASE WHEN line_id % 523 = 0 THEN 900000 ELSE o_custkey END AS person_id,
  CAST(CASE WHEN line_id % 331 = 0 THEN 0 WHEN line_id % 337 = 0 THEN 200999
       ELSE 200000 + partkey % 100 END AS int) AS drug_concept_id,
  shipdate AS drug_exposure_start_date,
  CASE WHEN line_id % 127 = 0 THEN shipdate + CAST(-2 AS int)
       ELSE shipdate + CAST(quantity * 5 - 1 AS int) END AS drug_exposure_end_date,
  CASE WHEN line_id % 29 = 0 THEN NULL ELSE quantity * 14 END AS quantity,
  CAST(quantity AS int) * 5 AS days_supply,
  CASE WHEN line_id % 31 = 0 THEN 12 ELSE l_linenumber END AS refills,
  CAST(44100 + partkey % 2 AS int) AS drug_type_concept_id,
  CASE WHEN line_id % 103 = 0 THEN 9998 ELSE suppkey % 13 END AS provider_id,
  CASE WHEN line_id % 67 = 0 THEN -1 ELSE l_orderkey END AS visit_occurrence_id
FROM {order_line}"""

DERIVED["procedure_occurrence"] = """
SELECT line_id AS procedure_occurrence_id,
  CASE WHEN line_id % 521 = 0 THEN 900000 ELSE o_custkey END AS person_id,
  CAST(CASE WHEN line_id % 331 = 0 THEN 0 WHEN line_id % 347 = 0 THEN 300999
       ELSE 300000 + partkey % 60 END AS int) AS procedure_concept_id,
  shipdate AS procedure_date,
  CAST(CASE WHEN line_id % 353 = 0 THEN 44299 ELSE 44200 + suppkey % 2 END AS int)
    AS procedure_type_concept_id,
  CASE WHEN line_id % 103 = 0 THEN 9998 ELSE suppkey % 13 END AS provider_id,
  CASE WHEN line_id % 71 = 0 THEN -1 ELSE l_orderkey END AS visit_occurrence_id
FROM {order_line}"""

_EVENT_RANK = (
    "CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3 "
    "WHEN 'signup' THEN 4 WHEN 'view' THEN 5 ELSE 6 END"
)

DERIVED["observation"] = f"""
SELECT event_id AS observation_id,
  CASE WHEN event_id % 503 = 0 THEN 900000 ELSE user_id END AS person_id,
  CAST(CASE WHEN event_id % 241 = 0 THEN 0 ELSE 400000 + {_EVENT_RANK} END AS int)
    AS observation_concept_id,
  CAST('1995-01-05' AS date) + CAST((event_id * 31) % 2390 AS int) AS observation_date,
  CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS value_as_number,
  CASE WHEN event_id % 3 = 0 THEN event_type ELSE NULL END AS value_as_string,
  CAST(NULL AS int) AS value_as_concept_id,
  CAST(CASE WHEN event_id % 17 = 0 THEN NULL ELSE 8800 + event_id % 3 END AS int) AS unit_concept_id,
  CAST(44300 + event_id % 2 AS int) AS observation_type_concept_id,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(100 AS double) END AS range_low,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(250 + event_id % 50 AS double) END AS range_high,
  CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 107 = 0 THEN 9998 ELSE event_id % 12 END
    AS provider_id,
  CASE WHEN event_id % 83 = 0 THEN -1 ELSE event_id % 150 END AS visit_occurrence_id
FROM {{events}}"""

DERIVED["measurement"] = f"""
SELECT event_id AS measurement_id,
  CASE WHEN event_id % 509 = 0 THEN 900000 ELSE user_id END AS person_id,
  CAST(500000 + {_EVENT_RANK} AS int) AS measurement_concept_id,
  CAST('1995-01-05' AS date) + CAST((event_id * 37) % 2390 AS int) AS measurement_date,
  CASE WHEN event_id % 9 = 0 THEN NULL ELSE value END AS value_as_number,
  CAST(CASE WHEN event_id % 18 = 0 THEN 45000 ELSE NULL END AS int) AS value_as_concept_id,
  CAST(CASE WHEN event_id % 19 = 0 THEN NULL ELSE 8800 + event_id % 3 END AS int) AS unit_concept_id,
  CAST(44500 + event_id % 2 AS int) AS measurement_type_concept_id,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(100 + event_id % 7 AS double) END AS range_low,
  CASE WHEN event_id % 13 = 0 THEN NULL ELSE CAST(300 + event_id % 40 AS double) END AS range_high,
  CASE WHEN event_id % 109 = 0 THEN 9998 ELSE event_id % 12 END AS provider_id,
  CASE WHEN event_id % 79 = 0 THEN -1 ELSE event_id % 150 END AS visit_occurrence_id
FROM {{events}}"""

# eras start at the ingredient
DERIVED["drug_era"] = """
SELECT person_id * 1000000 + (yr - 1990) * 10000 + drug_concept_id % 10000 AS drug_era_id,
  person_id, drug_concept_id, first_day AS drug_era_start_date,
  CASE WHEN (person_id + drug_concept_id + yr) % 103 = 0 THEN first_day + CAST(-1 AS int)
       ELSE last_day END AS drug_era_end_date,
  n AS drug_exposure_count
FROM (
  SELECT person_id,
    CASE WHEN drug_concept_id = 0 THEN 0 ELSE 210000 + drug_concept_id % 25 END AS drug_concept_id,
    year(drug_exposure_start_date) AS yr,
    min(drug_exposure_start_date) AS first_day, max(drug_exposure_start_date) AS last_day,
    count(*) AS n
  FROM {drug_exposure}
  GROUP BY person_id,
    CASE WHEN drug_concept_id = 0 THEN 0 ELSE 210000 + drug_concept_id % 25 END,
    year(drug_exposure_start_date)
) AS g"""

DERIVED["condition_era"] = """
SELECT person_id * 1000000 + (yr - 1990) * 10000 + condition_concept_id % 10000 AS condition_era_id,
  person_id, condition_concept_id, first_day AS condition_era_start_date,
  CASE WHEN (person_id + condition_concept_id + yr) % 103 = 0 THEN first_day + CAST(-1 AS int)
       ELSE last_day END AS condition_era_end_date,
  n AS condition_occurrence_count
FROM (
  SELECT person_id, condition_concept_id, year(condition_start_date) AS yr,
    min(condition_start_date) AS first_day, max(condition_start_date) AS last_day, count(*) AS n
  FROM {condition_occurrence}
  GROUP BY person_id, condition_concept_id, year(condition_start_date)
) AS g"""

DERIVED["death"] = """
SELECT c_custkey AS person_id,
  CAST('1999-01-01' AS date) + CAST((c_custkey * 3) % 900 AS int) AS death_date,
  CAST(44400 + c_custkey % 2 AS int) AS death_type_concept_id,
  CAST(CASE WHEN c_custkey % 7 = 0 THEN 0 ELSE 100000 + c_custkey % 5 END AS int) AS cause_concept_id
FROM {customer}
WHERE c_custkey % 13 = 0
UNION ALL
SELECT CAST(900001 AS bigint) AS person_id, max(CAST(o_orderdate AS date)) AS death_date,
  44400 AS death_type_concept_id, 100001 AS cause_concept_id
FROM {orders}"""

DERIVED["provider"] = """
SELECT s_suppkey AS provider_id,
  CAST(CASE WHEN s_suppkey % 9 = 0 THEN 0 ELSE 38004446 + s_suppkey % 4 END AS int)
    AS specialty_concept_id,
  CASE WHEN s_suppkey % 11 = 0 THEN 997 ELSE s_nationkey END AS care_site_id
FROM {supplier}"""

DERIVED["location"] = """
SELECT CAST(n_nationkey AS bigint) AS location_id, n_name AS state,
  lpad(CAST(10000 + n_nationkey * 391 AS string), 5, '0') AS zip
FROM {nation}"""

DERIVED["care_site"] = """
SELECT CAST(n_nationkey AS bigint) AS care_site_id, CAST(n_nationkey AS bigint) AS location_id,
  CAST(8700 + n_regionkey AS int) AS place_of_service_concept_id
FROM {nation}"""

# version 4 only
DERIVED["organization"] = """
SELECT s_suppkey AS organization_id,
  CAST(CASE WHEN s_suppkey % 8 = 0 THEN NULL ELSE 8700 + s_nationkey % 5 END AS int)
    AS place_of_service_concept_id
FROM {supplier}"""

DERIVED["payer_plan_period"] = """
SELECT person_id * 10 + rank_no AS payer_plan_period_id, person_id,
  first_day AS payer_plan_period_start_date,
  CASE WHEN (person_id * 10 + rank_no) % 107 = 0 THEN first_day + CAST(-3 AS int) ELSE last_day END
    AS payer_plan_period_end_date
FROM (
  SELECT CASE WHEN o_custkey % 113 = 0 THEN 900002 ELSE o_custkey END AS person_id,
    CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS rank_no,
    min(CAST(o_orderdate AS date)) AS first_day, max(CAST(o_orderdate AS date)) AS last_day
  FROM {orders}
  GROUP BY CASE WHEN o_custkey % 113 = 0 THEN 900002 ELSE o_custkey END,
    CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END
) AS g"""

# floor, not round: the same in every engine
_COSTS = """
  CASE WHEN line_id % 37 = 0 THEN NULL WHEN line_id % 211 = 0 THEN CAST(-1 AS double)
       ELSE floor(price * discount * 100) / 100 END AS paid_copay,
  floor(price * tax * 100) / 100 AS paid_coinsurance,
  floor(price * 0.02 * 100) / 100 AS paid_toward_deductible,
  floor(price * 0.8 * 100) / 100 AS paid_by_payer,
  CASE WHEN line_id % 41 = 0 THEN NULL ELSE floor(price * 0.01 * 100) / 100 END
    AS paid_by_coordination_benefits,
  floor(price * (discount + tax) * 100) / 100 AS total_out_of_pocket,
  price AS total_paid"""

DERIVED["drug_cost"] = f"""
SELECT line_id AS drug_cost_id,
  CASE WHEN line_id % 53 = 0 THEN -1 ELSE line_id END AS drug_exposure_id,{_COSTS},
  floor(price * 0.6 * 100) / 100 AS ingredient_cost,
  CAST(partkey % 7 AS double) AS dispensing_fee,
  floor(price * 1.1 * 100) / 100 AS average_wholesale_price,
  CASE WHEN line_id % 3 = 0 THEN NULL ELSE o_custkey * 10 + 1 END AS payer_plan_period_id
FROM {{order_line}}"""

DERIVED["procedure_cost"] = f"""
SELECT line_id AS procedure_cost_id,
  CASE WHEN line_id % 53 = 0 THEN -1 ELSE line_id END AS procedure_occurrence_id,{_COSTS},
  CAST(CASE WHEN line_id % 10 = 0 THEN NULL WHEN line_id % 223 = 0 THEN 0
       ELSE 38003000 + partkey % 4 END AS int) AS revenue_code_concept_id,
  CAST(CASE WHEN line_id % 6 = 0 THEN NULL ELSE 38001000 + partkey % 5 END AS int)
    AS disease_class_concept_id,
  CASE WHEN line_id % 3 = 0 THEN NULL ELSE o_custkey * 10 + 2 END AS payer_plan_period_id
FROM {{order_line}}"""

DERIVED["cohort"] = """
SELECT CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3
         WHEN 'HOUSEHOLD' THEN 4 ELSE 5 END AS cohort_definition_id,
  o_custkey AS subject_id, CAST(o_orderdate AS date) AS cohort_start_date,
  CAST(o_orderdate AS date) + CAST(o_orderkey % 30 - 1 AS int) AS cohort_end_date
FROM {orders} JOIN {customer} ON o_custkey = c_custkey"""

# (source, id, domain, vocabulary, class, name); each entry reads the whole source
_CONCEPTS: list[tuple[str, str, str, str, str, str]] = [
    ("nation", "CASE n_nationkey % 3 WHEN 0 THEN 8507 WHEN 1 THEN 8532 ELSE 8551 END",
     "CASE WHEN n_nationkey % 3 = 2 THEN 'Observation' ELSE 'Gender' END", "'Gender'", "'Gender'", "CASE n_nationkey % 3 WHEN 0 THEN 'MALE' WHEN 1 THEN 'FEMALE' ELSE 'UNKNOWN' END"),
    ("nation", "n_nationkey * 0", "'Metadata'", "'None'", "'Undefined'", "'No matching concept'"),
    ("nation", "8515 + n_nationkey % 3",
     "CASE WHEN n_nationkey % 3 = 2 THEN 'Observation' ELSE 'Race' END", "'Race'", "'Race'", ""),
    ("nation", "38003563 + n_nationkey % 2",
     "CASE WHEN n_nationkey % 2 = 1 THEN 'Race' ELSE 'Ethnicity' END", "'Ethnicity'", "'Ethnicity'", ""),
    ("nation", "9201 + n_nationkey % 5",
     "CASE WHEN n_nationkey % 5 = 4 THEN 'Place of Service' ELSE 'Visit' END", "'Visit'", "'Visit'", ""),
    ("nation", "8700 + n_nationkey % 5", "'Place of Service'", "'CMS Place of Service'", "'Visit'", ""),
    ("nation", "8800 + n_nationkey % 3", "'Unit'", "'UCUM'", "'Unit'", ""),
    ("nation", "38004446 + n_nationkey % 4",
     "CASE WHEN n_nationkey % 4 = 3 THEN 'Observation' ELSE 'Provider Specialty' END", "'Specialty'",
     "'Specialty'", ""),
    ("nation", "38003000 + n_nationkey % 4",
     "CASE WHEN n_nationkey % 4 = 1 THEN 'Observation' ELSE 'Revenue Code' END", "'Revenue Code'",
     "'Revenue Code'", ""),
    ("nation", "38001000 + n_nationkey % 4", "'Observation'",
     "CASE WHEN n_nationkey % 4 = 1 THEN 'SNOMED' ELSE 'DRG' END", "'DRG'", ""),
    ("nation", "44000 + n_nationkey % 3", "'Condition'", "'Condition Type'", "'Condition Type'",
     "CASE n_nationkey % 3 WHEN 0 THEN 'Inpatient detail - primary' "
     "WHEN 1 THEN 'Outpatient header - 1st position' ELSE 'Inpatient header - 2nd position' END"),
    ("nation", "44100 + n_nationkey % 2", "'Drug'", "'Drug Type'", "'Drug Type'", ""),
    ("nation", "44200 + n_nationkey % 2", "'Procedure'", "'Procedure Type'", "'Procedure Type'", ""),
    ("nation", "44300 + n_nationkey % 2", "'Type Concept'", "'Observation Type'", "'Observation Type'", ""),
    ("nation", "44400 + n_nationkey % 2", "'Type Concept'", "'Death Type'", "'Death Type'", ""),
    ("nation", "44500 + n_nationkey % 2", "'Type Concept'", "'Meas Type'", "'Meas Type'", ""),
    ("part", "100000 + p_partkey % 40",
     "CASE WHEN p_partkey % 40 = 37 THEN 'Observation' ELSE 'Condition' END", "'SNOMED'", "'Clinical Finding'", ""),
    ("part", "610000 + p_partkey % 20", "'Observation'", "'MedDRA'", "'PT'", ""),
    ("part", "620000 + p_partkey % 10", "'Observation'", "'MedDRA'", "'HLT'", ""),
    ("part", "630000 + p_partkey % 5", "'Observation'", "'MedDRA'", "'HLGT'", ""),
    ("part", "640000 + p_partkey % 2", "'Observation'", "'MedDRA'", "'SOC'", ""),
    ("part", "200000 + p_partkey % 100",
     "CASE WHEN p_partkey % 100 = 77 THEN 'Device' ELSE 'Drug' END", "'RxNorm'", "'Clinical Drug'", ""),
    ("part", "210000 + p_partkey % 25", "'Drug'", "'RxNorm'", "'Ingredient'", ""),
    ("part", "220000 + p_partkey % 10", "'Drug'", "'ATC'", "'ATC 4th'", ""),
    ("part", "230000 + p_partkey % 5", "'Drug'", "'ATC'", "'ATC 2nd'", ""),
    ("part", "240000 + p_partkey % 2", "'Drug'", "'ATC'", "'ATC 1st'", ""),
    ("part", "300000 + p_partkey % 60",
     "CASE WHEN p_partkey % 60 = 41 THEN 'Device' ELSE 'Procedure' END",
     "CASE WHEN p_partkey % 2 = 0 THEN 'CPT4' ELSE 'HCPCS' END", "'Procedure'", ""),
    ("nation", "4040390 + n_nationkey * 0", "'Procedure'", "'SNOMED'", "'Procedure'", ""),
    ("part", "340000 + p_partkey % 3", "'Procedure'", "'SNOMED'", "'Procedure'", ""),
    ("part", "341000 + p_partkey % 6", "'Procedure'", "'SNOMED'", "'Procedure'", ""),
    ("part", "342000 + p_partkey % 12", "'Procedure'", "'SNOMED'", "'Procedure'", ""),
    ("part", "400001 + p_partkey % 6", "'Observation'",
     "CASE WHEN p_partkey % 6 = 1 THEN 'SNOMED' ELSE 'LOINC' END", "'Observation'", ""),
    ("part", "500001 + p_partkey % 6", "'Measurement'", "'LOINC'", "'Lab Test'", ""),
    ("part", "410000 + p_partkey % 3", "'Observation'", "'LOINC'", "'Hierarchy'", ""),
    ("part", "411000 + p_partkey % 2", "'Observation'", "'LOINC'", "'Hierarchy'", ""),
    ("part", "412000 + p_partkey * 0", "'Observation'", "'LOINC'", "'Hierarchy'", ""),
]


def _concept_branch(source: str, cid: str, domain: str, vocabulary: str, klass: str, name: str) -> str:
    name = name or f"concat('concept_', CAST({cid} AS string))"
    return (
        f"SELECT CAST({cid} AS int) AS concept_id, {name} AS concept_name, {domain} AS domain_id, "
        f"{vocabulary} AS vocabulary_id, {klass} AS concept_class_id, "
        f"concat('C', CAST({cid} AS string)) AS concept_code FROM {{{source}}}"
    )


DERIVED["concept"] = (
    "SELECT DISTINCT concept_id, concept_name, domain_id, vocabulary_id, concept_class_id, concept_code FROM (\n"
    + "\nUNION ALL\n".join(_concept_branch(*row) for row in _CONCEPTS)
    + "\n) AS c"
)

DERIVED["vocabulary"] = """
SELECT DISTINCT vocabulary_id, concat(vocabulary_id, ' vocabulary') AS vocabulary_name
FROM {concept}"""

# (ancestor, descendant, levels); every chain is closed, some concepts have two parents
_ANCESTORS: list[tuple[str, str, int]] = [
    ("610000 + p_partkey % 20", "100000 + p_partkey % 40", 1),
    ("620000 + p_partkey % 10", "100000 + p_partkey % 40", 2),
    ("630000 + p_partkey % 5", "100000 + p_partkey % 40", 3),
    ("610000 + CASE WHEN p_partkey % 8 = 0 THEN (p_partkey % 40 + 7) % 20 ELSE p_partkey % 20 END",
     "100000 + p_partkey % 40", 1),
    ("620000 + p_partkey % 10", "610000 + p_partkey % 20", 1),
    ("630000 + p_partkey % 5", "610000 + p_partkey % 20", 2),
    ("630000 + p_partkey % 5", "620000 + p_partkey % 10", 1),
    ("640000 + p_partkey % 2", "630000 + p_partkey % 5", 1),
    ("210000 + p_partkey % 25", "200000 + p_partkey % 100", 1),
    ("210000 + CASE WHEN p_partkey % 10 = 0 THEN (p_partkey % 100 + 3) % 25 ELSE p_partkey % 25 END",
     "200000 + p_partkey % 100", 1),
    ("210000 + p_partkey % 25", "210000 + p_partkey % 25", 0),
    ("220000 + p_partkey % 5", "210000 + p_partkey % 25", 1),
    ("230000 + p_partkey % 5", "220000 + p_partkey % 10", 1),
    ("240000 + p_partkey % 2", "230000 + p_partkey % 5", 1),
    ("342000 + p_partkey % 12", "300000 + p_partkey % 60", 1),
    ("342000 + CASE WHEN p_partkey % 9 = 0 THEN (p_partkey % 60 + 5) % 12 ELSE p_partkey % 12 END",
     "300000 + p_partkey % 60", 1),
    ("4040390 + p_partkey * 0", "340000 + p_partkey % 3", 1),
    ("4040390 + p_partkey * 0", "341000 + p_partkey % 6", 2),
    ("4040390 + p_partkey * 0", "342000 + p_partkey % 12", 3),
    ("340000 + p_partkey % 3", "341000 + p_partkey % 6", 1),
    ("341000 + p_partkey % 6", "342000 + p_partkey % 12", 1),
    ("410000 + p_partkey % 3", "400001 + p_partkey % 6", 1),
    ("410000 + p_partkey % 3", "500001 + p_partkey % 6", 1),
    ("411000 + p_partkey % 2", "410000 + p_partkey % 3", 1),
    ("412000 + p_partkey * 0", "411000 + p_partkey % 2", 1),
]

DERIVED["concept_ancestor"] = (
    "SELECT DISTINCT ancestor_concept_id, descendant_concept_id, min_levels_of_separation FROM (\n"
    + "\nUNION ALL\n".join(
        f"SELECT CAST({a} AS int) AS ancestor_concept_id, CAST({d} AS int) AS descendant_concept_id, "
        f"{n} AS min_levels_of_separation FROM {{part}}"
        for a, d, n in _ANCESTORS
    )
    + "\n) AS c"
)


# On Spark the two vocabulary tables are one pass over each source: every source
# row yields all its concepts at once instead of one UNION branch per entry.
_CONCEPT_COLUMNS = (
    "concept_id", "concept_name", "domain_id", "vocabulary_id", "concept_class_id", "concept_code",
)


def _one_pass(rows: list[tuple[str, list[str]]], columns: tuple[str, ...]) -> str:
    by_source: dict[str, list[str]] = {}
    for source, values in rows:
        fields = ", ".join(f"'{c}', {x}" for c, x in zip(columns, values))
        by_source.setdefault(source, []).append(f"named_struct({fields})")
    parts = [f"SELECT explode(array({', '.join(v)})) AS r FROM {{{s}}}" for s, v in by_source.items()]
    return f"SELECT DISTINCT {', '.join('r.' + c for c in columns)} FROM (\n" + "\nUNION ALL\n".join(parts) + "\n) AS c"


# lines are dealt out once, by order: the rank among equal pairs and the join both find their rows there (lines without an
# order have no partner); wide rows are sorted, hence more and smaller tasks than other exchanges have
_LINE_TASKS = 4  # for each shuffle partition
_ORDER_LINE = DERIVED["order_line"].replace(
    "FROM {lineitem}",
    "FROM (SELECT /*+ REPARTITION({line_tasks}, l_orderkey) */ * FROM {lineitem} WHERE l_orderkey IS NOT NULL) AS dealt",
)

# few exposures share an era, so adding them up ahead of the exchange would hold nearly every row twice; they are dealt out
# as they are, over as many tasks as the lines, since these tasks also begin what is counted over eras
_ERA_KEYS = "person_id, drug_concept_id, yr"
_DRUG_ERA = f"""{DERIVED["drug_era"][: DERIVED["drug_era"].index("FROM (")]}FROM (
  SELECT {_ERA_KEYS}, min(day) AS first_day, max(day) AS last_day, count(*) AS n
  FROM (
    SELECT /*+ REPARTITION({{line_tasks}}, {_ERA_KEYS}) */ * FROM (
      SELECT person_id, CASE WHEN drug_concept_id = 0 THEN 0 ELSE 210000 + drug_concept_id % 25 END AS drug_concept_id,
        year(drug_exposure_start_date) AS yr, drug_exposure_start_date AS day
      FROM {{drug_exposure}}
    ) AS e
  ) AS dealt
  GROUP BY {_ERA_KEYS}
) AS g"""

SPARK_FORMS: dict[str, str] = {
    "order_line": _ORDER_LINE,
    "drug_era": _DRUG_ERA,
    "concept": _one_pass(
        [
            (
                source,
                [
                    f"CAST({cid} AS int)", name or f"concat('concept_', CAST({cid} AS string))", domain, vocabulary,
                    klass, f"concat('C', CAST({cid} AS string))",
                ],
            )
            for source, cid, domain, vocabulary, klass, name in _CONCEPTS
        ],
        _CONCEPT_COLUMNS,
    ),
    "concept_ancestor": _one_pass(
        [("part", [f"CAST({a} AS int)", f"CAST({d} AS int)", str(n)]) for a, d, n in _ANCESTORS],
        ("ancestor_concept_id", "descendant_concept_id", "min_levels_of_separation"),
    ),
}


def references(sql: str) -> list[str]:
    """Names a derived text refers to, in order of first use."""
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


class DerivedTables:
    """Lazy mapping from clinical table name to DataFrame over one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark = spark
        self._folder = folder
        self._frames: dict[str, DataFrame] = {}

    def __contains__(self, name: str) -> bool:
        return name in DERIVED

    def __iter__(self):
        return iter(DERIVED)

    def keys(self):
        return DERIVED.keys()

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in SOURCE_TABLES:
                self._frames[name] = self._spark.read.parquet(f"{self._folder}/{name}.parquet")
            else:
                self._frames[name] = self._derive(name)
        return self._frames[name]

    def _derive(self, name: str) -> DataFrame:
        sql = SPARK_FORMS.get(name, DERIVED[name])
        tasks = _LINE_TASKS * int(self._spark.conf.get("spark.sql.shuffle.partitions"))
        sql = sql.replace("{line_tasks}", str(tasks))
        return self._spark.sql(sql, **{r: self[r] for r in references(sql)})


#: Derived tables that take a shuffle; the others are row by row projections of these or of source tables.
SHUFFLED = (
    "order_line", "observation_period", "drug_era", "condition_era", "payer_plan_period", "cohort", "concept", "vocabulary",
    "concept_ancestor",
)


class StoredTables(DerivedTables):
    """The same tables where those that take a shuffle are written below ``store`` when first asked for.

    Many analyses over one data set then share its order lines, eras and vocabulary instead of deriving them anew.
    """

    def __init__(self, spark: SparkSession, folder: str, store: str):
        super().__init__(spark, folder)
        self._store = store

    def _derive(self, name: str) -> DataFrame:
        df = super()._derive(name)
        if name not in SHUFFLED:
            return df
        path = f"{self._store}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)


def ctes(names: list[str]) -> list[tuple[str, str]]:
    """``(name, sql)`` of the given derived tables and all they need, in order."""
    ordered: dict[str, str] = {}

    def visit(name: str) -> None:
        if name in SOURCE_TABLES or name in ordered:
            return
        sql = DERIVED[name]
        for ref in references(sql):
            visit(ref)
        ordered[name] = sql.format(**{r: r for r in references(sql)}).strip()

    for name in names:
        visit(name)
    return list(ordered.items())
