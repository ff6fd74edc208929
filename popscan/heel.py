"""Data quality rules over the summaries.

Rules read results, distributions, the catalogue and the concept table, all
small next to the data they summarise, and yield one row per finding. Rules
are data: a number, a shape, the analyses they look at and their wording.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from popscan.catalogue import analyses
from popscan.results import ResultSet

NAME = object()  # stands for the analysis name in a message
MIN_BASE_COUNT = 10  # fixed value: months with fewer records never trigger the change rules

# Analyses per rule.
COUNTED_DEFECTS = (
    7, 8, 9, 114, 115, 118, 207, 208, 209, 210, 302, 409, 410, 411, 412, 413, 509, 510, 609, 610, 612, 613,
    709, 710, 711, 712, 713, 809, 810, 812, 813, 814, 908, 909, 910, 1008, 1009, 1010, 1415, 1500, 1501,
    1600, 1601, 1701,
)
NEVER_NEGATIVE = (
    103, 105, 206, 406, 506, 606, 706, 715, 716, 717, 806, 906, 907, 1006, 1007, *range(1502, 1512),
    *range(1602, 1609),
)
AFTER_DEATH = (511, 512, 513, 514, 515)
BY_CONCEPT = (2, 4, 5, 200, 301, 400, 500, 505, 600, 700, 800, 900, 1000, 1609, 1610)
BY_TYPE = (405, 605, 705, 805)
BY_MONTH = (420, 620, 720, 820, 920, 1020)
BY_CONCEPT_AND_MONTH = (402, 602, 702, 802, 902, 1002)


# Limits on the smallest or largest value of distributions.
# rule -> analyses, column, sign of the forbidden side, limit, severity, separator, wording
LIMITS: dict[int, tuple[tuple[int, ...], str, int, float, str, str, str]] = {
    2: (NEVER_NEGATIVE, "min_value", -1, 0, "ERROR", " - ", "min value should not be negative"),
    3: (AFTER_DEATH, "max_value", 1, 30, "WARNING", "-",
        "max value should not be positive, otherwise its a zombie with data >1mo after death "),
    24: ((715,), "max_value", 1, 180, "WARNING", "-", "max value should not be > 180"),
    25: ((716,), "max_value", 1, 10, "WARNING", "-", "max value should not be > 10"),
    26: ((717,), "max_value", 1, 600, "WARNING", "-", "max value should not be > 600"),
}

# Accepted domains (version 4 rules: vocabulary numbers).
# rule -> analyses, column, accepted values, wording appended
ACCEPTED: dict[int, tuple[tuple[int, ...], str, tuple[str, ...], str]] = {
    7: ((2,), "domain_id", ("gender",), ""),
    8: ((4,), "domain_id", ("race",), ""),
    9: ((5,), "domain_id", ("ethnicity",), " (CMS Ethnicity)"),
    10: ((202,), "domain_id", ("visit",), ""),
    11: ((301,), "domain_id", ("provider specialty",), " (Specialty)"),
    12: ((400, 1000), "domain_id",
         ("condition", "condition/drug", "condition/meas", "condition/obs", "condition/procedure"), ""),
    13: ((700, 900), "domain_id",
         ("drug", "condition/drug", "device/drug", "drug/measurement", "drug/obs", "drug/procedure"), ""),
    14: ((600,), "domain_id",
         ("procedure", "condition/procedure", "device/procedure", "drug/procedure", "obs/procedure"), ""),
    15: ((800,), "vocabulary_id", ("0", "6"), " (LOINC)"),
    16: ((1609,), "vocabulary_id", ("0", "40"), " (DRG)"),
    17: ((1610,), "domain_id", ("revenue code",), " (revenue code)"),
}

# Implausible years and ages; ``None`` stands for the current year.
# rule -> analysis, sign of the forbidden side, limit, wording
IMPLAUSIBLE: dict[int, tuple[int, int, int | None, str]] = {
    18: (3, 1, None, "should not have year of birth in the future"),
    19: (3, -1, 1800, "should not have year of birth < 1800"),
    20: (101, -1, 0, "should not have age < 0"),
    21: (101, 1, 150, "should not have age > 150"),
}

V4_ONLY = (15, 16)
ALL_RULES = tuple(range(1, 27))


@dataclass(frozen=True)
class _Input:
    results: ResultSet
    concept: DataFrame | None
    this_year: Column


def _names(ids: Iterable[int]) -> Column:
    """The analysis name, looked up in the catalogue."""
    known = analyses()
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for i in ids:
        out = out.when(F.col("analysis_id") == i, known[i].name)
    return out


def _findings(
    df: DataFrame, ids: Iterable[int], severity: Column | str, text: Sequence[Any], count: Column | None
) -> DataFrame:
    """Compose the messages; ``df`` carries ``rule_id``, ``analysis_id`` and what ``text`` reads."""

    def part(t: Column | str) -> Column:
        return F.lit(t) if isinstance(t, str) else t.cast("string")

    pieces = [part(severity), F.lit(": "), F.col("analysis_id").cast("string")]
    pieces += [_names(sorted(set(ids))) if t is NAME else part(t) for t in text]
    return df.select(
        F.col("analysis_id").cast("int").alias("analysis_id"),
        F.concat(*pieces).alias("heel_warning"),
        F.col("rule_id").cast("int").alias("rule_id"),
        (F.lit(None) if count is None else count).cast("long").alias("record_count"),
    )


def _by_rule(values: dict[int, str]) -> Column:
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for rule, value in values.items():
        out = out.when(F.col("rule_id") == rule, value)
    return out


def _broken(df: DataFrame, tests: dict[int, Column]) -> DataFrame:
    """One row per broken rule: rows are tested against all rules in one pass."""
    hits = F.array(*[F.when(test, F.lit(rule)) for rule, test in tests.items()])
    return df.withColumn("rule_id", F.explode(F.array_compact(hits)))


def _beyond(c: Column, sign: int, limit: Column) -> Column:
    return c > limit if sign > 0 else c < limit


def _defects(x: _Input, rules: Sequence[int]) -> DataFrame:
    """Counts of improper data that are not zero."""
    bad = x.results.counts(*COUNTED_DEFECTS).filter(F.col("count_value") > 0).withColumn("rule_id", F.lit(1))
    text = ["-", NAME, "; count (n=", F.col("count_value"), ") should not be > 0"]
    return _findings(bad, COUNTED_DEFECTS, "ERROR", text, F.col("count_value")).distinct()


def _limits(x: _Input, rules: Sequence[int]) -> DataFrame:
    """Distributions that pass a limit; counts the strata that do."""
    used = {r: LIMITS[r] for r in rules}
    ids = sorted({i for ids, *_ in used.values() for i in ids})
    tests = {
        r: F.col("analysis_id").isin(*of) & _beyond(F.col(column), sign, F.lit(limit))
        for r, (of, column, sign, limit, *_) in used.items()
    }
    bad = _broken(x.results.dist(*ids), tests).groupBy("rule_id", "analysis_id").agg(F.count(F.lit(1)).alias("n"))
    text = [
        _by_rule({r: u[5] for r, u in used.items()}), NAME, " (count = ", F.col("n"), "); ",
        _by_rule({r: u[6] for r, u in used.items()}),
    ]
    return _findings(bad, ids, _by_rule({r: u[4] for r, u in used.items()}), text, F.col("n"))


def _not_in_vocabulary(x: _Input, rules: Sequence[int]) -> DataFrame:
    """Concepts (rule 4) and type concepts (rule 5) the vocabulary does not know."""
    ids = [*(BY_CONCEPT if 4 in rules else ()), *(BY_TYPE if 5 in rules else ())]
    typed = F.col("analysis_id").isin(*BY_TYPE)
    used = x.results.counts(*ids).select(
        "analysis_id",
        F.when(typed, 5).otherwise(4).alias("rule_id"),
        F.when(typed, F.col("stratum_2")).otherwise(F.col("stratum_1")).alias("id"),
    )
    known = x.concept.select(F.col("concept_id").cast("string").alias("id"))
    bad = used.filter(F.col("id").isNotNull()).join(known, "id", "left_anti")
    bad = bad.groupBy("rule_id", "analysis_id").agg(F.countDistinct("id").alias("n"))
    text = ["-", NAME, "; ", F.col("n"), " concepts in data are not in vocabulary"]
    return _findings(bad, ids, "ERROR", text, F.col("n"))


def _unmapped(x: _Input, rules: Sequence[int]) -> DataFrame:
    """Data under concept 0."""
    bad = x.results.counts(*BY_CONCEPT).filter(F.col("stratum_1") == "0").select("analysis_id").distinct()
    text = ["-", NAME, "; data with unmapped concepts"]
    return _findings(bad.withColumn("rule_id", F.lit(6)), BY_CONCEPT, "WARNING", text, None)


def _wrong_vocabulary(x: _Input, rules: Sequence[int]) -> DataFrame:
    """Concepts whose domain (or vocabulary) is none of the accepted ones."""
    used = {r: ACCEPTED[r] for r in rules}
    ids = sorted({i for ids, *_ in used.values() for i in ids})
    columns = sorted({u[1] for u in used.values()})
    concept = x.concept.select(
        F.col("concept_id").cast("string").alias("stratum_1"),
        *[F.lower(F.col(c).cast("string")).alias(c) for c in columns],
    )
    tests = {
        r: F.col("analysis_id").isin(*of)
        & ~F.col(column).isin(*accepted)
        & ((F.col("stratum_1") != "0") if column == "domain_id" else F.lit(True))
        for r, (of, column, accepted, _) in used.items()
    }
    bad = _broken(x.results.counts(*ids).join(concept, "stratum_1"), tests)
    bad = bad.groupBy("rule_id", "analysis_id").agg(F.countDistinct("stratum_1").alias("n"))
    text = [
        "-", NAME, "; ", F.col("n"), " concepts in data are not in correct vocabulary",
        _by_rule({r: u[3] for r, u in used.items()}),
    ]
    return _findings(bad, ids, "ERROR", text, F.col("n"))


def _implausible(x: _Input, rules: Sequence[int]) -> DataFrame:
    """Persons whose year of birth or age is implausible."""
    used = {r: IMPLAUSIBLE[r] for r in rules}
    ids = sorted({u[0] for u in used.values()})
    value = F.col("stratum_1").try_cast("int")
    tests = {
        r: (F.col("analysis_id") == of) & _beyond(value, sign, x.this_year if limit is None else F.lit(limit))
        for r, (of, sign, limit, _) in used.items()
    }
    bad = _broken(x.results.counts(*ids).filter(F.col("count_value") > 0), tests)
    bad = bad.groupBy("rule_id", "analysis_id").agg(F.sum("count_value").alias("n"))
    text = ["-", NAME, "; ", _by_rule({r: u[3] for r, u in used.items()}), ", (n=", F.col("n"), ")"]
    return _findings(bad, ids, "ERROR", text, F.col("n"))


def _monthly_changes(x: _Input, rules: Sequence[int]) -> DataFrame:
    """Counts that change by more than 100 % from one month to the next.

    Instead of joining the results with themselves, each row looks at the next
    month present under its analysis and concept and checks that it is the
    adjacent one. Rule 22 looks at whole tables, rule 23 at single concepts.
    """
    ids = [*(BY_MONTH if 22 in rules else ()), *(BY_CONCEPT_AND_MONTH if 23 in rules else ())]
    whole = F.col("analysis_id").isin(*BY_MONTH)
    month = F.when(whole, F.col("stratum_1")).otherwise(F.col("stratum_2")).try_cast("int")
    rows = x.results.counts(*ids).select(
        "analysis_id",
        F.when(whole, 22).otherwise(23).alias("rule_id"),
        F.when(~whole, F.col("stratum_1")).alias("concept"),
        (F.floor(month / 100) * 12 + month % 100).alias("at"),
        "count_value",
    )
    rows = rows.filter(F.col("at").isNotNull() & ((F.col("rule_id") == 22) | F.col("concept").isNotNull()))
    following = W.partitionBy("analysis_id", "concept").orderBy("at")
    ahead = rows.withColumn("next_at", F.lead("at").over(following)).withColumn(
        "next_count", F.lead("count_value").over(following)
    )
    change = F.abs(F.col("next_count") - F.col("count_value"))
    bad = ahead.filter(
        (F.col("next_at") == F.col("at") + 1)
        & (F.col("count_value") > MIN_BASE_COUNT)
        & (change > F.col("count_value"))
    )
    bad = bad.groupBy("rule_id", "analysis_id").agg(F.countDistinct("concept").alias("n"))
    concepts = F.col("rule_id") == 23
    text = [
        "-", NAME, "; ",
        F.when(concepts, F.concat(F.col("n").cast("string"), F.lit(" concepts have a"))).otherwise("theres a"),
        " 100% change in monthly count of events",
    ]
    return _findings(bad, ids, "WARNING", text, F.when(concepts, F.col("n")))


# rules by shape; rules of one shape share one pass
_SHAPES: tuple[tuple[tuple[int, ...], Callable[[_Input, Sequence[int]], DataFrame]], ...] = (
    ((1,), _defects),
    (tuple(LIMITS), _limits),
    ((4, 5), _not_in_vocabulary),
    ((6,), _unmapped),
    (tuple(ACCEPTED), _wrong_vocabulary),
    (tuple(IMPLAUSIBLE), _implausible),
    ((22, 23), _monthly_changes),
)


def rules_not_run(concept: DataFrame | None, version: str = "v5") -> tuple[int, ...]:
    """Rules of ``version`` that this concept table cannot serve.

    Rules on concepts need the table, rules on domains and vocabularies also their column (early version 4
    vocabularies have no domains).
    """
    have = set() if concept is None else set(concept.columns)
    lacking = {r for r in ACCEPTED if ACCEPTED[r][1] not in have} | ({4, 5} if concept is None else set())
    return tuple(r for r in ALL_RULES if r in lacking and (version == "v4" or r not in V4_ONLY))


def run_heel(
    results: ResultSet,
    concept: DataFrame | None,
    rules: Sequence[int] | None = None,
    version: str = "v5",
    this_year: int | None = None,
) -> DataFrame:
    """Findings of the given rules (default: all of ``version``).

    ``this_year`` fixes the clock of the birth-year rule. By default
    ``rules_not_run`` are left out, and a warning names them.
    """
    if rules is None:
        lacking = rules_not_run(concept, version)
        if lacking:
            warnings.warn(f"the concept table cannot serve these rules, which are not run: {list(lacking)}", stacklevel=2)
        rules = [r for r in ALL_RULES if (version == "v4" or r not in V4_ONLY) and r not in lacking]
    year = F.year(F.current_date()) if this_year is None else F.lit(this_year)
    given = _Input(results, concept, year)
    parts = []
    for of, find in _SHAPES:
        wanted = [r for r in of if r in rules]
        if wanted:
            parts.append(find(given, wanted))
    return reduce(DataFrame.unionByName, parts)


def fetch_heel(findings: DataFrame) -> DataFrame:
    """All findings, errors first whatever their spelling."""
    severity = F.when(F.upper(F.substring("heel_warning", 1, 5)) == "ERROR", 1).otherwise(2)
    return findings.orderBy(severity, "analysis_id", "rule_id")
