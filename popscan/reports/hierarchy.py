"""Concept hierarchies for treemaps, by joins on the ancestor closure.

Each level of a hierarchy is a small map from a concept to its chosen parent
(the largest id where there are several). Maps are looked up with left joins,
so a missing level shows as NA.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROCEDURE_ROOT = 4040390  # fixed value: root concept of the procedure hierarchy


@dataclass(frozen=True)
class Rules:
    """Which concepts form a hierarchy's levels, as conditions on the concept table."""

    condition: str
    medra: tuple[str, str, str, str]  # preferred term, high level term, its group, organ class
    medra_step: str  # condition on the levels between neighbours
    drug: str
    ingredient: str
    atc: tuple[str, str, str]  # finest, middle, coarsest
    procedure: str
    observation: str
    condition_type: str


# Domains, vocabularies and classes.
V5 = Rules(
    condition="domain_id = 'Condition'",
    medra=("vocabulary_id = 'MedDRA'",) * 4,
    medra_step="min_levels_of_separation = 1",
    drug="domain_id = 'Drug'",
    ingredient="domain_id = 'Drug' AND concept_class_id = 'Ingredient'",
    atc=tuple(f"vocabulary_id = 'ATC' AND concept_class_id = 'ATC {level}'" for level in ("4th", "2nd", "1st")),
    procedure="domain_id = 'Procedure'",
    observation="domain_id = 'Observation'",
    condition_type="lower(domain_id) IN ('condition', 'condition type')",
)
V4 = Rules(
    condition="vocabulary_id = 1",
    medra=tuple(
        f"vocabulary_id = 15 AND concept_class_id = '{c}'"
        for c in ("Preferred Term", "High Level Term", "High Level Group Term", "System Organ Class")
    ),
    medra_step="true",
    drug="vocabulary_id = 8",
    ingredient="vocabulary_id = 8 AND concept_class_id = 'Ingredient'",
    atc=tuple(f"vocabulary_id = 21 AND length(concept_code) = {n}" for n in (5, 3, 1)),
    procedure="vocabulary_id IN (3, 4, 5) OR (vocabulary_id = 1 AND concept_class_id = 'Procedure')",
    observation="vocabulary_id = 6",
    condition_type="vocabulary_id = 37",
)
RULES = {"v5": V5, "v4": V4}


@dataclass(frozen=True)
class Vocabulary:
    """The vocabulary tables and the rules that go with their version.

    ``this_year`` fixes the clock of the quality rule on birth years (default: today's).
    """

    tables: Mapping[str, DataFrame]
    version: str = "v5"
    this_year: int | None = None

    @property
    def rules(self) -> Rules:
        return RULES[self.version]

    @property
    def concept(self) -> DataFrame:
        return self.tables["concept"]

    def parents(self, child: str, parent: str, step: str = "true", name: str | None = None) -> DataFrame:
        """``child[, name], parent``: each matching concept's largest matching ancestor."""
        kids = self.concept.filter(child).select(F.col("concept_id").alias("child"), F.col("concept_name").alias("kid"))
        tops = self.concept.filter(parent).select(F.col("concept_id").alias("parent"))
        links = (
            self.tables["concept_ancestor"]
            .filter(step)
            .select(F.col("descendant_concept_id").alias("child"), F.col("ancestor_concept_id").alias("parent"))
        )
        linked = links.join(kids, "child").join(tops, "parent")
        keys = ["child"] if name is None else ["child", F.col("kid").alias(name)]
        return linked.groupBy(*keys).agg(F.max("parent").alias("parent"))


def _climb(df: DataFrame, key: str, step: DataFrame, to: str) -> DataFrame:
    """Look up the parent of ``key`` in a step map; misses stay NULL."""
    named = step.withColumnsRenamed({"child": key, "parent": to})
    return df.join(named, key, "left")


def _or_na(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("NA"))


def path(*names: str) -> Column:
    return F.concat_ws("||", *[_or_na(n) for n in names])


def _named(v: Vocabulary, key: str, name: str) -> DataFrame:
    return v.concept.select(F.col("concept_id").alias(key), F.col("concept_name").alias(name))


def _wanted(df: DataFrame, only: DataFrame) -> DataFrame:
    """Keep the concepts that occur in the results, before climbing."""
    return df.join(only, "concept_id", "left_semi")


def visits(v: Vocabulary, only: DataFrame) -> DataFrame:
    """Flat: the path is the name."""
    return _wanted(v.concept, only).select("concept_id", F.col("concept_name").alias("concept_path"))


def conditions(v: Vocabulary, only: DataFrame) -> DataFrame:
    """``concept_id, concept_path`` of conditions below their organ classes."""
    r = v.rules
    base = _wanted(v.concept.filter(r.condition).select("concept_id", "concept_name"), only)
    pt, hlt, hlgt, soc = r.medra
    out = _climb(base, "concept_id", v.parents(r.condition, pt, r.medra_step), "pt_id")
    out = _climb(out, "pt_id", v.parents(pt, hlt, r.medra_step, "pt"), "hlt_id")
    out = _climb(out, "hlt_id", v.parents(hlt, hlgt, r.medra_step, "hlt"), "hlgt_id")
    out = _climb(out, "hlgt_id", v.parents(hlgt, soc, r.medra_step, "hlgt"), "soc_id")
    out = out.join(_named(v, "soc_id", "soc"), "soc_id", "left")
    return out.select("concept_id", path("soc", "hlgt", "hlt", "pt", "concept_name").alias("concept_path"))


def _above_ingredients(v: Vocabulary, df: DataFrame) -> DataFrame:
    r = v.rules
    fine, middle, coarse = r.atc
    out = _climb(df, "ingredient_id", v.parents(r.ingredient, fine), "atc5_id")
    out = _climb(out, "atc5_id", v.parents(fine, middle, name="atc5"), "atc3_id")
    out = _climb(out, "atc3_id", v.parents(middle, coarse, name="atc3"), "atc1_id")
    return out.join(_named(v, "atc1_id", "atc1"), "atc1_id", "left")


def drugs(v: Vocabulary, only: DataFrame) -> DataFrame:
    """Drugs below their ingredients and therapeutic classes; one row per ingredient."""
    r = v.rules
    drug = _wanted(v.concept.filter(r.drug).select("concept_id", "concept_name"), only)
    ingredient = v.concept.filter(r.ingredient).select(
        F.col("concept_id").alias("ingredient_id"), F.col("concept_name").alias("ingredient")
    )
    links = v.tables["concept_ancestor"].select(
        F.col("descendant_concept_id").alias("concept_id"), F.col("ancestor_concept_id").alias("ingredient_id")
    )
    out = _above_ingredients(v, links.join(drug, "concept_id").join(ingredient, "ingredient_id"))
    top = [_or_na(c) for c in ("atc1", "atc3", "atc5", "ingredient")]
    return out.select("concept_id", F.concat_ws("||", *top, "concept_name").alias("concept_path"))


def ingredients(v: Vocabulary, only: DataFrame) -> DataFrame:
    """Ingredients below their therapeutic classes."""
    base = _wanted(v.concept.filter(v.rules.ingredient), only).select(
        F.col("concept_id").alias("ingredient_id"), F.col("concept_name").alias("ingredient")
    )
    out = _above_ingredients(v, base)
    top = [_or_na(c) for c in ("atc1", "atc3", "atc5")]
    name = F.coalesce("ingredient", F.lit("||"))
    return out.select(F.col("ingredient_id").alias("concept_id"), F.concat_ws("||", *top, name).alias("concept_path"))


def procedures(v: Vocabulary, only: DataFrame) -> DataFrame:
    """Procedures below the three levels under the procedure root."""
    ca = v.tables["concept_ancestor"]

    def under_root(levels: int) -> DataFrame:
        at = ca.filter((F.col("ancestor_concept_id") == PROCEDURE_ROOT) & (F.col("min_levels_of_separation") == levels))
        return at.select(F.col("descendant_concept_id").alias("id"))

    def step(levels: int, parent: str, child: str, name: str) -> DataFrame:
        """Concepts one below those ``levels`` under the root, with their largest parent."""
        pairs = ca.filter(F.col("min_levels_of_separation") == 1).select(
            F.col("ancestor_concept_id").alias(parent), F.col("descendant_concept_id").alias(child)
        )
        known = v.concept.select(F.col("concept_id").alias("id"))
        uppers = under_root(levels).join(known, "id", "left_semi").select(F.col("id").alias(parent))
        named = pairs.join(uppers, parent, "left_semi").join(_named(v, child, name), child)
        return named.groupBy(child, name).agg(F.max(parent).alias(parent))

    level1 = under_root(1).withColumnRenamed("id", "os1_id").join(_named(v, "os1_id", "os1"), "os1_id")
    level3 = step(2, "os2_id", "os3_id", "os3")
    tree = level3.join(step(1, "os1_id", "os2_id", "os2"), "os2_id").join(level1, "os1_id")
    tree = tree.groupBy("os3_id").agg(F.max("os3").alias("os3"), F.max("os2").alias("os2"), F.max("os1").alias("os1"))
    chosen = (
        ca.select(F.col("ancestor_concept_id").alias("os3_id"), F.col("descendant_concept_id").alias("concept_id"))
        .join(level3.select("os3_id"), "os3_id", "left_semi")
        .groupBy("concept_id")
        .agg(F.max("os3_id").alias("os3_id"))
    )
    label = F.concat_ws("", "vocabulary_name", F.lit(" "), "concept_code", F.lit(": "), "concept_name")
    named = _wanted(v.concept.filter(v.rules.procedure), only).join(v.tables["vocabulary"], "vocabulary_id")
    out = named.select("concept_id", label.alias("proc")).join(chosen, "concept_id", "left").join(tree, "os3_id", "left")
    return out.select("concept_id", path("os1", "os2", "os3", "proc").alias("concept_path"))


def measurements(v: Vocabulary, only: DataFrame) -> DataFrame:
    return _three_levels(v, v.concept, only)


def observations(v: Vocabulary, only: DataFrame) -> DataFrame:
    return _three_levels(v, v.concept.filter(v.rules.observation), only)


def ancestor_levels(v: Vocabulary, base: DataFrame, levels: int) -> DataFrame:
    """``concept_id, level, ancestor, name``: the distinct named ancestors of each concept, by steps of one level.

    Each level is a set of its own, climbed from the set below it, so a concept with many parents has as many rows as it
    has ancestors on that level, not as there are ways up to them.
    """
    up = (
        v.tables["concept_ancestor"]
        .filter(F.col("min_levels_of_separation") == 1)
        .select(F.col("descendant_concept_id").alias("at"), F.col("ancestor_concept_id").alias("ancestor"))
        .join(_named(v, "ancestor", "name"), "ancestor")  # parents need a row of their own to be climbed further
    )
    at = base.select("concept_id", F.col("concept_id").alias("at"))
    found = []
    for level in range(1, levels + 1):
        reached = at.join(up, "at").select("concept_id", "ancestor", "name").distinct()
        found.append(reached.select("concept_id", F.lit(level).alias("level"), "ancestor", "name"))
        at = reached.select("concept_id", F.col("ancestor").alias("at")).distinct()
    return reduce(DataFrame.unionByName, found)


def _three_levels(v: Vocabulary, concepts: DataFrame, only: DataFrame) -> DataFrame:
    """Concepts below three direct ancestors; the largest name of each level."""
    base = _wanted(concepts, only).select("concept_id", "concept_name")
    above = ancestor_levels(v, base, 3).groupBy("concept_id").agg(
        *[F.max(F.when(F.col("level") == i, F.col("name"))).alias(f"n{i}") for i in (1, 2, 3)]
    )
    named = base.join(above, "concept_id", "left").distinct()
    full = F.concat_ws("||", F.col("concept_id").cast("string"), *[_or_na(c) for c in ("n3", "n2", "n1", "concept_name")])
    return named.select("concept_id", full.alias("concept_path"))
