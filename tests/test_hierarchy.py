"""Treemap hierarchies on a hand-written vocabulary, both versions."""

from __future__ import annotations

import pytest

from popscan.reports import hierarchy
from popscan.reports.hierarchy import PROCEDURE_ROOT, Vocabulary

LINKS = [
    # condition 1 -> terms 11, 12 -> 21 -> 31 -> 41; condition 2 -> 13, which leads nowhere
    (11, 1, 1), (12, 1, 1), (21, 12, 1), (31, 21, 1), (41, 31, 1), (13, 2, 1),
    # drug 101 holds ingredients 111 and 112
    (111, 101, 1), (112, 101, 1), (111, 111, 0), (122, 111, 1), (123, 111, 1), (132, 123, 2), (142, 132, 3),
    # procedure tree
    (PROCEDURE_ROOT, 201, 1), (PROCEDURE_ROOT, 211, 2), (201, 211, 1), (211, 221, 1), (221, 231, 1),
]


def concepts(v4):
    def c(i, domain, vocabulary, old, klass, code="c"):
        return (i, f"n{i}", domain, old if v4 else vocabulary, klass, code)

    rows = [c(i, "Condition", "SNOMED", 1, "Finding") for i in (1, 2, 3)]
    for ids, klass in (((11, 12, 13), "Preferred Term"), ((21,), "High Level Term"), ((31,), "High Level Group Term"),
                       ((41,), "System Organ Class")):
        rows += [c(i, "Other", "MedDRA", 15, klass) for i in ids]
    rows += [c(101, "Drug", "RxNorm", 8, "Clinical Drug"), c(111, "Drug", "RxNorm", 8, "Ingredient"),
             c(112, "Drug", "RxNorm", 8, "Ingredient")]
    for ids, klass, code in (((122, 123), "ATC 4th", "A01BB"), ((132,), "ATC 2nd", "A01"), ((142,), "ATC 1st", "A")):
        rows += [c(i, "Drug class", "ATC", 21, klass, code) for i in ids]
    rows += [c(i, "Procedure", "CPT4", 4, "Procedure") for i in (201, 211, 221, 231)]
    return rows


@pytest.fixture(params=["v4", "v5"], scope="module")
def vocabulary(request, spark):
    v4 = request.param == "v4"
    kind = "int" if v4 else "string"
    concept = spark.createDataFrame(
        concepts(v4),
        f"concept_id int, concept_name string, domain_id string, vocabulary_id {kind}, concept_class_id string, concept_code string",
    )
    ancestor = spark.createDataFrame(
        LINKS, "ancestor_concept_id int, descendant_concept_id int, min_levels_of_separation int"
    )
    names = spark.createDataFrame([(4 if v4 else "CPT4", "CPT")], f"vocabulary_id {kind}, vocabulary_name string")
    return Vocabulary({"concept": concept, "concept_ancestor": ancestor, "vocabulary": names}, request.param)


def paths(spark, tree, vocabulary, ids):
    only = spark.createDataFrame([(i,) for i in ids], "concept_id int")
    return sorted((r.concept_id, r.concept_path) for r in tree(vocabulary, only).collect())


def test_conditions(spark, vocabulary):
    got = paths(spark, hierarchy.conditions, vocabulary, [1, 2, 3])
    # the largest parent wins; a term without a parent of its own shows as NA
    assert got == [(1, "n41||n31||n21||n12||n1"), (2, "NA||NA||NA||NA||n2"), (3, "NA||NA||NA||NA||n3")]


def test_drugs_have_a_row_per_ingredient(spark, vocabulary):
    got = paths(spark, hierarchy.drugs, vocabulary, [101])
    assert got == [(101, "NA||NA||NA||n112||n101"), (101, "n142||n132||n123||n111||n101")]


def test_ingredients(spark, vocabulary):
    assert paths(spark, hierarchy.ingredients, vocabulary, [111, 101]) == [(111, "n142||n132||n123||n111")]


def test_procedures(spark, vocabulary):
    got = paths(spark, hierarchy.procedures, vocabulary, [231, 201])
    assert got == [(201, "NA||NA||NA||CPT c: n201"), (231, "n201||n211||n221||CPT c: n231")]
