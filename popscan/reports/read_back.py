"""Documents read back by value: one row for every value that a JSON document holds.

Sections of a document are tables stored column by column, some below a histogram's axis. Reading back parses the JSON
without knowing the sections: a document is a map of sections, a section a map of fields, a field an array or a single
value. Whoever compares documents, with each other or with another system's, compares these rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SINGLE = -1  # position of a value that stands alone, such as an end of an axis
_MAP, _ARRAY = "map<string,string>", "array<string>"


def _starts(c: Column, bracket: str) -> Column:
    return F.substring(F.ltrim(c), 1, 1) == bracket


def document_values(documents: DataFrame) -> DataFrame:
    """``path, section, position, field, value`` of documents (``path, document``).

    ``value`` is the JSON text of a number or the text of a string; positions count from 0 within a field.
    """
    sections = documents.select("path", F.explode(F.from_json("document", _MAP)).alias("section", "body"))
    fields = sections.select("path", "section", F.explode(F.from_json("body", _MAP)).alias("field", "body"))
    # the table of a histogram lies one level below its axis
    nested = _starts(F.col("body"), "{")
    inner = F.when(nested, F.from_json("body", _MAP)).otherwise(F.create_map("field", "body"))
    flat = fields.select("path", "section", F.explode(inner).alias("field", "body"))
    values = F.when(_starts(F.col("body"), "["), F.from_json("body", _ARRAY))
    listed = flat.select("path", "section", "field", "body", F.posexplode_outer(values).alias("at", "value"))
    many = _starts(F.col("body"), "[")
    # an empty array has no values; a single value has no position
    return listed.filter(~many | F.col("at").isNotNull()).select(
        "path", "section", F.coalesce("at", F.lit(SINGLE)).alias("position"), "field",
        F.when(many, F.col("value")).otherwise(F.col("body")).alias("value"),
    )


def node_values(nodes: DataFrame, key: str = "CONCEPT_ID") -> DataFrame:
    """The same rows of a file that holds one flat object per line, such as a treemap; ``section`` is the object's ``key``."""
    parsed = nodes.select("path", F.from_json("document", _MAP).alias("m"))
    listed = parsed.select("path", F.element_at("m", key).alias("section"), F.explode("m").alias("field", "value"))
    return listed.select("path", "section", F.lit(SINGLE).alias("position"), "field", "value")


def numbers_apart(values: DataFrame, digits: int = 5) -> DataFrame:
    """``value`` as ``number`` (rounded) where it reads as one, else as ``text``."""
    number = F.col("value").try_cast("double")
    return values.select(
        "path", "section", "position", "field", F.when(number.isNull(), F.col("value")).alias("text"),
        F.round(number, digits).alias("number"),
    )
