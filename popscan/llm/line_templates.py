"""Line dedup by a log-template tree.

Lines are words with every word that holds a digit read as ``<*>``. The tree has fixed depth: the first level is the
number of words, the next ones the leading words. In a leaf the fields that vary are generalised: a place whose most
frequent word covers less than half of the leaf's distinct lines is a variable, the others are the leaf's constants. A
line that agrees with at least ``similarity`` of its places (constants it matches, of all places) belongs to the leaf's
template, whatever its length. The lines that do not agree are split by the word at one more place, where frequent words
cover most of them, and vote again, each line by its number of documents, until no group can hold ``min_docs`` documents
of one template: a leaf has as many templates as recur in it. Any other line is a template of its own. A template that
recurs in ``min_docs`` documents or more, copies of one text counted once, is dropped from all but the first document
(the smallest id) that holds it.

Lines are masked and hashed once and kept as a table. They are counted per leaf and template before words are exploded,
and words only in leaves that recur, so a line that stands in a third of all documents is one row by then. A vote counts
words by lines and by documents at once, and only groups that gave a template are counted again. Each further vote sees
only lines that can still be in a template. Joins on a template's hash are plain equi-joins that adaptive execution
splits where one is hot.

Defined results: null and empty texts have no lines and stay as they are; lines without a word are never dropped; a
null id comes after all others; rows that repeat (id and text) share one verdict; of words with equal votes at a place
the greatest is the constant; an empty table gives no row; lines and texts of any length take part whole; columns other
than ``text`` pass untouched, whatever they are called, a column ``n_dropped`` is replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from popscan.llm.line_rules import row_key, without_lines
from popscan.llm.storage import stored

VARIABLE = "<*>"
_SPACE = r"[\x20\x09-\x0D]+"


def lines_of(documents: DataFrame, depth: int) -> DataFrame:
    """``_id, _row, doc_id, _content, pos, leaf, line, masked``."""
    rows = documents.select(
        *row_key("text"), "doc_id", F.xxhash64("text").alias("_content"),
        F.posexplode(F.split("text", "\n")).alias("pos", "_t"),
    )
    rows = rows.filter(F.col("_t").rlike(r"[^\x20\x09-\x0D]"))
    masked = F.when(F.col("_t").rlike("[0-9]"), F.regexp_replace("_t", r"[^\x20\x09-\x0D0-9]*[0-9][^\x20\x09-\x0D]*", VARIABLE)).otherwise(F.col("_t"))
    rows = rows.withColumn("_m", F.trim(F.regexp_replace(masked, _SPACE, " ")))
    rows = rows.withColumn("_w", F.split("_m", " "))
    lead = [F.get("_w", F.lit(k)) for k in range(depth)]
    return rows.select(
        "_id", "_row", "doc_id", "_content", "pos", F.xxhash64(F.size("_w"), *lead).alias("leaf"), F.xxhash64("_m").alias("line"),
        F.col("_m").alias("masked"),
    )


def _weights(lines: DataFrame) -> DataFrame:
    """``group, place, word, lines, n``: the lines, and the documents, that have each word at each place of a group."""
    places = lines.select("group", F.col("n").alias("v"), F.posexplode("words").alias("place", "word"))
    return places.groupBy("group", "place", "word").agg(F.count(F.lit(1)).alias("lines"), F.sum("v").alias("n"))


def _voted(lines: DataFrame, votes: str, min_docs: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """``group, line, n, words`` and ``member``: whether the line belongs to its group's template, if that recurs.

    Also ``group, place, word, n`` and ``constant``: words that are the group's constants or have half of ``min_docs``.
    """
    total = lines.groupBy("group").agg(F.count(F.lit(1)).alias("_lines"), F.sum("n").alias("_n"))
    constant = 2 * F.col(votes) >= F.col(f"_{votes}")
    weights = _weights(lines).join(total, "group").withColumn("constant", constant)
    weights = stored(weights.filter(F.col("constant") | (2 * F.col("n") >= min_docs)).drop("_lines", "_n"), "weights")
    constants = (
        weights.filter("constant")
        .groupBy("group", "place")
        .agg(F.max(F.struct(votes, "word"))["word"].alias("word"))
        .groupBy("group")
        .agg(F.collect_set(F.xxhash64("place", "word")).alias("constants"))
    )
    own = F.transform("words", lambda w, i: F.xxhash64(i, w))
    agree = F.size(F.array_intersect(own, "constants")) >= similarity * F.size("words")
    agreed = lines.join(constants, "group", "left").withColumn("agree", F.coalesce(agree, F.lit(False))).drop("constants")
    agreed = stored(agreed, "agreed")
    found = agreed.filter("agree").groupBy("group").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_docs)
    joined = agreed.join(found.select("group", F.lit(True).alias("found")), "group", "left")
    return joined.withColumn("member", F.col("agree") & F.col("found").isNotNull()).drop("agree", "found"), weights


def _weights_left(voted: DataFrame, weights: DataFrame, min_docs: int) -> DataFrame:
    """``group, place, word, s``: documents of each word with half of ``min_docs`` in the lines that are no members.

    A group that gave no template keeps its ``weights``. Of the others only those whose other lines still have ``min_docs``
    are looked at again, as fewer hold no template.
    """
    found = stored(voted.filter("member").select("group").distinct(), "found")
    kept = weights.join(found, "group", "left_anti").select("group", "place", "word", F.col("n").alias("s"))
    rest = voted.filter("NOT member").join(found, "group", "left_semi")
    able = rest.groupBy("group").agg(F.sum("n").alias("_n")).filter(F.col("_n") >= min_docs).select("group")
    again = _weights(rest.join(able, "group", "left_semi")).select("group", "place", "word", F.col("n").alias("s"))
    return kept.unionByName(again).filter(2 * F.col("s") >= min_docs)


def _hopeful(lines: DataFrame, weights: DataFrame, similarity: float) -> DataFrame:
    """``group`` where so many places have a word of ``weights`` that a line can agree with enough of them."""
    places = weights.groupBy("group").agg(F.count_distinct("place").alias("k"))
    sizes = lines.groupBy("group").agg(F.min(F.size("words")).alias("size"))
    return places.join(sizes, "group").filter(F.col("k") >= similarity * F.col("size")).select("group")


def _deeper(voted: DataFrame, weights: DataFrame, min_docs: int, similarity: float) -> DataFrame:
    """The lines that can still be in a template, their groups split by the word at one more place.

    A constant of a template has at least half of ``min_docs`` in its group, so a line with too few such words is in none,
    and the words of a group with such words at too few places are not looked at again.
    The place is the one where words of ``min_docs`` or more cover most; each of them becomes a group, as do the others.
    """
    weights = stored(_weights_left(voted, weights, min_docs), "weights")
    lines = voted.filter("NOT member").drop("member")
    lines = lines.join(_hopeful(lines, weights, similarity), "group", "left_semi")
    places = lines.select("group", "line", F.size("words").alias("size"), F.posexplode("words").alias("place", "word"))
    able = (
        places.join(weights, ["group", "place", "word"])
        .groupBy("group", "line", "size")
        .agg(F.count(F.lit(1)).alias("k"))
        .filter(F.col("k") >= similarity * F.col("size"))
        .select("group", "line")
    )
    total = lines.groupBy("group").agg(F.sum("n").alias("total"))
    split = weights.filter(F.col("s") >= min_docs).join(total, "group").filter(F.col("s") < F.col("total"))
    place = (
        split.groupBy("group", "place")
        .agg(F.sum("s").alias("s"))
        .groupBy("group")
        .agg(F.max(F.struct("s", (-F.col("place")).alias("back")))["back"].alias("back"))
        .select("group", (-F.col("back")).alias("place"))
    )
    left = lines.join(able, ["group", "line"]).join(place, "group").withColumn("word", F.get("words", F.col("place")))
    split = split.select("group", "place", "word", F.lit(True).alias("often"))
    left = left.join(split, ["group", "place", "word"], "left")
    child = F.xxhash64("group", "place", F.when(F.col("often"), F.col("word")))
    return left.select(child.alias("group"), "line", "n", "words")


def generalised(lines: DataFrame, min_docs: int, similarity: float) -> DataFrame:
    """``line, leaf``: the lines that belong to a template, and that template's group."""
    counted = (
        lines.select("leaf", "line", "_content").distinct().groupBy("leaf", "line").agg(F.count(F.lit(1)).alias("n"))
    )
    counted = stored(counted, "counted")
    leaves = (
        counted.groupBy("leaf")
        .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_lines"))
        .filter((F.col("n") >= min_docs) & (F.col("n_lines") > 1))
        .select("leaf")
    )
    leaves = stored(leaves, "leaves")  # of known size, so that lines are not shuffled to meet few leaves
    # lines meet the leaves first: whole lines are shuffled for leaves that recur only
    distinct = lines.select("leaf", "line", "masked").join(leaves, "leaf").distinct().join(counted, ["leaf", "line"])
    found, votes = [], "lines"  # the leaf's vote is by distinct lines, later ones by documents
    open_ = stored(distinct.select(F.col("leaf").alias("group"), "line", "n", F.split("masked", " ").alias("words")), "leaf-lines")
    while True:
        voted, weights = _voted(open_, votes, min_docs, similarity)
        voted = stored(voted, "voted")
        found.append(voted.filter("member").select("line", F.col("group").alias("leaf")))
        open_ = stored(_deeper(voted, weights, min_docs, similarity), "deeper")
        votes = "n"
        if open_.isEmpty():
            return reduce(DataFrame.unionAll, found)


def recurring(documents: DataFrame, min_docs: int = 10, depth: int = 2, similarity: float = 0.6) -> DataFrame:
    """``_id, _row, pos`` of the lines to drop."""
    lines = stored(lines_of(documents, depth), "masked")
    members = generalised(lines, min_docs, similarity).withColumnRenamed("leaf", "_leaf")
    keyed = lines.select("_id", "_row", "doc_id", "_content", "pos", "line").join(members, "line", "left")
    template = F.coalesce("_leaf", "line").alias("template")
    keyed = stored(keyed.select("_id", "_row", "doc_id", "_content", "pos", template), "lines")
    counted = (
        keyed.groupBy("template", "_content")
        .agg(F.min("doc_id").alias("first"))
        .groupBy("template")
        .agg(F.count(F.lit(1)).alias("n"), F.min("first").alias("first"))
        .filter(F.col("n") >= min_docs)
    )
    hits = keyed.join(counted.select("template", "first"), "template")
    return hits.filter(~F.col("doc_id").eqNullSafe(F.col("first"))).select("_id", "_row", "pos").distinct()


def drop_recurring(documents: DataFrame, **options) -> DataFrame:
    """``documents`` without recurring lines, and ``n_dropped``, the number of lines dropped from each."""
    documents = documents.drop("n_dropped")
    # the input's columns travel under names of their own, so none of ours can clash with them; its text travels once
    own = [f"_in_{i}" for i in range(len(documents.columns))]
    held = documents.select("*", F.col("doc_id"), F.col("text")).toDF(*own, "doc_id", "text")
    gone = recurring(held, **options).groupBy("_id", "_row").agg(F.collect_list("pos").alias("_gone"))
    joined = held.select(*own, "text", *row_key("text")).join(gone, ["_id", "_row"], "left")
    cut = without_lines("text", "_gone")
    columns = [cut.alias(c) if c == "text" else F.col(o).alias(c) for o, c in zip(own, documents.columns, strict=True)]
    return joined.select(*columns, F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_dropped"))


#: The query's rows in DuckDB, options as :func:`recurring` has them by default.
ORACLE = r"""
WITH line AS (
  SELECT doc_id, md5(text) AS content, pos, line, trim(regexp_replace(regexp_replace(line,
      '[^\x20\x09-\x0D0-9]*[0-9][^\x20\x09-\x0D]*', '<*>', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS m
  FROM (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
          generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
tree AS (
  SELECT *, len(string_split(m, ' ')) AS size, string_split(m, ' ') AS words,
    concat_ws(' ', len(string_split(m, ' ')), string_split(m, ' ')[1], string_split(m, ' ')[2]) AS leaf FROM line),
leaves AS (
  SELECT leaf, sum(n) AS n, count(*) AS n_lines
  FROM (SELECT leaf, m, count(DISTINCT content) AS n FROM tree WHERE size <= 64 GROUP BY 1, 2)
  GROUP BY 1 HAVING sum(n) >= 10 AND count(*) > 1),
places AS (
  SELECT leaf, m, size, n_lines, unnest(words) AS word, generate_subscripts(words, 1) AS place
  FROM (SELECT DISTINCT leaf, m, size, words FROM tree WHERE size <= 64) JOIN leaves USING (leaf)),
constants AS (
  SELECT leaf, place, max_by(word, struct_pack(n := n, word := word)) AS constant
  FROM (SELECT leaf, place, word, n_lines, count(*) AS n FROM places GROUP BY 1, 2, 3, 4 HAVING 2 * count(*) >= n_lines)
  GROUP BY 1, 2),
members AS (
  SELECT leaf, m FROM places JOIN constants USING (leaf, place) WHERE word = constant
  GROUP BY leaf, m, size HAVING count(*) >= 0.6 * size),
keyed AS (
  SELECT t.doc_id, t.content, t.pos, t.line, CASE WHEN g.leaf IS NULL THEN 'line ' || t.m ELSE 'leaf ' || g.leaf END AS template
  FROM tree t LEFT JOIN members g ON g.m = t.m AND g.leaf = t.leaf),
counted AS (SELECT template, min(doc_id) AS first FROM keyed GROUP BY 1 HAVING count(DISTINCT content) >= 10),
gone AS (SELECT doc_id, pos FROM keyed JOIN counted USING (template) WHERE doc_id <> first),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
          generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)
  ANTI JOIN gone USING (doc_id, pos) GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_dropped, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1) USING (doc_id)
"""
