"""Phrase collocations by top-order marginalisation.

Every word starts one window of ``longest`` words: the word and its lead columns, padded with nulls where a piece ends.
Only these windows are counted; Spark's ROLLUP over (lang, first word, second word, ...) then sums successively shorter
prefixes, so the counts of all shorter phrases, of words and of the language come from one aggregation, not from an
explosion for each order.

Before that, runs of two words, then of three and so on below ``longest`` are counted by a 64-bit hash, each only where
its shorter parts are frequent, and the frequent ones are put into a filter of fixed size (:mod:`popscan.llm.sketch`). A
window is also padded from its first infrequent run on: a phrase with ``least`` occurrences has no such run, so no count
of one changes, while most windows of running text shrink to a word or two and add up within their task. The filters let
more through on larger inputs, which costs shuffle only; counts are of words, never of hashes. Equal windows are added up per slice of text, again in Spark's partial aggregation, then by key, so a word
that makes up a third of a language is one row per task.

Scores: a phrase with a occurrences is cut in two, with l and r occurrences of its parts; floor(2000000 a / (l + r)) of
the lowest-scoring cut, in decimals of 38 digits. A phrase inside a longer one that has ``share`` percent of its
occurrences is dropped.

Defined results: null and empty texts have no words, a null language is ``und``; texts of any length are cut into slices
between documents only; repeated rows count as often as they stand; ties in score and count are put in byte order of the
phrase; an empty table gives no row; other columns do not reach the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from popscan.llm.sketch import Sketch, sketch
from popscan.llm.storage import stored
from popscan.llm.textual import mix, slices

SLICE = 4 << 20
PIECE_ENDS = ".,;:!?\n\x0b\x0c\r"
_END = np.zeros(256, bool)
_END[[ord(c) for c in PIECE_ENDS]] = True
_GAP = _END.copy()
_GAP[[9, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class _Slice:
    """Words of consecutive texts as exact codes: text, piece and code of each, the words and languages behind the codes."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, langs: pa.Array):
        data = _LOWER[data]
        solid = ~_GAP[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True  # words never run across texts
        start = np.flatnonzero(solid & (edge[:-1] | ~np.r_[False, solid[:-1]]))
        end = np.flatnonzero(solid & (edge[1:] | ~np.r_[solid[1:], False])) + 1
        doc = np.searchsorted(bounds, start, side="right") - 1
        offsets = np.concatenate(([0], np.cumsum(end - start)))
        words = pa.LargeStringArray.from_buffers(
            len(start), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[solid].tobytes())
        ).dictionary_encode()
        self.words, self.code = words.dictionary, np.asarray(words.indices).astype(np.int64)
        langs = langs.dictionary_encode()
        self.langs = langs.dictionary
        self.lang = np.asarray(langs.indices).astype(np.int64)[doc]
        piece = np.concatenate(([0], np.cumsum(_END[data])))[start]
        #: does the next word follow in the same piece?
        self.follows = np.zeros(len(start), bool)
        self.follows[:-1] = (doc[1:] == doc[:-1]) & (piece[1:] == piece[:-1])

    def _hashes(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each word and its language, alike in all tasks."""
        word = np.array([xxhash.xxh64_intdigest(w) for w in self.words.cast(pa.large_binary()).to_pylist()], np.uint64)
        lang = np.array([xxhash.xxh64_intdigest(x, 1) for x in self.langs.to_pylist()], np.uint64)
        return (word[self.code], lang[self.lang]) if len(word) else (np.empty(0, np.uint64),) * 2

    def runs(self, filters: list[Sketch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For 2, 3, .. words: which words start such a run in a piece, and its hash (meaningless elsewhere).

        Of the sizes that have a filter only runs that pass it; longer ones only if their shorter parts have passed.
        """
        word, key = self._hashes()
        key = mix(word + key)
        n, size, good = len(word), 1, np.ones(len(word), bool)
        while True:
            good = np.r_[good[:-1] & good[1:], False][:n] & (self.follows if size == 1 else True)
            size += 1
            tail = np.zeros(n, np.uint64)
            tail[: max(0, n - size + 1)] = word[size - 1 :]
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) ^ tail)
            if size - 2 < len(filters):
                good = good.copy()
                good[good] = filters[size - 2].holds(key[good])
            yield good, key


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[_Slice]:
    for batch in batches:
        langs = batch.column("lang")
        for lo, hi, data, bounds in slices(batch.column("text"), SLICE):
            yield _Slice(data, bounds, langs.slice(lo, hi - lo))


def _counted(size: int, filters: list):
    """Hashes of runs of ``size`` words whose shorter parts pass the filters, added up per slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [f.value for f in filters]
        for s in _slices(batches):
            good, key = next(islice(s.runs(known), size - 2, None))
            key, n = np.unique(key[good], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(n.astype(np.int64))], names=["key", "n"])

    return run


def _compact(x: np.ndarray) -> tuple[np.ndarray, int]:
    values, index = np.unique(x, return_inverse=True)
    return index.astype(np.int64), len(values)


def _windows(longest: int, filters: list):
    """Padded windows and how often each stands in a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [f.value for f in filters]
        for s in _slices(batches):
            columns = [s.code]
            for k, (good, _) in zip(range(1, longest), s.runs(known), strict=False):
                column = np.full(len(s.code), -1, np.int64)  # the lead column of k words on
                column[good] = s.code[np.flatnonzero(good) + k]
                columns.append(column)
            whole = s.lang
            for c in columns:  # a number for each distinct window, exact at every step
                whole, _ = _compact(whole * (len(s.words) + 1) + c + 1)
            _, first, count = np.unique(whole, return_index=True, return_counts=True)
            words = [pc.take(s.words, pa.array(c[first], mask=c[first] < 0)).cast(pa.string()) for c in columns]
            lang = pc.take(s.langs, pa.array(s.lang[first])).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [lang, *words, pa.array(count.astype(np.int64))], names=["lang", *_names(longest), "n"]
            )

    return run


def _names(longest: int) -> list[str]:
    return [f"w{i}" for i in range(1, longest + 1)]


def phrase_counts(documents: DataFrame, longest: int = 4, least: int = 30) -> DataFrame:
    """``lang, size, phrase, n``: phrases of up to ``longest`` words with ``least`` occurrences; size 0 is the language's words."""
    texts = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    filters: list = []
    for size in range(2, longest):
        runs = texts.mapInArrow(_counted(size, filters), "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
        filters.append(documents.sparkSession.sparkContext.broadcast(sketch(runs.filter(F.col("n") >= least))))
    names = _names(longest)
    schema = ", ".join(["lang string", *(f"{c} string" for c in names), "n long"])
    windows = texts.mapInArrow(_windows(longest, filters), schema)
    windows = windows.groupBy("lang", *names).agg(F.sum("n").alias("n"))
    sums = windows.rollup("lang", *names).agg(F.sum("n").alias("n"), F.grouping_id().alias("level"))
    size = F.lit(longest) - F.length(F.regexp_replace(F.bin("level"), "0", ""))  # columns of the prefix that are not summed
    sums = sums.withColumn("size", size.cast("int"))
    whole = F.element_at(F.array(F.lit("x"), *names), F.col("size") + 1).isNotNull()  # not padded
    kept = sums.filter((F.col("size") >= 0) & whole & ((F.col("size") == 0) | (F.col("n") >= least)))
    return kept.select("lang", "size", F.concat_ws(" ", *names).alias("phrase"), "n")


def _wide(column: str) -> Column:
    return F.col(column).cast("decimal(20,0)")


def collocations(documents: DataFrame, longest: int = 4, least: int = 30, share: int = 80, top: int = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of two words and more of each language."""
    counts = stored(phrase_counts(documents, longest, least), "phrases")
    parts = counts.filter("size > 0").select("lang", "phrase", "n")
    candidates = counts.filter("size > 1").select("lang", "size", "phrase", F.col("n").alias("a"))
    cuts = candidates.withColumn("cut", F.explode(F.expr("sequence(1, size - 1)")))
    cuts = cuts.withColumns(
        {"first": F.expr("substring_index(phrase, ' ', cut)"), "rest": F.expr("substring_index(phrase, ' ', cut - size)")}
    )
    left = parts.toDF("lang", "first", "l")
    right = parts.toDF("lang", "rest", "r")
    cuts = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    score = F.expr("(CAST(2000000 AS decimal(7,0)) * CAST(a AS decimal(20,0))) div (CAST(l AS decimal(20,0)) + CAST(r AS decimal(20,0)))")
    least_cut = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("c")
    scored = cuts.groupBy("lang", "size", "phrase", "a").agg(least_cut)
    # what stands inside a candidate, and the most occurrences of one that holds it
    spans = F.expr("flatten(transform(sequence(2, size - 1), k -> transform(sequence(1, size - k + 1), i -> array_join(slice(w, i, k), ' '))))")
    inside = candidates.filter("size > 2").withColumn("w", F.split("phrase", " ")).select("lang", "a", F.explode(spans).alias("phrase"))
    inside = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(inside, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (_wide("longer") * 100 < _wide("a") * share)
    )
    order = Window.partitionBy("lang").orderBy(F.desc("c.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    totals = counts.filter("size = 0").select("lang", "n")
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "c.l", "c.r", "n", "c.score")


#: Rows in DuckDB with the default options.
ORACLE = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
f AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS n
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) o(k)) GROUP BY 1, 2, 3),
total AS (SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY 1),
cand AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND n >= 30),
cut AS (SELECT *, unnest(range(1, k)) AS c FROM cand),
parts AS (
  SELECT cut.lang, cut.k, cut.phrase, cut.a, cut.c, x.n AS l, y.n AS r,
    CAST(2000000 * CAST(cut.a AS HUGEINT) // (CAST(x.n AS HUGEINT) + y.n) AS BIGINT) AS score
  FROM cut
  JOIN f x ON x.lang = cut.lang AND x.k = cut.c AND x.phrase = array_to_string(cut.w[1:cut.c], ' ')
  JOIN f y ON y.lang = cut.lang AND y.k = cut.k - cut.c AND y.phrase = array_to_string(cut.w[cut.c + 1:cut.k], ' ')),
low AS (SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
inside AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM cand, (VALUES (2), (3)) o(m) WHERE m < k) GROUP BY 1, 2),
kept AS (
  SELECT low.* FROM low LEFT JOIN inside USING (lang, phrase)
  WHERE longer IS NULL OR 100 * CAST(longer AS HUGEINT) < 80 * CAST(a AS HUGEINT))
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, total.n AS n, score
FROM kept JOIN total ON total.lang = kept.lang
QUALIFY rank <= 2000
"""
