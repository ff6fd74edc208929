"""Quality rules over words and over lines that recur across a host's documents, in DataFrame functions only.

Per document: words, their characters, symbols, lines that repeat an earlier line, words inside five-word windows that
stand twice. Across documents: every line with a word is normalised (A-Z lowered, digit runs as ``0``, spaces joined)
and hashed; per host the distinct documents with a line are counted, copies of one text once. Lines found in at least
``min_docs`` documents and in ``share`` of the host's, copies again once, are removed, and a document of whose words less than ``left``
remain is rejected, as is one that fails the base rules.

Lines are normalised, hashed and their words counted once and kept as a table; texts go through a join for ``kept_text``
only. Each document's distinct lines are counted before anything is shuffled, counts are summed map-side, and the lines
that remain to be removed join back on (host, line), salted sixteen-fold so that a line of a third of all documents is
spread.

Defined results: null and empty texts have no words, fail the base rules and keep zeros; null hosts are one host;
rows that repeat (id, text and host) are judged alike, one text on two hosts by each host's lines; ids may be null or
repeat; an empty table gives no row; texts of any length are one row; columns of the result's names are replaced, all
others pass, whatever they are called. Limits are shares and floors, with the same meaning at any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from popscan.llm.storage import stored

WORD = r"[^\x20\x09-\x0D]+"  # fixed value: a word
SYMBOLS = r"[#*$%&|<>]"  # fixed value: symbols counted
SALT = 16


def normalised(line: Column) -> Column:
    low = F.translate(line, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.trim(F.regexp_replace(F.regexp_replace(low, "[0-9]+", "0"), r"[\x20\x09-\x0D]+", " "))


def base_columns(documents: DataFrame, window: int = 5) -> DataFrame:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` and ``base_failed`` of each document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    df = documents.withColumns(
        {
            "_w": F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1)),
            "_l": F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)),
        }
    )
    n = F.size("_w")
    at = F.when(n >= window, F.sequence(F.lit(0), n - window)).otherwise(F.array().cast("array<int>"))
    df = df.withColumn("_n", n).withColumn(
        "_h", F.transform(at, lambda i: F.xxhash64(*[F.get("_w", i + k) for k in range(window)]))
    )
    twice = F.size(F.array_distinct("_h")) < F.size("_h")
    pair = F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    df = df.withColumn("_s", F.when(twice, F.sort_array(pair)).otherwise(F.slice(pair, 1, 0)))
    same = lambda s, j: F.coalesce(F.get("_s", j)["h"] == s["h"], F.lit(False))
    places = F.filter(
        F.transform("_s", lambda s, j: F.when(same(s, j - 1) | same(s, j + 1), s["i"])), lambda i: i.isNotNull()
    )
    df = df.withColumn("_p", F.sort_array(places))
    covered = F.transform("_p", lambda p, j: F.least(F.lit(window), F.coalesce(F.get("_p", j + 1) - p, F.lit(window))))
    total = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda a, x: a + x)
    df = df.withColumns(
        {
            "n_words": F.col("_n").cast("long"),
            "word_chars": total(F.transform("_w", lambda x: F.length(x))),
            "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
            "n_repeat_words": total(covered),
        }
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return df.withColumn("base_failed", failed).drop("_w", "_l", "_n", "_h", "_s", "_p")


def row_key(*columns: str) -> list[Column]:
    """``_id, _row``: what tells rows apart; rows that agree in the id and all ``columns`` are one."""
    return [
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"),
        F.xxhash64(F.col("doc_id").isNull(), *columns).alias("_row"),
    ]


def without_lines(text: Column | str, gone: str) -> Column:
    """``text`` without the lines at the positions in ``gone`` (an array, null for none)."""
    text = F.col(text) if isinstance(text, str) else text
    left = F.filter(F.split(text, "\n"), lambda t, i: ~F.array_contains(gone, i))
    return F.when(F.col(gone).isNull(), text).otherwise(F.array_join(left, "\n"))


def hashed_lines(documents: DataFrame) -> DataFrame:
    """``_id, _row, _host, _content, _lines, _counts``: hashes of each document's normalised lines, null for lines without a
    word, and the words of each line."""
    lines = F.split("text", "\n")
    hashed = F.transform(lines, lambda t: F.when(t.rlike(WORD), F.xxhash64(normalised(t))))
    counts = F.transform(lines, lambda t: F.regexp_count(t, F.lit(WORD)))
    return documents.select(
        *row_key("text", "_host"), "_host", F.xxhash64("text").alias("_content"), hashed.alias("_lines"),
        counts.alias("_counts"),
    )


def frequent_lines(hashed: DataFrame, min_docs: int, share: float) -> DataFrame:
    """``_host, _line``: hashes of the lines above the limits of their host, from :func:`hashed_lines`."""
    hosts = hashed.select("_host", "_content").distinct().groupBy("_host").agg(F.count(F.lit(1)).alias("_docs"))
    lines = hashed.select("_host", "_content", F.explode(F.array_distinct("_lines")).alias("_line")).dropna(subset=["_line"])
    counted = (
        lines.distinct().groupBy("_host", "_line").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_docs)
    )
    return counted.join(hosts, "_host").filter(F.col("_n") >= F.col("_docs") * share).select("_host", "_line")


def judge(
    documents: DataFrame, host: str = "source", min_docs: int = 8, share: float = 0.002, left: float = 0.3
) -> DataFrame:
    """``documents`` with the base columns, ``n_removed_words``, ``kept`` and ``kept_text``, its lines below the limits."""
    names = ["kept_text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "n_removed_words", "kept"]
    documents = documents.drop(*names)
    # the input's columns travel under names of their own, so none of ours can clash with them; one by one, as what is not
    # asked for then stays behind
    own = [f"_in_{i}" for i in range(len(documents.columns))]
    host_of = F.coalesce(F.col(host).cast("string"), F.lit(""))
    held = documents.select("*", F.col("doc_id"), F.col("text"), host_of).toDF(*own, "doc_id", "text", "_host")
    hashed = stored(hashed_lines(held), "line-hashes")
    frequent = frequent_lines(hashed, min_docs, share).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long")))
    )
    lines = hashed.select("_id", "_row", "_host", F.posexplode(F.arrays_zip("_lines", "_counts")).alias("_pos", "_l"))
    lines = lines.select("_id", "_row", "_host", "_pos", F.col("_l._lines").alias("_line"), F.col("_l._counts").alias("_n"))
    # rows that repeat send the same positions, which are one in the set
    gone = (
        lines.dropna(subset=["_line"])
        .withColumn("_salt", F.pmod(F.col("_row"), F.lit(SALT)))
        .join(frequent, ["_host", "_line", "_salt"])
        .groupBy("_id", "_row")
        .agg(F.collect_set(F.struct("_pos", "_n")).alias("_cut"))
        .select(
            "_id", "_row", F.transform("_cut", lambda x: x["_pos"]).alias("_gone"),
            F.aggregate("_cut", F.lit(0).cast("long"), lambda total, x: total + x["_n"]).alias("_removed"),
        )
    )
    base = base_columns(held.select("text", *row_key("text", "_host"))).drop("text").dropDuplicates(["_id", "_row"])
    # a table, so that a later filter is not pushed into the word-level expressions and has them computed twice over
    verdicts = stored(base.join(gone, ["_id", "_row"], "left"), "verdicts")
    keyed = held.select(*own, "text", *row_key("text", "_host"))
    joined = keyed.join(verdicts, ["_id", "_row"]).withColumn("kept_text", without_lines("text", "_gone"))
    # counted by line, so that who asks for numbers alone does not send the texts through the join
    joined = joined.withColumn("n_removed_words", F.coalesce("_removed", F.lit(0).cast("long")))
    enough = F.col("n_words") - F.col("n_removed_words") >= left * F.col("n_words")
    columns = [F.col(o).alias(c) for o, c in zip(own, documents.columns, strict=True)]
    return joined.withColumn("kept", ~F.col("base_failed") & enough).select(*columns, *names)


#: The query's rows in DuckDB, limits as :func:`judge` has them by default.
ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, host, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
line AS (
  SELECT doc_id, host, md5(text) AS content, pos, line,
    trim(regexp_replace(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[0-9]+', '0', 'g'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS norm,
    len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS k
  FROM (SELECT doc_id, host, text, unnest(string_split(text, chr(10))) AS line,
          generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
frequent AS (
  SELECT host, norm FROM (SELECT host, norm, count(DISTINCT content) AS n FROM line GROUP BY 1, 2)
  JOIN (SELECT host, count(DISTINCT md5(text)) AS docs FROM d GROUP BY 1) USING (host) WHERE n >= 8 AND n >= docs * 0.002),
gone AS (SELECT doc_id, sum(k) AS removed FROM line JOIN frequent USING (host, norm) GROUP BY 1),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM line GROUP BY 1),
win AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
cov AS (
  SELECT doc_id, sum(least(5, coalesce(nxt - i, 5))) AS n_repeat_words
  FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM rep) GROUP BY 1),
base AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(removed, 0) AS BIGINT) AS n_removed_words
  FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN cov USING (doc_id) LEFT JOIN gone USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_words - n_removed_words >= 0.3 * n_words AS kept
FROM base
"""
