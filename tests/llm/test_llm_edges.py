"""Edge cases of operators and pipeline stages: empty tables, clashing columns, null and repeated ids."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from brute import words
from pyspark.sql import functions as F

import corpus_pipeline
from popscan.llm import backoff_lm, line_rules, line_templates, packed, partenum, queries, string_tiling, warc_zstd
from popscan.llm.storage import shared_folder, stored
from popscan.llm.textual import raw, words_of

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASHES = "'x' AS _row, 1 AS _gone, 'y' AS _id, 2L AS _text, 'h' AS _host, 3 AS _lines, 4 AS _in, 5 AS id, 'b' AS line, 6 AS sig"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)


def prose(rng, n):
    return " ".join(rng.choice("abcdefgh") + rng.choice("xyzuvw") + str(rng.randint(0, 3)) * rng.randint(0, 1) for _ in range(n))


@pytest.fixture(scope="module")
def some(spark):
    rng = random.Random(9)
    footer = "Read more about our cookies here\n"
    rows = [(i, footer + "\n".join(prose(rng, 12) for _ in range(4)), f"host{i % 2}") for i in range(24)]
    rows += [(None, rows[3][1], "host0"), (None, rows[3][1], "host1"), (5, rows[5][1], "host1"), (7, None, None), (8, "", "host0"), (9, rows[9][1], "host1")]
    return rows


def same(a, b):
    return sorted(map(repr, a)) == sorted(map(repr, b))


@pytest.mark.parametrize(
    "operator",
    [
        lambda df: line_rules.judge(df, min_docs=4, share=0.1),
        lambda df: line_templates.drop_recurring(df, min_docs=4),
        lambda df: partenum.representatives(df, 3, 80),
        lambda df: string_tiling.contamination(df, df.filter("doc_id < 4").selectExpr("doc_id AS item_id", "text")),
    ],
)
def test_columns_of_any_name_pass(spark, some, operator):
    plain = documents(spark, some)
    clashing = plain.selectExpr("*", *CLASHES.split(", "))
    got = operator(clashing)
    extra = [c.split(" AS ")[1] for c in CLASHES.split(", ")]
    want = operator(plain)
    assert [c for c in got.columns if c not in extra] == want.columns
    assert same([tuple(r) for r in got.select(*want.columns).collect()], [tuple(r) for r in want.collect()])
    assert {tuple(r) for r in got.select(*extra).distinct().collect()} == {("x", 1, "y", 2, "h", 3, 4, 5, "b", 6)}
    assert operator(clashing.limit(0)).collect() == []


def test_a_text_is_judged_by_the_lines_of_its_host(spark):
    """A copy on another host, where its lines do not recur, keeps them."""
    shared = "One line that stands everywhere\nAnother line of that kind"
    rng = random.Random(1)
    rows = [(i, shared + "\n" + prose(rng, 30), "a") for i in range(10)] + [(None, shared + "\n" + prose(rng, 30), "a")]
    copy = rows[-1][1]
    judged = line_rules.judge(documents(spark, [*rows, (None, copy, "b")]), min_docs=4, share=0.5)
    removed = {r.source: r.n_removed_words for r in judged.filter(F.col("text") == copy).collect()}
    assert removed == {"a": len(words(shared)), "b": 0}
    assert judged.filter("source = 'b'").first().kept_text == copy


def test_repeated_ids_with_other_texts(spark):
    rng = random.Random(2)
    line = "The same old line again"
    rows = [(i // 2, f"{line}\n{prose(rng, 20)}", "a") for i in range(24)]
    cut = line_templates.drop_recurring(documents(spark, rows), min_docs=4).collect()
    assert sorted(r.n_dropped for r in cut) == [0, 0] + [1] * 22  # both rows of the smallest id keep it
    assert all((line in r.text) == (r.n_dropped == 0) for r in cut)
    judged = line_rules.judge(documents(spark, rows), min_docs=4, share=0.5).collect()
    assert all(r.n_removed_words == 5 and line not in r.kept_text for r in judged)


def test_null_ids_and_repeats_are_one_pair(spark, monkeypatch):
    """Three hundred copies of a text and of a near copy are two classes: one pair is verified."""
    rng = random.Random(3)
    a = prose(rng, 60)
    b = a + " more"
    rows = [(None, a, "s")] * 300 + [(None, b, "s")] * 300 + [(4, a, "s")] * 3
    seen = []
    inner = partenum._linked

    def counting(n, percent):
        run = inner(n, percent)
        count = spark.sparkContext.accumulator(0)
        seen.append(count)

        def counted(batches):
            def tapped():
                for x in batches:
                    count.add(x.num_rows)
                    yield x

            yield from run(tapped())

        return counted

    monkeypatch.setattr(partenum, "_linked", counting)
    got = partenum.near_duplicates(documents(spark, rows), 4, 80).collect()
    assert {r.component_id for r in got} == {4} and len(got) == 603
    assert sum(c.value for c in seen) == 1


def test_no_pages_no_archive(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    index = stored(warc_zstd.write_archives(warc_zstd.roles(pages), str(tmp_path / "none")), "index")
    assert warc_zstd.read_archives(spark, str(tmp_path / "none"), index).collect() == []


def test_pages_that_repeat_their_id(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "one"), (1, "v", "two"), (2, "w", "two"), (1, "u", "one")], "page_id long, url string, html string")
    index = stored(warc_zstd.write_archives(warc_zstd.roles(pages), str(tmp_path / "a")), "index")
    got = warc_zstd.read_archives(spark, str(tmp_path / "a"), index).collect()
    assert sorted((r.page_id, bytes(r.payload or b"").decode(), r.record_type) for r in got) == [
        (1, "one", "response"), (1, "one", "response"), (1, "two", "response"), (2, "", "revisit"),
    ]


def test_repeated_items_count_once_each(spark):
    rng = random.Random(6)
    item = prose(rng, 20)
    docs = documents(spark, [(1, prose(rng, 30) + " " + item, "a"), (2, prose(rng, 40), "a")])
    benchmark = spark.createDataFrame([(7, item)] * 40 + [(9, prose(rng, 2000))], "item_id long, text string")
    got = {r.doc_id: (r.contaminated, r.item_id, r.n_items) for r in string_tiling.contamination(docs, benchmark).collect()}
    assert got == {1: (True, 7, 40), 2: (False, None, 0)}


def test_a_cluster_must_name_its_shared_folder(spark):
    class Elsewhere:
        conf = {"spark.master": "spark://host:7077"}

    with pytest.raises(ValueError):
        shared_folder(Elsewhere)


# ---- the pipeline, stage by stage


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


SF = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark, corpus):
    """Each stage against its operator or a plain rule, on what its predecessor kept."""
    docs = corpus
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "line_dedup", "near_duplicates", "decontamination", "tokens"]
    judged = {r.doc_id: r for r in line_rules.judge(docs).collect()}
    after = stored(stages["quality_rules"](spark, docs, SF), "stage")
    assert after.columns == docs.columns
    assert {(r.doc_id, r.text, r.n_chars) for r in after.collect()} == {
        (i, r.kept_text, len(r.kept_text)) for i, r in judged.items() if r.kept
    }
    docs, before = after, {r.doc_id: r.text for r in after.collect()}
    after = stored(stages["line_dedup"](spark, docs, SF), "stage")
    for r in after.collect():  # lines go whole, in order, and nothing else does
        left = iter(before[r.doc_id].split("\n"))
        assert all(any(line == x for x in left) for line in r.text.split("\n")) or r.text == ""
        assert r.n_chars == len(r.text)
    assert after.count() == len(before)
    docs, before = after, {r.doc_id: r.text for r in after.collect()}
    from brute import groups

    after = stored(stages["near_duplicates"](spark, docs, SF), "stage")
    top = groups(sorted(before.items()), 5, 80)
    assert {r.doc_id for r in after.collect()} == {i for i in top if top[i] == i}
    docs, before = after, {r.doc_id: r.text for r in after.collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    after = stored(stages["decontamination"](spark, docs, SF), "stage")
    held = {
        i for i, t in before.items()
        if any(
            string_tiling.coverage(a, b, 4) >= 0.6
            for a, b in (string_tiling.word_hashes([x, t]) for _, x in items) if len(a)
        )
    }
    assert {r.doc_id for r in after.collect()} == set(before) - held
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.PIECES))
    kept = {r.doc_id: r.text for r in after.collect()}
    ids = {r.doc_id: list(r.ids) for r in stages["tokens"](spark, after, SF).collect()}
    assert ids == {i: model.encode(t) for i, t in kept.items()}


def test_run_is_its_stages(spark, corpus):
    got = corpus_pipeline.run(spark, SF)
    docs = corpus
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert same([tuple(r) for r in got.collect()], [tuple(r) for r in docs.collect()])


def test_stages_of_an_empty_table(spark, corpus):
    docs = corpus.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, SF), name)
        assert out.count() == 0
        docs = out if name != "tokens" else docs


# ---- what grows with the input


def test_words_of_groups_without_a_template_are_counted_once(spark, monkeypatch):
    """Two leaves of a common start: the lines of one agree, those of the other do not."""
    lines = [f"open the door named {chr(97 + i) * 2} please sir" for i in range(12)]
    lines += ["close the " + " ".join(chr(97 + i) * k for k in (2, 3, 4, 5)) for i in range(12)]
    rows = [(i, t, "h") for i, t in enumerate(lines)]
    looked, weights = [], line_templates._weights
    monkeypatch.setattr(line_templates, "_weights", lambda df: looked.append(df.count()) or weights(df))
    cut = line_templates.drop_recurring(documents(spark, rows), min_docs=10).collect()
    assert sorted(r.doc_id for r in cut if r.n_dropped) == list(range(1, 12))
    assert looked == [24, 0]


def test_templates_behind_a_template_of_their_leaf(spark):
    """A leaf whose vote gives a template, and whose other lines hold one more."""
    one = [f"see the same words of this line {i}x" for i in range(20)]
    two = [f"see the quite other text which came {i}x" for i in range(11)]
    rows = [(i, t, "h") for i, t in enumerate([*one, *two, "see the sole one that none has got"])]
    cut = {r.doc_id: r.n_dropped for r in line_templates.drop_recurring(documents(spark, rows), min_docs=10).collect()}
    assert sorted(i for i, n in cut.items() if n) == [*range(1, 20), *range(21, 31)]


def test_parity_tells_large_sets_apart(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(map(str, rng.integers(0, 10**6, n))) for n in (3, 40, 3000, 4000, 6000, 12000)]
    texts.append(texts[3] + " one word more")
    sets = partenum.Sets(words_of(*raw(pa.array(texts)), fold=True), 5)
    vectors = sets.parities(80)
    every = np.arange(len(texts))
    apart = partenum.Parities(vectors).apart(every, every)
    own = [set(sets.key[a:b].tolist()) for a, b in zip(sets.first, sets.first[1:], strict=False)]
    assert all(apart[i, j] <= len(own[i] ^ own[j]) for i in every for j in every)
    most = 20 * (sets.size[:, None] + sets.size[None, :]) // 180
    linked = {(i, j) for i in every for j in every if i != j and apart[i, j] <= most[i, j] and max(i, j) > 2 and min(i, j) > 1}
    assert {(3, 6), (6, 3)} <= linked and not {(2, 3), (3, 4), (4, 6)} & linked
    pairs = spark.createDataFrame([(int(i), int(j), vectors[i].as_py(), vectors[j].as_py()) for i in every for j in every], "i int, j int, a array<long>, b array<long>")
    assert all(r.x == apart[r.i, r.j] for r in pairs.select("i", "j", partenum._apart("a", "b").alias("x")).collect())


def test_only_texts_of_remaining_pairs_are_fetched(spark, monkeypatch):
    """Forty texts share signatures by a common passage, and parity rules all of them out: none of them is sent."""
    rng, inner, sent = random.Random(6), partenum.stored, {}
    passage = " ".join(f"p{i}" for i in range(20))
    rows = [(i, f"{passage} " + " ".join(f"w{rng.randrange(10**9)}" for _ in range(5)), "s") for i in range(40)]
    near = " ".join(f"n{i}" for i in range(60))
    rows += [(40, near, "s"), (41, near + " more", "s")]

    def counting(df, name, *args):
        out = inner(df, name, *args)
        if "text" in out.columns:
            sent.setdefault(name, []).append(out.count())
        if name == "groups":
            sent[name] = [out.select("set_key").distinct().count()]
        return out

    monkeypatch.setattr(partenum, "stored", counting)
    got = {r.doc_id: r.component_id for r in partenum.near_duplicates(documents(spark, rows), 4, 85).collect()}
    assert got == {**{i: i for i in range(41)}, 41: 40}
    assert sent.pop("groups")[0] > 20  # sets that share a signature
    assert sum(sum(counts) for counts in sent.values()) == 2


def test_backoff_texts_stay_where_their_blocks_are(spark):
    df = backoff_lm.score(documents(spark, [(i, f"a b c d{i % 3}", "h") for i in range(9)]).select("doc_id", "text"), order=3)
    assert df.count() == 9
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("Initial Plan")[0]
    assert "Exchange hashpartitioning(block" in final
    assert not [x for x in final.splitlines() if "Exchange" in x and "texts" in x]
    assert final.count("Exchange hashpartitioning(block") == 1, plan
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("popscan_stored")]


def test_packed_gaps_compress():
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 1 << 49, 1 << 17, dtype=np.uint64))
    keys = keys[np.r_[True, np.diff(keys) > 0]]
    blob = packed.encode(keys)
    assert (packed.decode(blob) == keys).all()
    wide = np.r_[keys, keys[-1] + np.uint64(1 << 33)]  # one wide gap
    assert (packed.decode(packed.encode(wide)) == wide).all()
    assert len(pa.compress(packed.encode(wide), codec="lz4")) < 4.6 * len(wide)
    assert (packed.decode(packed.encode(keys[:1])) == keys[:1]).all()
