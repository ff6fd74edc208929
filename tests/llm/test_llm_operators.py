"""Each operator against a plain version, over odd tables: nulls, empty and long texts, ties, repeats, extra columns."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from brute import groups, repeats, sha, tiled, words
from pyspark.sql import functions as F

from popscan.llm import (
    backoff_lm,
    block_anchors,
    chat_render,
    line_rules,
    line_templates,
    packed,
    partenum,
    piece_agenda,
    quality_convnet,
    queries,
    string_tiling,
    textual,
    warc_zstd,
)
from popscan.llm.components import merged

DOCS = "doc_id long, text string, lang string, source string, n_chars long, keys string, bucket int, key long, a long"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


def documents(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", "s", 0, "x", 1, 2, 3) for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(rows, DOCS)


def prose(rng, n):
    return " ".join(rng.choice(["ab", "cd", "efg", "hi", "Jk", "lm,", "no.", "é", "漢字"]) + rng.choice("xyzuvw") for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    base = [prose(rng, rng.randint(3, 90)) for _ in range(30)]
    w = base[3].split() + prose(rng, 50).split()
    near = [" ".join(w[:k] + ["changed"] + w[k + 1 :]) for k in range(0, 40, 7)]
    return [
        *base, None, "", "   ", "\n\n", base[2], base[2], *near, prose(rng, 5000), "one", "two words", "ONE",
        prose(rng, 20) + "\n" + base[5] + "\t" + base[5], "a b c", "A b\tc",
    ]


def test_words_are_split_and_hashed_as_bytes(texts):
    data = [(t or "").encode() for t in texts]
    bounds = np.concatenate(([0], np.cumsum([len(d) for d in data])))
    w = textual.words_of(np.frombuffer(b"".join(data), np.uint8), bounds)
    assert w.counts.tolist() == [len(words(t)) for t in texts]
    seen: dict = {}
    for t, h in zip((x for t in texts for x in words(t)), w.hash.tolist(), strict=True):
        assert seen.setdefault(t, h) == h
    assert len(set(seen.values())) == len(seen)
    at, gram = w.grams(3)
    want = [tuple(x[i : i + 3]) for x in map(words, texts) for i in range(len(x) - 2)]
    assert len(set(zip(want, gram.tolist(), strict=True))) == len(set(want)) == len(set(gram.tolist()))


def test_packed_keys_come_back():
    rng = np.random.default_rng(1)
    for keys in (np.empty(0, np.uint64), np.array([2**64 - 1], np.uint64), np.unique(rng.integers(0, 2**64, 999, np.uint64))):
        assert packed.decode(packed.encode(keys)).tolist() == keys.tolist()


@pytest.mark.parametrize("window", [4, 7, 35])
def test_repeated_windows(spark, texts, window):
    got = block_anchors.remove_repeats(documents(spark, texts), window).collect()
    want = repeats(texts, window)
    assert len(got) == len(texts)
    assert {r.doc_id: tuple(r)[1:] for r in got} == dict(enumerate(want))


def test_repeated_windows_of_equal_rows_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(40))
    got = block_anchors.remove_repeats(documents(spark, [text, text, text + " more"], [None, None, 4]), 35).collect()
    assert sorted((r.doc_id is None, r.n_words, r.n_removed) for r in got) == [(False, 41, 40), (True, 40, 40), (True, 40, 40)]
    assert block_anchors.remove_repeats(documents(spark, []), 35).collect() == []


@pytest.mark.parametrize(("n", "percent"), [(4, 85), (5, 80), (2, 60)])
def test_near_duplicates(spark, texts, n, percent):
    got = partenum.near_duplicates(documents(spark, texts), n, percent).collect()
    assert {r.doc_id: r.component_id for r in got} == groups(list(enumerate(texts)), n, percent)
    assert len(got) == len(texts)


def test_near_duplicates_of_an_empty_table_and_null_ids(spark):
    assert partenum.near_duplicates(documents(spark, [])).collect() == []
    got = partenum.near_duplicates(documents(spark, ["a b c d e", "a b c d e", "a b c d e"], [None, 7, 7])).collect()
    assert [r.component_id for r in got] == [7, 7, 7]
    kept = partenum.representatives(documents(spark, ["a b c d e", "a b c d e", None, "", None], [7, 7, 1, 2, None]))
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.select("doc_id").collect() if r.doc_id) == [(False, 1), (False, 2), (False, 7)]
    assert kept.count() == 4 and "bucket" in kept.columns


def test_signatures_of_linked_sets_meet():
    """Any two sets at the limit share a signature, however their differences fall."""
    rng, bands = np.random.default_rng(3), partenum.Bands(85)

    def signed(keys):
        sets = partenum.Sets.__new__(partenum.Sets)
        sets.key, sets.doc = np.sort(keys), np.zeros(len(keys), np.int64)
        sets.size, sets.first = np.array([len(keys)]), np.array([0, len(keys)])
        _, sig, short = partenum.signatures(sets, bands)
        return set(sig.tolist()), len(short)

    for size in [1, 2, 5, 6, 7, 9, 13, 20, 33, 70, 150, 400] * 12:
        shared = rng.integers(0, 2**64, size, np.uint64)
        most = int(size * 15 / 85)
        own = rng.integers(0, most + 1)
        a = np.concatenate((shared, rng.integers(0, 2**64, own, np.uint64)))
        b = np.concatenate((shared, rng.integers(0, 2**64, most - own, np.uint64)))
        (sa, short_a), (sb, short_b) = signed(a), signed(b)
        assert short_a or short_b or sa & sb


def test_short_sets_are_held_against_all(spark, monkeypatch):
    """With hardly any spare partitions, many sets lack non-empty ones; no link may be lost."""
    rng = random.Random(2)
    base = [prose(rng, 30) for _ in range(12)]
    rows = list(enumerate(base + [b + " tail" for b in base] + [" ".join(b.split()[:-1]) for b in base]))
    monkeypatch.setattr(partenum, "SPARE", 0)
    got = partenum.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == groups(rows, 4, 85)


def test_pieces_equal_the_library(spark, texts):
    odd = [*texts, "<s>[INST]</s>", "a  b   ", " \n lead", "\n", "▁▁ x▁", "😀\x00\t", "x" * 3000, " " * 70, "a\r\n\r\nb", "￿ ÿ"]
    got = piece_agenda.encode(documents(spark, odd), MODEL).collect()
    lib = piece_agenda.Pieces(MODEL).library
    for r in got:
        want = lib.encode(odd[r.doc_id] or "")
        assert (r.ids, r.decoded) == (want, lib.decode(want))
    digests = piece_agenda.encode(documents(spark, odd), MODEL, check="texts", digest=True).collect()
    assert all(r.n_tokens == len(lib.encode(odd[r.doc_id] or "")) for r in digests)
    assert piece_agenda.encode(documents(spark, []), MODEL).collect() == []
    ids = spark.createDataFrame([([3, 200, 201, 28705],), (None,), ([],)], "ids array<int>")
    assert [r.decoded for r in piece_agenda.decode(ids, MODEL).collect()] == [lib.decode([3, 200, 201, 28705]), None, ""]


def test_pieces_by_heap_and_by_arrays_agree():
    rng, pieces = random.Random(4), piece_agenda.Pieces(MODEL)
    chunks = ["▁" + "".join(rng.choice("abcdehinorst▁漢.,") for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    assert pieces.encode_chunks(chunks) == [pieces.encode_chunk(c) for c in chunks]


def test_pieces_met_again_outlast_a_full_memory():
    """What recurs is learned once, however many chunks come once; ids and texts stay those of the library."""
    coder, learned = piece_agenda.Encoder(MODEL, remembered=40), []
    learn, lib = coder.learn, coder.pieces.library
    coder.learn = lambda new: (learned.extend(new), learn(new))[1]
    for k in range(12):
        texts = [f"the cat w{k}x{i} sat\nthe cat" for i in range(9)] + ["", "a  b ", "漢\n\n"]
        for text, (ids, back) in zip(texts, coder.batch(texts), strict=True):
            want = lib.encode(text)
            assert (ids, back) == (",".join(map(str, want)), lib.decode(want))
    assert learned.count("cat") == 1 and learned.count("\nthe") == 1
    assert len(coder.known) <= 40
    few = piece_agenda.Encoder(MODEL, check="texts", remembered=3)  # a batch has more than is remembered
    assert [b for _, b in few.batch(["a b c d e", "c d f"])] == ["a b c d e", "c d f"]
    assert [b for _, b in few.batch(["x y a b"])] == ["x y a b"]


def test_tiles_equal_the_plain_tiling():
    rng = random.Random(3)
    names = textual.mix(np.arange(1, 5, dtype=np.uint64))
    for _ in range(400):
        a, b = ([rng.randrange(4) for _ in range(rng.randint(1, n))] for n in (14, 25))
        least = rng.randint(1, 4)
        assert sum(k for k, _, _ in string_tiling.tiles(names[a], names[b], least)) == tiled(a, b, least)


def test_contamination(spark):
    rng = random.Random(6)
    item, other = prose(rng, 40), prose(rng, 30)
    w = item.split()
    turned = " ".join(w[20:] + ["between"] + w[:20])
    texts = [None, "", prose(rng, 300), prose(rng, 50) + " " + item.upper(), turned, " ".join(w[:18]), item + " " + other, "tiny"]
    bench = spark.createDataFrame([(1, item), (2, other), (3, None), (4, ""), (5, "tiny"), (1, item)], "item_id long, text string")
    got = {r.doc_id: r for r in string_tiling.contamination(documents(spark, texts), bench).collect()}
    assert [got[i].contaminated for i in range(8)] == [False, False, False, True, True, False, True, True]
    assert got[6].n_items == 3 and got[6].item_id == 1 and got[7].item_id == 5
    none = string_tiling.contamination(documents(spark, texts), bench.filter("false")).collect()
    assert not any(r.contaminated for r in none) and len(none) == 8
    assert string_tiling.contamination(documents(spark, []), bench).collect() == []


def test_archives(spark, tmp_path):
    html = ["<p>a</p>", None, "", "<p>a</p>", "é" * 5000, "<p>a</p>", "z"]
    ids = [5, 3, 2, 1, 9, None, 9]
    pages = spark.createDataFrame(
        [(i, f"http://x/{i}\n", h, "extra", 0) for i, h in zip(ids, html, strict=True)],
        "page_id long, url string, html string, archive string, offset long",
    )
    folder = str(tmp_path / "w")
    index = warc_zstd.write_archives(warc_zstd.roles(pages), folder, archive_bytes=2000)
    index.write.parquet(str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    got = warc_zstd.read_archives(spark, folder, index).collect()
    assert len(got) == 7
    first = {"<p>a</p>": 1, "": 2}
    for r in got:
        if r.page_id in (9, None):
            continue
        body = html[ids.index(r.page_id)] or ""
        assert r.payload_bytes == len(body)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(body.encode()).digest()).decode()
        assert r.refers_to == (None if first[body] == r.page_id else first[body])
        assert (r.record_type == "response") == (first[body] == r.page_id)
        assert r.record_type == "revisit" or bytes(r.payload) == body.encode()
    assert [r.refers_to for r in got if r.page_id is None] == [1]
    for row in index.collect():  # each record alone, from its offset
        data = (tmp_path / "w" / row.archive).read_bytes()
        decoder, _ = warc_zstd.open_archive(data)
        record = decoder.decompress(data[row.offset : row.offset + row.length])
        assert f"<urn:x-page:{'' if row.page_id is None else row.page_id}>".encode() in record
        assert data[:4] == b"\x5d\x2a\x4d\x18"
    assert warc_zstd.write_archives(warc_zstd.roles(pages.filter("false")), folder).collect() == []


def test_archives_below_the_least_size_are_all_responses(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], "page_id long, url string, html string")
    assert {r.page_id: r.refers_to for r in warc_zstd.roles(pages, 3).collect()} == {1: None, 2: None, 3: None, 4: 3}


def test_chat_comes_back(spark):
    rng = random.Random(7)
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "<\\s>", "[\\\\/INST]", "<", "[", "a", "\n", "é", "]", "/"]
    rows, want = [], {}
    for c in range(40):
        turns = [(rng.choice(["user", "assistant", "system", "[INST]", ""]), "".join(rng.choices(bits, k=rng.randint(0, 12)))) for _ in range(rng.randint(1, 9))]
        want[c] = turns
        rows += [(c, t, r or None, x or None, "extra") for t, (r, x) in enumerate(turns)]
    long = [("user" if k % 2 == 0 else "assistant", f"turn {k}") for k in range(500)]
    want[99] = long
    rows += [(99, t, r, x, "extra") for t, (r, x) in enumerate(long)]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, piece string")
    formatted = chat_render.render(table, block=16)
    got = {r.conv_id: r for r in chat_render.read_back(formatted).collect()}
    for c, turns in want.items():
        masked = "".join(x for r, x in turns if r == "assistant")
        assert got[c].n_turns == len(turns) and got[c].rewrites == 0
        assert got[c].turns_sha256 == sha("".join(f"{r}\n{x}\n" for r, x in turns))
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(masked), sha(masked))
        assert got[c].formatted_chars == len(chat_render.Marks()(turns))
    assert chat_render.read_back(chat_render.render(table.filter("false"))).collect() == []


def test_templates_that_rewrite_history_are_found(spark):
    def forgetful(turns):
        return "".join(f"<{r}>{t if k == len(turns) - 1 else '…'}" for k, (r, t) in enumerate(turns))

    table = spark.createDataFrame([(1, 0, "user", "hello"), (1, 1, "assistant", "you")], "conv_id long, turn long, role string, text string")
    got = {r.turn: r for r in chat_render.render(table, forgetful).collect()}
    assert got[0].rewritten_from is None and got[1].rewritten_from == len("<user>")


def test_rewritten_history_is_found_at_any_length(spark):
    def headed(turns):
        return f"[{len(turns) // 150}]" + "".join(f"<{r}>{t}" for r, t in turns)

    rows = [(1, k, "user", f"turn {k}") for k in range(200)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.turn: r for r in chat_render.render(table, headed).collect()}
    assert [k for k in range(200) if got[k].rewritten_from is not None] == [149]
    assert got[149].rewritten_from == 1 and got[149].start == 1
    assert got[199].end == len(headed([(r, t) for _, _, r, t in rows]))


def test_classifier_learns_and_scores_empty_texts(spark):
    rng = random.Random(8)
    good = [prose(rng, rng.randint(20, 200)) for _ in range(150)]
    bad = [" ".join(x + "%%%" for x in prose(rng, rng.randint(20, 200)).split()) for _ in range(60)]
    texts = good + bad
    labels = spark.createDataFrame([(i, int(i < 150), 0) for i in range(210)] + [(None, 1, 0), (4, None, 0)], "doc_id long, quality int, toxic int")
    docs = documents(spark, texts)
    net = quality_convnet.train(docs, labels.filter("doc_id % 3 <> 0 OR doc_id IS NULL"), max_documents=400)
    odd = documents(spark, [*texts, None, "", "x" * 300_000], [*range(210), 900, None, 901]).withColumn("score", F.lit("clash"))
    got = quality_convnet.score(odd, net).collect()
    held = [r for r in got if r.doc_id is not None and r.doc_id < 210 and r.doc_id % 3 == 0]
    assert sum((r.score >= 0.3) == (r.doc_id < 150) for r in held) >= 0.95 * len(held)
    empty = {r.score for r in got if r.doc_id is None or r.doc_id == 900}
    assert len(empty) == 1 and all(0 <= r.score <= 1 for r in got) and len(got) == 213
    assert quality_convnet.score(documents(spark, []), net).collect() == []
    lone = quality_convnet.train(docs, labels.filter("doc_id < 10"))
    assert {round(r.score, 3) for r in quality_convnet.score(docs, lone).collect()} == {0.999}


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(2)
    net = quality_convnet.Network(rng.normal(0, 0.3, (6, 256, 3)).astype(np.float64), rng.normal(0, 0.5, 6), 0.1)
    texts = [bytes(rng.integers(97, 101, n, np.uint8)) for n in (5, 130, 400)]
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    laid = quality_convnet._lay(np.frombuffer(b"".join(texts), np.uint8), bounds)
    y, weight = np.array([1.0, 0.0, 1.0]), np.ones(3)

    def loss():
        p = 1 / (1 + np.exp(-quality_convnet._forward(net, laid, quality_convnet._pairs(net.taps))))
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    taps, weights, _ = quality_convnet._gradients(net, laid, y, weight)
    for where in [(0, 98, 1), (3, 99, 0), (5, 97, 2)]:
        was = net.taps[where]
        net.taps[where] = was + 1e-2
        up = loss()
        net.taps[where] = was - 1e-2
        down = loss()
        net.taps[where] = was
        assert taps[where] == pytest.approx((up - down) / 2e-2, rel=0.15, abs=2e-3)
    assert np.isfinite(weights).all()


def test_backoff_scores(spark):
    texts = ["a b a b a", None, "", "b a", "z", "a b a b a"]
    got = {r.doc_id: r for r in backoff_lm.score(documents(spark, texts)).collect()}
    assert len(got) == 6 and got[1].n_words == 0 and got[2].log_score == 0
    n = 13
    one, two = {"a": 7, "b": 5, "z": 1}, {("a", "b"): 4, ("b", "a"): 5}
    want = np.log(one["b"] / n) + np.log(two["b", "a"] / one["b"])
    assert got[3].log_score == pytest.approx(want)
    assert got[4].log_score == pytest.approx(np.log(1 / n))
    three = {r.doc_id: r.log_score for r in backoff_lm.score(documents(spark, texts), order=3).collect()}
    assert three[3] == pytest.approx(want) and three[0] != pytest.approx(got[0].log_score)
    assert backoff_lm.score(documents(spark, [])).collect() == []
    counted = backoff_lm.count_table(documents(spark, texts)).collect()
    assert sum(r.n_grams for r in counted) == 5 and sum(r.occurrences for r in counted) == n + 9


def test_the_backoff_query_counts_three_word_runs(spark, tmp_path):
    docs = documents(spark, ["a b c a b c", "a b d", "c b c"])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.log_score for r in queries.op5_backoff_lm(spark, str(tmp_path)).collect()}
    one, two, n = {"a": 3, "b": 4, "c": 4, "d": 1}, {"ab": 3, "bc": 3}, 12
    back = np.log(0.4)
    a_b_d = np.log(one["a"] / n) + np.log(two["ab"] / one["a"]) + np.log(one["d"] / n) + 2 * back
    assert got[1] == pytest.approx(a_b_d, abs=1e-4)
    whole = np.log(one["a"] / n) + np.log(two["ab"] / one["a"]) + np.log(2 / two["ab"])  # a, b, then c after "a b"
    rest = np.log(one["a"] / n) + 2 * back + np.log(two["ab"] / one["a"]) + back + np.log(2 / two["ab"])
    assert got[0] == pytest.approx(whole + rest, abs=1e-4)


def test_backoff_scores_do_not_depend_on_blocks(spark):
    rng = random.Random(14)
    docs = documents(spark, [prose(rng, 40) for _ in range(60)] + ["again and again " * 200])
    one = {r.doc_id: r.log_score for r in backoff_lm.score(docs.coalesce(1), order=3).collect()}
    many = {r.doc_id: r.log_score for r in backoff_lm.score(docs.repartition(7), order=3).collect()}
    assert len(one) == 61 and many == pytest.approx(one)


def test_counts_survive_narrowing():
    x = np.array([1, 254, 255, 256, 70_000, 3])
    assert backoff_lm.widen(backoff_lm.narrow(x), 6).tolist() == x.tolist()


def test_quality_rules(spark):
    rng = random.Random(9)
    body = [prose(rng, 40) for _ in range(20)]
    boiler = "Accept all 24 cookies"
    texts = [f"{b}\n{boiler.replace('24', str(i))}" for i, b in enumerate(body)]
    texts += [None, "", "a b c d e " * 6, f"{boiler}\n{boiler}\nbut these ten words are a page of its own", "short"]
    got = {r.doc_id: r for r in line_rules.judge(documents(spark, texts), share=0.1).collect()}
    assert all(got[i].kept and got[i].n_removed_words == 4 and got[i].kept_text == body[i] for i in range(20))
    assert got[22].base_failed and got[22].n_repeat_words == 30 and got[20].n_words == 0 and not got[20].kept
    assert got[23].n_dup_lines == 1 and got[23].n_removed_words == 8 and got[23].kept
    assert not got[24].kept and got[24].base_failed
    same = line_rules.judge(documents(spark, [texts[0]] * 30, [None] * 30)).collect()
    assert len(same) == 30 and all(r.kept and r.n_removed_words == 0 for r in same)  # copies of one text count once
    assert line_rules.judge(documents(spark, [])).collect() == []


def test_copies_do_not_raise_the_limit_of_a_host(spark):
    rng = random.Random(13)
    body = [prose(rng, 40) for _ in range(10)]
    texts = [f"{b}\nAccept all cookies" for b in body] + [prose(rng, 40)] * 200
    got = {r.doc_id: r for r in line_rules.judge(documents(spark, texts), share=0.1).collect()}
    assert all(got[i].n_removed_words == 3 and got[i].kept_text == body[i] for i in range(10))
    assert all(got[i].n_removed_words == 0 for i in range(10, 210))


def test_texts_are_joined_for_the_kept_text_only(spark):
    """Who asks for numbers alone sends no text through the join of the verdicts."""
    footer = "one two  three 44\tfive"
    texts = [f"{footer}\nline {chr(97 + i)} of nine words {chr(97 + i)} that {chr(97 + i)} differs\n\n" + (f"ONE two three {i} five" if i else "") for i in range(9)]
    judged = line_rules.judge(documents(spark, [*texts, texts[3], None, ""]))
    join = judged.select("doc_id", "kept", "n_removed_words")._jdf.queryExecution().optimizedPlan()
    while "Join" not in join.nodeName():
        join = join.children().head()
    sent = join.children().head().output().mkString(" ")
    assert len(sent.split()) == 3 and "_row#" in sent and "text#" not in sent, sent  # the id, and the row's two keys
    for r in judged.collect():
        assert r.n_removed_words == r.n_words - len((r.kept_text or "").split()), r
    assert {r.n_removed_words for r in judged.collect()} == {0, 5, 10}


def test_recurring_templates(spark):
    rng = random.Random(10)
    texts = [f"{prose(rng, 30)}\nuser {i} logged in at {i}:{i}\nSeen by {prose(rng, 1)} near gate seven today" for i in range(12)]
    texts += [None, "", "alone in here\n\n  \n"]
    got = {r.doc_id: r for r in line_templates.drop_recurring(documents(spark, texts)).collect()}
    assert got[0].n_dropped == 0 and got[0].text == texts[0]  # the first keeps its lines
    assert all(got[i].n_dropped == 2 and got[i].text == texts[i].split("\n")[0] for i in range(1, 12))
    assert got[12].text is None and got[13].text == "" and got[14].text == texts[14]
    copies = line_templates.drop_recurring(documents(spark, [texts[0]] * 30)).collect()
    assert all(r.n_dropped == 0 for r in copies)
    assert line_templates.drop_recurring(documents(spark, [])).collect() == []


def test_recurring_templates_of_long_lines(spark):
    rng = random.Random(11)
    notice = " ".join(f"term{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(90))
    texts = [f"{prose(rng, 30)}\nSigned by {prose(rng, 1)} {notice}" for _ in range(12)]
    got = {r.doc_id: r for r in line_templates.drop_recurring(documents(spark, texts)).collect()}
    assert got[0].n_dropped == 0
    assert all(got[i].n_dropped == 1 and got[i].text == texts[i].split("\n")[0] for i in range(1, 12))


def test_recurring_templates_that_share_a_leaf(spark):
    """Three templates of one leaf, none with half of its lines, among lines that do not recur."""
    rng = random.Random(12)
    forms = ["the page {} was last seen by our staff in town", "the page {} cannot be shown here without a valid key", "the page {} moved away for good please follow that link"]
    texts = [f"{prose(rng, 30)}\n{forms[i % 3].format(prose(rng, 1) + chr(97 + i % 26))}" for i in range(39)]
    texts += [f"{prose(rng, 30)}\nthe page {prose(rng, 9)}" for _ in range(40)]
    got = {r.doc_id: r for r in line_templates.drop_recurring(documents(spark, texts)).collect()}
    assert [i for i in range(79) if got[i].n_dropped] == list(range(3, 39))
    assert all(got[i].text == texts[i].split("\n")[0] for i in range(3, 39))


def test_lines_are_read_and_masked_once(spark):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    docs = documents(spark, [f"build {i} of this page\nno other line is like {chr(97 + i)}" for i in range(14)])
    seen = docs.mapInArrow(counted, docs.schema)
    assert line_templates.recurring(seen).count() == 26  # both lines are templates, and the first document keeps its own
    assert read.value == 14


def test_groups_without_enough_frequent_places_are_not_looked_at(spark):
    rows = [(1, "a b c d e".split()), (2, "a b f g h".split()), (2, "a b i j k".split())]
    lines = spark.createDataFrame(rows, "group long, words array<string>")
    weights = [(1, 0, "a", 9), (1, 1, "b", 9), (1, 4, "e", 5), (2, 0, "a", 9), (2, 1, "b", 5), (2, 1, "c", 5)]
    weights = spark.createDataFrame(weights, "group long, place int, word string, s long")
    assert [r.group for r in line_templates._hopeful(lines, weights, 0.6).collect()] == [1]
    assert sorted(r.group for r in line_templates._hopeful(lines, weights, 0.4).collect()) == [1, 2]


def test_links_that_come_later_merge_components(spark):
    rng = random.Random(5)
    given = [[(rng.randrange(60), rng.randrange(60)) for _ in range(k)] for k in (25, 1, 12)]
    labels, root = None, {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for links in ([*given[0]], [], given[1], [(7, 7), (99, 99)], given[2]):
        labels = merged(labels, spark.createDataFrame(links, "a long, b long"))
        for a, b in links:
            low, high = sorted((top(a), top(b)))
            root[high] = low
        linked = {r.node: r.component for r in labels.collect()}
        assert linked == {x: top(x) for x in linked} and {x for x in root if top(x) != x} <= set(linked)
