"""Substring removal by suffix sort against a plain version."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from popscan.llm import suffix_merge

DOCS = "doc_id long, text string, h long, row long, key string, start int, gone string, kept int"


def plain(rows, length):
    """``doc_id, kept, spans`` of each row."""
    least = {}
    for i, t in rows:
        data = (t or "").encode()
        for p in range(len(data) - length + 1):
            w = data[p : p + length]
            if i is not None and least.get(w, i) >= i:
                least[w] = i
    out = []
    for i, t in rows:
        data = (t or "").encode()
        gone = [False] * len(data)
        for p in range(len(data) - length + 1):
            if i is not None and least[data[p : p + length]] < i:
                gone[p : p + length] = [True] * length
        edges = [p for p in range(len(data) + 1) if (p < len(data) and gone[p]) != (p > 0 and gone[p - 1])]
        spans = tuple(zip(edges[::2], edges[1::2], strict=True))
        out.append((i, bytes(b for b, g in zip(data, gone, strict=True) if not g), spans))
    return sorted(out, key=repr)


def got(df, *args, **kw):
    rows = suffix_merge.remove_repeats(df, *args, **kw).collect()
    return sorted(((r.doc_id, bytes(r.kept), tuple((s.start, s.end) for s in r.spans)) for r in rows), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeé漢 ") for _ in range(rng.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(rng.randint(4, 25)) for _ in range(8)]
    out = []
    for i in range(120):
        parts = [prose(rng.randint(0, 20))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            parts += [p[a : a + rng.randint(10, 200)], prose(rng.randint(0, 6))]
        out.append((i * 3, rng.choice(["", " "]).join(parts)))
    whole = out[5][1] + passages[0]
    out += [(400, whole), (401, whole), (402, whole + " tail"), (7, whole), (401, whole), (401, passages[1]), (403, "x" + whole[1:])]
    out += [(None, whole), (None, None), (410, None), (411, ""), (412, "short"), (413, "a" * 300), (414, "a" * 90), (415, "ab" * 100)]
    out += [(416, passages[2] + passages[2]), (417, prose(4000) + passages[3]), (418, "\n".join(["the same line"] * 40)), (419, "\n".join(["the same line"] * 30))]
    rng.shuffle(out)
    return out


@pytest.fixture(scope="module")
def table(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.selectExpr("*", "1L AS h", "2L AS row", "'k' AS key", "3 AS start", "'g' AS gone", "4 AS kept").repartition(6)


@pytest.mark.parametrize(("length", "gram"), [(50, 16), (20, 5), (9, 9), (30, 1)])
def test_repeats_removed(table, rows, length, gram):
    want = plain(rows, length)
    assert got(table, length, gram) == want
    assert any(s for _, _, s in want)


def test_large_buckets_are_split(table, rows):
    assert got(table, 40, 8, largest_bucket=3) == plain(rows, 40)


def test_pieces_of_any_size(table, rows, monkeypatch):
    """Small pieces, batches and chunks change nothing; the functions are called in this process."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 99, 40).astype(np.uint8)) for _ in range(30)] * 4 + [b"a" * 60] * 50
    start = rng.integers(0, 9, len(texts))
    contexts = sorted((0, t[: 14 + s % 5], int(d), 5, int(s)) for t, s, d in zip(texts, start, rng.integers(0, 40, len(texts))))
    columns = [pa.array([c[k] for c in contexts], kind) for k, kind in enumerate((pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()))]
    whole = pa.table(columns, names=["key", "context", "doc_id", "h", "start"])

    def removed():
        b = suffix_merge._judge(whole, 10)
        return sorted(zip(*(b.column(i).to_pylist() for i in range(4))))

    want = removed()
    for piece, chunk in ((1, 1), (7, 3), (40, 1000)):
        monkeypatch.setattr(suffix_merge, "PIECE", piece)
        monkeypatch.setattr(suffix_merge, "_CONTEXTS", chunk)
        assert removed() == want


def test_a_full_filter_changes_nothing(table, rows, monkeypatch):
    from popscan.llm import sketch

    full = sketch.Sketch(np.full(1 << (sketch.LOG_BITS - 6), 2**64 - 1, np.uint64))
    monkeypatch.setattr(suffix_merge, "sketch", lambda *_: full)
    assert got(table, 25, 10) == plain(rows, 25)


def test_empty_table(table):
    assert got(table.limit(0), 50) == []


@pytest.mark.parametrize("length", [3, 8, 50])
@pytest.mark.parametrize("broken", [False, True])
def test_suffix_sort(length, broken):
    """Order and equality of suffixes, also where hashes lie."""
    rng = np.random.default_rng(length)
    text = rng.integers(97, 100, 3000).astype(np.uint8)
    text[1000:1400] = text[:400]
    text[2000:2200] = 97
    start = rng.permutation(len(text) - length)[:1500]
    group = np.sort(rng.integers(0, 6, len(start)) * 5)
    suffixes = suffix_merge.Suffixes(text, start, length)
    if broken:
        suffixes._hash = lambda at, size: size.astype(np.uint64)  # all substrings of a length look alike
    order, differs = suffixes.sort(group)
    content = [(int(group[i]), text[start[i] : start[i] + length].tobytes()) for i in range(len(start))]
    assert [content[i] for i in order] == sorted(content)
    ordered = sorted(content)
    assert differs.tolist() == [k == 0 or ordered[k] != ordered[k - 1] for k in range(len(ordered))]


def test_common_extensions():
    text = np.frombuffer(b"abcabcabdabcabcabd", np.uint8)
    s = suffix_merge.Suffixes(text, np.arange(len(text) - 6), 6)
    for a in range(10):
        for b in range(10):
            n = 0
            while n < 6 and text[a + n] == text[b + n]:
                n += 1
            assert s.common(np.array([a]), np.array([b]))[0] == n


def test_equal_windows_have_equal_anchors():
    rng = random.Random(2)
    part = bytes(rng.choice(b"abc ") for _ in range(400))
    texts = [part, b"zz" + part[30:300], part[100:160] + part[100:160], b"", b"aaaa" * 30]
    data, bounds = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])
    key, first, last = suffix_merge.anchors(data, bounds, 20, 6)
    of, windows = {}, 0
    for k, f, e in zip(key.tolist(), first.tolist(), last.tolist(), strict=True):
        for p in range(f, e + 1):
            windows += 1
            assert of.setdefault(data[p : p + 20].tobytes(), k) == k
    assert windows == sum(max(0, len(t) - 19) for t in texts)


def test_query_columns(spark):
    from popscan.llm import queries

    df = queries.op11_suffix_merge(spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    import hashlib

    want = {
        i: (len((t).encode()), sum(e - s for s, e in spans), len(spans), hashlib.sha256(kept).hexdigest())
        for (i, kept, spans), t in ((x, dict(map(tuple, docs))[x[0]] or "") for x in plain([tuple(d) for d in docs], 50))
    }
    assert {r[0]: tuple(r)[1:] for r in df.collect()} == want
    assert df.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def test_anchors_are_looked_for_in_small_pieces(monkeypatch):
    """However many rows a batch has, a task's working memory follows a few hundred of them."""
    rng, seen, anchors = random.Random(5), [], suffix_merge.anchors
    texts = ["".join(rng.choices("abcdef ", k=2000)) for _ in range(1500)]
    ids = pa.array(range(len(texts)), pa.int64())
    batch = pa.RecordBatch.from_arrays([ids, pa.array(texts), ids, ids], names=["doc_id", "text", "h", "row"])

    def watched(data, bounds, length, gram):
        seen.append(len(data))
        return anchors(data, bounds, length, gram)

    monkeypatch.setattr(suffix_merge, "anchors", watched)
    list(suffix_merge._counted(50, 16, None)(iter([batch])))
    assert sum(seen) == 3_000_000 and max(seen) <= 1 << 19
