"""Conversation repair and phrase collocations against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from popscan.llm import collocations, edit_lattice

SHAPE = re.compile(r"(s?(ua)+)?")


def all_audits(rows):
    """Every edit sequence within the cost of deleting all rows: cost, audit, repaired turns. ``rows``: role, text, must go, cut."""
    bound = 4 * len(rows)
    out = []

    def walk(i, cost, audit, turns):
        if cost > bound:
            return
        if i == len(rows) and SHAPE.fullmatch("".join(r[:1] for r, _ in turns)) and all(r for r, _ in turns):
            out.append((cost, audit, turns))
        if sum(x == "I" for x in audit) < 4:
            for role in ("user", "assistant"):
                walk(i, cost + 3, audit + "I", [*turns, (role, "")])
        if i < len(rows):
            role, text, gone, cut = rows[i]
            walk(i + 1, cost + 4, audit + "D", turns)
            if not gone:
                walk(i + 1, cost + 3 * cut, audit + "K", [*turns, (role, text)])
                for other in ("user", "assistant"):
                    walk(i + 1, cost + 3 + 3 * cut, audit + "R", [*turns, (other, text)])

    walk(0, 0, "", [])
    return min(out, key=lambda x: x[:2])


def plain_best(rows):
    """Cost, audit and turns by a plain table over rows and states, for longer conversations."""
    step = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
    best = {(0, 0): (0, "", [])}
    for i in range(len(rows) + 1):
        for _ in range(4):  # inserts
            for s in range(4):
                if (i, s) in best:
                    c, w, t = best[i, s]
                    for role in ("user", "assistant"):
                        n = step.get((role[0], s))
                        if n is not None:
                            new = (c + 3, w + "I", [*t, (role, "")])
                            if (i, n) not in best or new[:2] < best[i, n][:2]:
                                best[i, n] = new
        if i == len(rows):
            break
        role, text, gone, cut = rows[i]
        for s in range(4):
            if (i, s) not in best:
                continue
            c, w, t = best[i, s]
            moves = [(s, c + 4, w + "D", t)]
            if not gone:
                if role and step.get((role[0], s)) is not None:
                    moves.append((step[role[0], s], c + 3 * cut, w + "K", [*t, (role, text)]))
                for other in ("user", "assistant"):
                    if step.get((other[0], s)) is not None:
                        moves.append((step[other[0], s], c + 3 + 3 * cut, w + "R", [*t, (other, text)]))
            for n, cost, audit, turns in moves:
                if (i + 1, n) not in best or (cost, audit) < best[i + 1, n][:2]:
                    best[i + 1, n] = (cost, audit, turns)
    return min((best[len(rows), s] for s in (0, 3) if (len(rows), s) in best), key=lambda x: x[:2])


def judged(rows):
    """Counts and edits of one conversation (``turn, role, text`` in order)."""
    seen, out = set(), Counter()
    marked = []
    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[-1] not in ".!?" else None
        seen.add((role, text))
        out[fault] += 1
        marked.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
    for (_, a, _), (_, b, _) in itertools.pairwise(rows):
        out["illegal"] += a[:1] + b[:1] not in ("su", "ua", "au")
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit, repaired = (all_audits if len(rows) <= 4 else plain_best)(marked)
    text = "\n".join(f"{r}:{t}" for r, t in repaired)
    return (gaps, out["blank"], out["duplicate"], out["truncated"], out["illegal"], cost, audit, hashlib.sha256(text.encode()).hexdigest())


def hurt(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        out[conv]
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        row = (turn, "user" if kind == 4 else role, text)
        out[conv] += [row, row] if kind == 3 else [row]
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0)) for c, r in out.items()}


def talk(rng, n):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \n", None, "Yes. \t", "ends…", "é."]
    out = []
    for t in range(n):
        turn = None if rng.random() < 0.05 else t + (rng.random() < 0.1)
        role = ("user", "assistant")[t % 2] if rng.random() < 0.6 else rng.choice(roles)
        out.append((turn, role, rng.choice(texts) if rng.random() < 0.4 else f"Turn {t} {rng.random():.3f}."))
    return out


@pytest.mark.parametrize("length", [3, 4])
def test_least_audit_among_all_edits(length):
    rows = {0: "s", 1: "u", 2: "a", 3: "t"}
    for codes in itertools.product(range(9), repeat=length):
        if random.Random(str(codes)).random() < (0.3 if length == 3 else 0.02):
            plain = [(rows[c & 3], "", c == 8, bool(c & 4)) for c in codes]
            cost, audit, turns = all_audits(plain)
            assert edit_lattice.cheapest(bytes(codes)) == (cost, audit)
            assert plain_best(plain)[:2] == (cost, audit)
            got = [g or rows[codes[r] & 3] for e, r, g in edit_lattice.replay(bytes(codes), audit) if e != "D"]
            assert [g[0] for g in got] == [r[0] for r, _ in turns]


def test_long_conversations_by_both_searches():
    rng = random.Random(3)
    rows = {0: "s", 1: "u", 2: "a", 3: "t"}
    for n in (0, 1, 9, 40, 200, 900):
        for _ in range(6):
            codes = bytes(rng.choice([1, 2, 1, 2, 5, 6, 0, 3, 8, 7]) if rng.random() < 0.5 else 1 + i % 2 for i in range(n))
            plain = [(rows[c & 3], "", c == 8, bool(c & 4)) for c in codes]
            assert edit_lattice.cheapest(codes) == plain_best(plain)[:2]


def test_conversations_repaired(spark):
    rng = random.Random(11)
    table = [(c, *row) for c in range(120) for row in talk(rng, rng.randint(1, 9))]
    table += [(500, *row) for row in talk(rng, 400)] + [(None, *row) for row in talk(rng, 4)]
    only_dropped = next(c for c in range(10**4, 10**5) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    table.append((only_dropped, 0, "user", "Hello."))
    # rows of one turn are read in the order of a hash: keep turns apart where the plain version would need it
    table = list({(c, t): (c, t, r, x) for c, t, r, x in table}.values())
    rng.shuffle(table)
    df = spark.createDataFrame(table, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS phase", "'x' AS digest", "2 AS n", "3 AS copy")
    got = edit_lattice.summaries(edit_lattice.repair(*edit_lattice.damaged(df))).collect()
    want = {c: judged(r) for c, r in hurt(table).items()}
    assert {r[0]: tuple(r)[1:] for r in got} == want
    assert len(got) == len(want)
    assert want[only_dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_repaired_turns_and_empty_table(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "Oh"), (1, 2, "user", "")], "conv_id int, turn int, role string, text string")
    rows = edit_lattice.repair(df).collect()
    assert [(r.place, r.edit, r.role, r.text) for r in rows[1:]] == [(1, "K", "user", "Hi."), (2, "R", "assistant", "Oh")]
    assert (rows[0].cost, rows[0].audit, rows[0].blank, rows[0].truncated) == (10, "KRD", 1, 1)
    assert edit_lattice.repair(df.limit(0)).count() == 0
    assert edit_lattice.summaries(edit_lattice.repair(df.limit(0))).count() == 0


def phrases(rows, longest, least, share, top):
    """Plain counts and scores (``lang, text``)."""
    f, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        cand = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in cand.items():
            holds = [b for q, b in cand.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * b >= share * a for b in holds):
                continue
            s, k = min((Fraction(2000000 * a, counts[p[:k]] + counts[p[k:]]).__floor__(), k) for k in range(1, len(p)))
            scored.append((-s, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -s))
    return sorted(out)


@pytest.fixture(scope="module")
def lines():
    rng = random.Random(8)
    words = ["of", "the", "New", "york", "a", "ISTANBUL", "é", "漢字", "x y"]
    rows = []
    for i in range(150):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".\n", "!", "\r\n"]) for _ in range(rng.randint(0, 60)))
        rows.append((rng.choice(["en", "fr", None]), text))
    return [*rows, ("en", None), (None, ""), ("en", "..."), ("zz", "once"), ("de", "la la la la la la " * 400), rows[0], rows[0]]


@pytest.mark.parametrize(("longest", "least", "share", "top"), [(4, 5, 80, 2000), (2, 3, 80, 7), (5, 4, 50, 30)])
def test_collocations(spark, lines, longest, least, share, top):
    df = spark.createDataFrame(lines, "lang string, text string").selectExpr("*", "7 AS n", "'q' AS phrase", "1 AS w1", "2 AS size").repartition(5)
    got = collocations.collocations(df, longest, least, share, top).collect()
    want = phrases(lines, longest, least, share, top)
    assert sorted(tuple(r) for r in got) == want
    assert want


def test_counts_survive_a_full_filter(spark, lines, monkeypatch):
    """A filter that lets every pair through costs rows, not counts."""
    import numpy as np

    from popscan.llm import sketch

    df = spark.createDataFrame(lines, "lang string, text string")
    want = sorted(tuple(r) for r in collocations.phrase_counts(df, 4, 6).collect())
    full = sketch.Sketch(np.full(1 << (sketch.LOG_BITS - 6), 2**64 - 1, np.uint64))
    monkeypatch.setattr(collocations, "sketch", lambda *_: full)
    assert sorted(tuple(r) for r in collocations.phrase_counts(df, 4, 6).collect()) == want


def test_no_words_no_phrases(spark):
    df = spark.createDataFrame([("en", None), ("en", " . "), (None, "")], "lang string, text string")
    assert collocations.collocations(df).count() == 0
    assert collocations.collocations(df.limit(0)).count() == 0
