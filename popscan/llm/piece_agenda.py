"""SentencePiece encoding and decoding for merge-type vocabularies, by an agenda of adjacent symbol pairs.

Symbols begin as characters; the agenda pops the adjacent pair whose union is the best-scored piece (the leftmost of
equals), joins it, and offers the new neighbours. Short chunks share one agenda held in arrays, from which each takes
its best pair in every round; long ones and those with characters outside the vocabulary have a heap each. No piece of such a vocabulary holds a space mark behind another
character, so a text falls into chunks (space marks, then other characters) that never merge with each other, and a
chunk met before is looked up. Characters outside the vocabulary become byte pieces.

The pieces come from the model file named by the caller; a model with a normaliser of its own, with extra white space
removed, or with pieces that cross chunks is refused. In each Arrow batch, every chunk seen for the first time is
encoded and decoded by the sentencepiece library too, and a difference is an error; ``check="texts"`` compares whole
texts instead, ``check=None`` nothing.

Defined results: a null text counts as empty; an empty text has no ids and decodes to itself. Rows are independent, so
repeated rows and ids repeat their result.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

MARK = "▁"  # fixed value: the library's visible space


class Pieces:
    """A vocabulary read from a model file."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        lib, size = self.library, self.library.get_piece_size()
        names = lib.id_to_piece(list(range(size)))
        self.text: list[str | None] = list(names)  # what an id decodes to; None for a byte
        self.byte: dict[int, int] = {}
        self.rank: dict[str, int] = {}
        self.id: dict[str, int] = {}
        normal = []
        for i, name in enumerate(names):
            if lib.is_byte(i):
                self.byte[i] = int(name[3:5], 16)
                self.text[i] = None
            elif lib.is_control(i) or lib.is_unknown(i):
                self.text[i] = "" if lib.is_control(i) else " ⁇ "
            elif not lib.is_unused(i):
                normal.append((-lib.get_score(i), i))
                self.id[name] = i
                if MARK in name.lstrip(MARK):
                    raise ValueError(f"piece {name!r} crosses chunks")
        order = {score: n for n, score in enumerate(sorted({s for s, _ in normal}))}
        self.rank = {names[i]: order[s] for s, i in normal}
        self._tabulate(names)
        self.of_byte = {b: i for i, b in self.byte.items()}
        if len(self.of_byte) != 256:
            raise ValueError("the vocabulary has no byte pieces")
        if MARK not in self.id or any("\n" in p for p in self.id):
            raise ValueError("the vocabulary must hold the space mark, and no piece a line break")
        for probe in ("Ａ½", " a  b "):  # a normaliser would change these
            if lib.decode(lib.encode(probe)) != probe:
                raise ValueError("the model normalises its input")

    def _tabulate(self, names: list[str]) -> None:
        """Symbols of characters, and a hash table from two symbols to the one they form; ranks by symbol."""
        symbol = dict(self.id)
        for p in self.rank:
            for c in p:
                symbol.setdefault(c, len(names) + len(symbol))
        self.extra = {i: c for c, i in symbol.items() if i >= len(names)}  # in pieces, but no piece alone
        top = max(symbol.values()) + 1
        self.symbol_rank = np.full(top, 1 << 30, np.int64)
        for p, r in self.rank.items():
            self.symbol_rank[self.id[p]] = r
        self.of_char = np.full(max(map(ord, (c for c in symbol if len(c) == 1))) + 2, -1, np.int64)
        for c, i in symbol.items():
            if len(c) == 1:
                self.of_char[ord(c)] = i
        found = [
            (symbol[p[:k]] * top + symbol[p[k:]], self.id[p])
            for p in self.rank for k in range(1, len(p)) if p[:k] in symbol and p[k:] in symbol
        ]
        keys, self.top = np.array([k for k, _ in found], np.int64), top
        order = np.argsort(keys)
        self.pair_key, pair_id = keys[order], np.array([i for _, i in found], np.int64)[order]
        self.slots = 1 << 21
        self.slot_key, self.slot_id = np.full(self.slots, -1, np.int64), np.full(self.slots, -1, np.int64)
        left = np.arange(len(keys))
        self.probes = 0
        while len(left):  # open addressing: what finds its slot taken tries the next one
            at = (self._slot(self.pair_key[left]) + self.probes) & (self.slots - 1)
            free = self.slot_key[at] < 0
            self.slot_key[at[free]] = self.pair_key[left[free]]
            mine = self.slot_key[at] == self.pair_key[left]
            self.slot_id[at[mine]] = pair_id[left[mine]]
            left = left[~mine]
            self.probes += 1

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(43)).astype(np.int64)

    def _joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that two symbols form, -1 for none."""
        key = np.where((left < self.top) & (right < self.top), left * self.top + right, -2)
        at = self._slot(key)
        out = np.where(self.slot_key[at] == key, self.slot_id[at], -1)
        open_ = np.flatnonzero((out < 0) & (self.slot_key[at] >= 0))
        for k in range(1, self.probes):
            if not len(open_):
                break
            there = (at[open_] + k) & (self.slots - 1)
            hit = self.slot_key[there] == key[open_]
            out[open_[hit]] = self.slot_id[there[hit]]
            open_ = open_[~hit & (self.slot_key[there] >= 0)]
        return out

    def encode_chunks(self, chunks_: list[str], longest: int = 48) -> list[list[int]]:
        """Ids of many chunks: one agenda in arrays for the short ones of like size, a heap for each of the others."""
        out: list[list[int]] = [[]] * len(chunks_)
        sizes = np.fromiter(map(len, chunks_), np.int64, len(chunks_))
        code = np.frombuffer("".join(chunks_).encode("utf-32-le"), "<u4").astype(np.int64)
        symbol = self.of_char[np.minimum(code, len(self.of_char) - 1)]
        symbol = np.where(symbol < 0, self.top + code, symbol)  # outside the vocabulary: joins nothing
        start = np.cumsum(sizes) - sizes
        for i in np.flatnonzero(sizes > longest).tolist():
            out[i] = self.encode_chunk(chunks_[i])
        least = 0
        for width in (*range(4, min(longest, 16), 4), *range(16, longest, 8), longest):
            mine = np.flatnonzero((sizes > least) & (sizes <= width))
            least = width
            if len(mine):
                flat, ends = self._agenda(symbol, start[mine], sizes[mine], width)
                spelled = np.unique(np.searchsorted(ends, np.flatnonzero(flat >= len(self.text)), "right")).tolist()
                ids, edges, at = flat.tolist(), ends.tolist(), mine.tolist()
                lo = 0
                for i, hi in zip(at, edges, strict=True):
                    out[i] = ids[lo:hi]
                    lo = hi
                for k in spelled:
                    out[at[k]] = [x for s in out[at[k]] for x in self._spelled(s, len(self.text))]
        return out

    def _agenda(self, symbol: np.ndarray, start: np.ndarray, size: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """What is left of chunks after all unions, one behind the other, and where each ends.

        A chunk is a row of ``width`` places. A union stays at its left place and empties its right one, so the lowest
        rank's first place in a row is the leftmost of equals; only the pairs on both sides of it are looked up again.
        """
        none = np.int32(1 << 30)
        place = np.arange(width)
        held = place < size[:, None]
        rows = np.where(held, symbol[np.minimum(start[:, None] + place, len(symbol) - 1)], -1)
        pair = held[:, 1:]
        union = np.full(rows.shape, -1, np.int64)
        union[:, :-1][pair] = self._joined(rows[:, :-1][pair], rows[:, 1:][pair])
        rank = np.where(union >= 0, self.symbol_rank[union], none).astype(np.int32)
        after = np.broadcast_to(place + 1, rows.shape).copy()  # ``size`` behind the last
        before = np.broadcast_to(place - 1, rows.shape).copy()
        row = np.arange(len(rows))
        while len(row):
            at = (rank if len(row) == len(rank) else rank[row]).argmin(axis=1)
            more = rank[row, at] < none
            row, at = row[more], at[more]
            gone = after[row, at]
            follows = after[row, gone]
            rows[row, at] = union[row, at]
            rows[row, gone] = -1
            rank[row, gone] = none
            after[row, at] = follows
            inner = follows < size[row]
            before[row[inner], follows[inner]] = at[inner]
            self._paired(rows, union, rank, row, at, follows, inner)
            ahead = before[row, at]
            self._paired(rows, union, rank, row, ahead, at, ahead >= 0)
        left = rows >= 0
        return rows[left], np.cumsum(left.sum(axis=1))

    def _paired(self, rows, union, rank, row, left, right, held) -> None:
        """Look up the pairs of places ``left`` and ``right`` again; where ``held`` is false, there is none."""
        none = np.int32(1 << 30)
        rank[row[~held], left[~held]] = none
        r, a, b = row[held], left[held], right[held]
        found = self._joined(rows[r, a], rows[r, b])
        union[r, a] = found
        rank[r, a] = np.where(found >= 0, self.symbol_rank[found], none)

    def _spelled(self, symbol: int, size: int) -> list[int]:
        if symbol < size:
            return [symbol]
        char = chr(symbol - self.top) if symbol >= self.top else self.extra[symbol]
        return [self.of_byte[b] for b in char.encode()]

    def encode_chunk(self, chunk: str) -> list[int]:
        """Ids of a chunk, by the agenda."""
        rank = self.rank
        piece: list[str | None] = list(chunk)
        n = len(piece)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = []
        for i in range(n - 1):
            r = rank.get(chunk[i : i + 2])
            if r is not None:
                agenda.append((r, i, i + 1, 2))
        heapq.heapify(agenda)
        pop, push = heapq.heappop, heapq.heappush
        while agenda:
            _, i, j, size = pop(agenda)
            a = piece[i]
            if a is None or j >= n:
                continue
            b = piece[j]
            if b is None or after[i] != j or len(a) + len(b) != size:
                continue  # one of the two has been joined since
            a = piece[i] = a + b
            piece[j] = None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = rank.get(a + piece[k])
                if r is not None:
                    push(agenda, (r, i, k, size + len(piece[k])))
            h = before[i]
            if h >= 0:
                r = rank.get(piece[h] + a)
                if r is not None:
                    push(agenda, (r, h, i, size + len(piece[h])))
        out = []
        for p in piece:
            if p is not None:
                i = self.id.get(p)
                if i is None:
                    out.extend(self.of_byte[b] for b in p.encode())
                else:
                    out.append(i)
        return out

    def decode(self, ids: list[int]) -> str:
        """Text of ids: bytes joined to characters, marks to spaces, the leading space of the prefix dropped."""
        try:
            whole = "".join([self.text[i] for i in ids])
            return (whole[1:] if whole[:1] == MARK else whole).replace(MARK, " ")
        except TypeError:  # bytes among them
            pass
        out, run = [], bytearray()
        for i in ids:
            text = self.text[i]
            if text is None:
                run.append(self.byte[i])
                continue
            if run:
                out.append(_loose(bytes(run)))
                run.clear()
            out.append(text)
        if run:
            out.append(_loose(bytes(run)))
        whole = "".join(out)
        return (whole[1:] if whole[:1] == MARK else whole).replace(MARK, " ")


def _loose(data: bytes) -> str:
    """Bytes as UTF-8, each byte that belongs to no character as U+FFFD."""
    out, at = [], 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(data[at : at + size].decode())
            except UnicodeDecodeError:
                continue
            at += size
            break
        else:
            out.append("�")
            at += 1
    return "".join(out)


def chunks(text: str) -> list[str]:
    """The chunks of a text, marks as spaces: those that begin with a line break as they are, others without their first
    mark. ``a  b\\nc`` has ``a``, `` b`` and ``\\nc``."""
    if not text:
        return []
    if MARK in text:
        text = text.replace(MARK, " ")
    parts = text.replace("\n", " \n").split(" ")
    if "" not in parts:
        return parts
    out, empty = [], 0
    for part in parts:
        if not part:
            empty += 1
        elif part[0] != "\n":
            out.append(" " * empty + part)
            empty = 0
        else:
            if empty:
                out.append(" " * (empty - 1))
            out.append(part)
            empty = 0
    if empty:
        out.append(" " * (empty - 1))
    return out


class Encoder:
    """Whole texts, chunk by chunk, with a bounded memory of chunks met before: when it is full, those met again stay."""

    def __init__(self, model_file: str, check: str | None = "chunks", remembered: int = 500_000):
        self.pieces = Pieces(model_file)
        self.names = [f"{i}," for i in range(len(self.pieces.text))]
        self.check, self.remembered = check, remembered
        self.known: dict[str, int] = {}  # number of a chunk, in order
        self.back: list[str] = []  # by number: what its ids decode to
        self.flat, self.ends = np.empty(1 << 16, np.int32), np.zeros(1 << 14, np.int64)  # ids of all numbers, and their ends
        self.again = np.zeros(1 << 14, bool)  # by number: met in a later batch

    def forget(self, room: int) -> None:
        """Make room for so many chunks: those not met again go, or all if that is not enough."""
        n = len(self.back)
        keep = np.flatnonzero(self.again[:n])
        if len(keep) + room > self.remembered:
            keep = keep[:0]
        name, flat, edges = list(self.known), *self.ids(keep, np.array([0, len(keep)]))
        size = self.ends[keep + 1] - self.ends[keep]
        self.known = {name[i]: k for k, i in enumerate(keep.tolist())}
        self.back = [self.back[i] for i in keep.tolist()]
        self.flat[: len(flat)] = flat
        self.ends[1 : len(keep) + 1] = np.cumsum(size)
        self.again[:] = False

    def learn(self, new: list[str]) -> None:
        pieces = self.pieces
        ids = pieces.encode_chunks([(c if c[:1] == "\n" else MARK + c).replace(" ", MARK) for c in new])
        back = [pieces.decode(x) for x in ids]
        if self.check == "chunks":
            self._compare(new, ids, back)
        n, m = len(self.back), len(self.back) + len(new)
        self.known.update(zip(new, range(n, m), strict=True))
        self.back += [b if c[:1] == "\n" else " " + b for c, b in zip(new, back, strict=True)]
        ends = self.ends[n] + np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
        if m >= len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros(m, np.int64)])
            self.again = np.concatenate([self.again, np.zeros(m, bool)])
        if ends[-1] > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty(ends[-1], np.int32)])
        self.flat[self.ends[n] : ends[-1]] = np.fromiter(chain.from_iterable(ids), np.int32)
        self.ends[n + 1 : m + 1] = ends

    def _compare(self, new: list[str], ids: list[list[int]], back: list[str]) -> None:
        """New chunks, some dozen to a text, against the library."""
        lib = self.pieces.library
        spaces = [i for i, c in enumerate(new) if not c.strip(" ")]  # as a text ends with
        words = [i for i, c in enumerate(new) if c.strip(" ") and c[0] != "\n"]
        lines = [i for i, c in enumerate(new) if c[:1] == "\n"]
        groups = [words[k : k + 40] for k in range(0, len(words), 40)] + [[i] for i in spaces if new[i]]
        texts = [" ".join([new[i] for i in g]) for g in groups]
        mine = [list(chain.from_iterable([ids[i] for i in g])) for g in groups]
        decoded = [" ".join([back[i] for i in g]) for g in groups]
        for k in range(0, len(lines), 40):
            g = lines[k : k + 40]
            texts.append("".join([new[i] for i in g]))
            mine.append([self.pieces.id[MARK], *chain.from_iterable([ids[i] for i in g])])
            decoded.append("".join([back[i] for i in g]))
        if lib.encode(texts, num_threads=1) != mine or lib.decode(mine, num_threads=1) != decoded:
            raise ValueError("agenda and library differ")

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of the chunks of all texts, and where each text ends, led by 0; chunks not met before are learned."""
        split = [chunks(text) for text in texts]
        parts = list(chain.from_iterable(split))
        of = self._looked_up(parts)
        before = len(self.back)
        holes = np.flatnonzero(of < 0).tolist()
        if holes:
            new = {parts[i] for i in holes}
            if before + len(new) > self.remembered:
                self.forget(len(new))
                of = self._looked_up(parts)
                before = len(self.back)
                holes = np.flatnonzero(of < 0).tolist()
                new = {parts[i] for i in holes}
            self.learn(list(new))
            of[holes] = [self.known[parts[i]] for i in holes]
        self.again[of[of < before]] = True
        edges = np.r_[0, np.cumsum(np.fromiter(map(len, split), np.int64, len(split)))]
        if self.check == "texts":
            flat, ends = self.ids(of, edges)
            for text, back, lo, hi in zip(texts, self.decoded(of, edges), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                theirs = self.pieces.library.encode(text)
                if flat[lo:hi].tolist() != theirs or back != self.pieces.library.decode(theirs):
                    raise ValueError("agenda and library differ on a text")
        return of, edges

    def _looked_up(self, parts: list[str]) -> np.ndarray:
        return np.fromiter(map(self.known.get, parts, repeat(-1)), np.int64, len(parts))

    def ids(self, of: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one behind the other, and where each text ends, led by 0."""
        size = self.ends[of + 1] - self.ends[of]
        upto = np.r_[0, np.cumsum(size)]
        flat = self.flat[np.repeat(self.ends[of] - upto[:-1], size) + np.arange(upto[-1])]
        return flat, upto[edges]

    def decoded(self, of: np.ndarray, edges: np.ndarray) -> list[str]:
        backs, at = list(map(self.back.__getitem__, of.tolist())), edges.tolist()
        return ["".join(backs[lo:hi])[1:] for lo, hi in zip(at, at[1:])]

    def batch(self, texts: list[str]) -> Iterator[tuple[str, str]]:
        """Ids joined by commas, and the decoded text, of each text."""
        of, edges = self.numbers(texts)
        flat, ends = self.ids(of, edges)
        named, at = list(map(self.names.__getitem__, flat.tolist())), ends.tolist()
        for lo, hi, back in zip(at, at[1:], self.decoded(of, edges)):
            yield "".join(named[lo:hi])[:-1], back


_encoders: dict[tuple, Encoder] = {}  # one for each worker process


def encoder(model_file: str, check: str | None) -> Encoder:
    key = (model_file, check)
    if key not in _encoders:
        _encoders[key] = Encoder(model_file, check)
    return _encoders[key]


def encode(documents: DataFrame, model_file: str, check: str | None = "chunks", digest: bool = False) -> DataFrame:
    """``documents`` with ``ids`` (array) and ``decoded``, or with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``.

    ``model_file`` must be readable on every executor. Columns of those names are replaced.
    """
    added = (
        [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())]
        if digest
        else [StructField("ids", ArrayType(IntegerType())), StructField("decoded", StringType())]
    )
    documents = documents.drop(*[f.name for f in added])
    at = documents.columns.index("text")
    schema = StructType([*documents.schema.fields, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(model_file, check)
        for whole in batches:
            for lo in range(0, max(1, whole.num_rows), 256):
                batch = whole.slice(lo, 256)
                texts = [t or "" for t in batch.column(at).to_pylist()]
                if digest:
                    n, a, b = [], [], []
                    for ids, back in coder.batch(texts):
                        n.append(ids.count(",") + 1 if ids else 0)
                        a.append(hashlib.sha256(ids.encode()).hexdigest())
                        b.append(hashlib.sha256(back.encode()).hexdigest())
                    new = [pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
                else:
                    of, edges = coder.numbers(texts)
                    flat, ends = coder.ids(of, edges)
                    new = [
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())),
                        pa.array(coder.decoded(of, edges), pa.string()),
                    ]
                yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[f.name for f in schema])

    return documents.mapInArrow(run, schema)


def decode(rows: DataFrame, model_file: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Column ``into``: the text of an array of ids; null ids give null, no ids an empty text."""
    rows = rows.drop(into)
    at = rows.columns.index(ids)
    schema = StructType([*rows.schema.fields, StructField(into, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = encoder(model_file, None).pieces
        for batch in batches:
            texts = [None if x is None else pieces.decode(x) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[f.name for f in schema])

    return rows.mapInArrow(run, schema)
