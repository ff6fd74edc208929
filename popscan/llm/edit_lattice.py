"""Conversation structure repair: the cheapest edits that make the roles of a conversation alternate.

A conversation is read in the order of its turns (nulls first; rows of one turn by a hash of role and text). A row's
first fault counts: *blank* (no character outside ``\\x20\\x09-\\x0D``), *duplicate* (role and text stood earlier in the
conversation), *truncated* (the last such character is not ``.``, ``!`` or ``?``). Edits and their costs: Keep 0, Rerole
to user or assistant 3, Delete 4 (blank and duplicate rows must go), Insert an empty user or assistant turn 3; a truncated
row that is not deleted adds 3. The repaired conversation is empty or an optional system turn and one or more pairs of user
and assistant, told by the initials of the roles.

The edits form a lattice: rows read so far by what the last turn was. Two Dijkstra searches run over it, one from the
start and one from the accepted ends, always a whole cost level of the side with the nearer frontier. They stop once no
unseen path can be as cheap as the best crossing, so every crossing of that cost is finished. Among those the least audit
(initials of the edits) is read off: at each step the least letter that stays on a cheapest path, over forward labels up
to a crossing and over reverse labels behind it. Paths of one cost into a node never have audits of which one begins the
other, since letters fix the node and whatever follows costs something, so the least letter is also the least whole.

Conversations stream through sorted partitions: first the codes of all rows (a few bytes each), then their texts, so a
task holds codes, digests and lattice labels of one conversation, never its texts. The audit needs the whole order, so a
conversation is one task's work, however long; its time and its labels grow with its rows, its texts are not held.

Defined results: a null role or text counts as one space, a null conversation id is a conversation of its own, a role
without characters has no initial and can not be kept; repeated rows are duplicates; an empty table gives no row; other
columns do not reach the result.
"""

from __future__ import annotations

import hashlib
import heapq
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT = 0, 3, 4, 3
TRUNCATED = 3
# what the last turn was: nothing, system, user, assistant
START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = "sua"
#: Codes of a row: index of its initial (3 for any other), plus 4 if truncated; or MUST_GO.
CUT, MUST_GO = 4, 8
_CACHED = 64  # rows up to which a pattern of codes is remembered

_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # what Insert and Rerole add
_KEPT = {(0, START): SYSTEM, (1, START): USER, (1, SYSTEM): USER, (1, ASSISTANT): USER, (2, USER): ASSISTANT}


def _out(codes: bytes, node: int) -> Iterator[tuple[str, int, int]]:
    """Edits at a node in the order of their initials, with their cost and the node they lead to."""
    i, state = divmod(node, 4)
    last = i == len(codes)
    if not last:
        yield "D", DELETE, node + 4
    yield "I", INSERT, 4 * i + _NEXT[state]
    if last or codes[i] == MUST_GO:
        return
    cut = TRUNCATED if codes[i] & CUT else 0
    kept = _KEPT.get((codes[i] & 3, state))
    if kept is not None:
        yield "K", KEEP + cut, 4 * (i + 1) + kept
    yield "R", REROLE + cut, 4 * (i + 1) + _NEXT[state]


def _into(codes: bytes, node: int) -> Iterator[tuple[int, int]]:
    """Cost and origin of the edits that lead to a node."""
    i, state = divmod(node, 4)
    before = [s for s, t in _NEXT.items() if t == state]
    for s in before:
        yield INSERT, 4 * i + s
    if i == 0:
        return
    yield DELETE, node - 4
    code = codes[i - 1]
    if code == MUST_GO:
        return
    cut = TRUNCATED if code & CUT else 0
    for s in before:
        yield REROLE + cut, 4 * (i - 1) + s
    for (initial, s), t in _KEPT.items():
        if initial == code & 3 and t == state:
            yield KEEP + cut, 4 * (i - 1) + s


class _Side:
    """One search: labels (-1 where none), settled nodes, and the heap."""

    def __init__(self, nodes: int, sources: list[int]):
        self.label = array("q", [-1]) * nodes
        self.settled = bytearray(nodes)
        self.heap = [(0, s) for s in sources]
        for s in sources:
            self.label[s] = 0

    @property
    def top(self) -> int:
        while self.heap and self.settled[self.heap[0][1]]:
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else 1 << 62

    def settle_level(self, edges, other: _Side, best: int) -> int:
        """Settle all nodes of the lowest cost; the least cost of a path known to cross."""
        level = self.top
        while self.top == level:
            _, node = heapq.heappop(self.heap)
            self.settled[node] = 1
            if other.label[node] >= 0:
                best = min(best, level + other.label[node])
            for cost, near in edges(node):
                if not self.settled[near] and (self.label[near] < 0 or level + cost < self.label[near]):
                    self.label[near] = level + cost
                    heapq.heappush(self.heap, (level + cost, near))
                    if other.label[near] >= 0:
                        best = min(best, level + cost + other.label[near])
        return best


def cheapest(codes: bytes) -> tuple[int, str]:
    """Cost and least audit of the cheapest edits of a conversation, given the codes of its rows."""
    return _remembered(codes) if len(codes) <= _CACHED else _search(codes)


def _search(codes: bytes) -> tuple[int, str]:
    nodes, ends = 4 * (len(codes) + 1), [4 * len(codes) + s for s in (START, ASSISTANT)]
    ahead, back = _Side(nodes, [START]), _Side(nodes, ends)
    best = 1 << 62
    while ahead.top + back.top <= best:
        if ahead.top <= back.top:
            best = ahead.settle_level(lambda v: ((c, w) for _, c, w in _out(codes, v)), back, best)
        else:
            best = back.settle_level(lambda v: _into(codes, v), ahead, best)
    for e in ends:  # their label is exact from the start
        back.settled[e] = 1

    def crosses(node: int, cost: int, near: int) -> bool:
        return back.settled[near] and ahead.label[node] + cost + back.label[near] == best

    # forward nodes that lie on a cheapest path: tails of crossings, and what leads to them at their cost
    on_path = bytearray(nodes)
    todo = []
    for v in range(nodes):
        if ahead.settled[v] and (crosses(v, 0, v) or any(crosses(v, c, w) for _, c, w in _out(codes, v))):
            on_path[v] = 1
            todo.append(v)
    while todo:
        v = todo.pop()
        for c, u in _into(codes, v):
            if ahead.settled[u] and not on_path[u] and ahead.label[u] + c == ahead.label[v]:
                on_path[u] = 1
                todo.append(u)

    node, audit = START, []
    while node not in ends:  # whatever follows an accepted end would cost something
        for letter, cost, near in _out(codes, node):
            if on_path[node]:
                good = crosses(node, cost, near) or (on_path[near] and ahead.label[node] + cost == ahead.label[near])
            else:
                good = back.settled[near] and cost + back.label[near] == back.label[node]
            if good:
                audit.append(letter)
                node = near
                break
    return best, "".join(audit)


_remembered = lru_cache(maxsize=1 << 16)(_search)


def replay(codes: bytes, audit: str) -> Iterator[tuple[str, int | None, str | None]]:
    """The edits one by one: initial, index of the row read (none for Insert), role given (none where unchanged)."""
    i, state = 0, START
    for letter in audit:
        if letter == "D":
            yield letter, i, None
        elif letter == "K":
            state = _KEPT[(codes[i] & 3, state)]
            yield letter, i, None
        else:
            state = _NEXT[state]
            yield letter, None if letter == "I" else i, "user" if state == USER else "assistant"
        i += letter != "I"


_OUT = (
    "conv_id long, place long, edit string, role string, text string, gaps long, blank long, duplicate long, "
    "truncated long, illegal long, cost long, audit string"
)
_FIELDS = pa.schema(
    [("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]
    + [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [("audit", pa.string())]
)
_FLUSH_ROWS, _FLUSH_CHARS = 4096, 4 << 20


class _Out:
    """Result rows in batches of bounded size."""

    def __init__(self):
        self.rows, self.chars = [], 0

    def add(self, *row) -> None:
        self.rows.append(row)
        self.chars += len(row[4] or "") + len(row[11] or "")

    def batch(self, least_rows: int = _FLUSH_ROWS) -> Iterator[pa.RecordBatch]:
        if len(self.rows) >= least_rows or self.chars >= _FLUSH_CHARS:
            columns = zip(*self.rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _FIELDS, strict=True)], schema=_FIELDS
            )
            self.rows, self.chars = [], 0


class _Conversation:
    """What is held of the conversation that streams by: codes, digests, counts; then the edits under way."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.codes, self.seen = bytearray(), set()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.initial = self.first = self.last = None
        self.turns = 0
        self.edits = None

    def note(self, turn, initial: str, blank: bool, cut: bool, digest: bytes) -> None:
        if turn is not None:
            self.turns += turn != self.last
            self.first, self.last = (turn if self.first is None else self.first), turn
        if self.initial is not None:
            self.illegal += self.initial + initial not in ("su", "ua", "au")
        self.initial = initial
        again = digest in self.seen
        self.seen.add(digest)
        self.blank += blank
        self.duplicate += again and not blank
        self.truncated += cut and not blank and not again
        code = INITIALS.find(initial) if initial else -1
        self.codes.append(MUST_GO if blank or again else (3 if code < 0 else code) + (CUT if cut else 0))

    def judge(self, out: _Out) -> None:
        self.seen = None
        self.codes = bytes(self.codes)
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        cost, audit = cheapest(self.codes)
        self.edits, self.place, self.read = replay(self.codes, audit), 0, 0
        out.add(
            self.conv_id, 0, None, None, None, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit
        )

    def _turn(self, out: _Out, edit: str, role: str, text: str) -> None:
        self.place += 1
        out.add(self.conv_id, self.place, edit, role, text, *(None,) * 7)

    def apply(self, out: _Out, role: str, text: str) -> None:
        """The edits up to and with the one that reads this row."""
        for letter, row, given in self.edits:
            if row is None:
                self._turn(out, letter, given, "")
                continue
            if letter != "D":
                self._turn(out, letter, given or role, text)
            return

    def end(self, out: _Out) -> None:
        if self.edits is None:
            self.judge(out)
        for letter, _, given in self.edits:
            self._turn(out, letter, given, "")


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, out = None, _Out()
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "phase", "turn", "initial", "blank", "cut", "digest", "role", "text")]
        for conv_id, phase, turn, initial, blank, cut, digest, role, text in zip(*columns, strict=True):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    now.end(out)
                now = _Conversation(conv_id)
            if phase == 1:
                now.note(turn, initial, blank, cut, digest)
            elif phase == 2:
                if now.edits is None:
                    now.judge(out)
                now.apply(out, role, text)
            yield from out.batch()
    if now is not None:
        now.end(out)
    yield from out.batch(1)


def repair(rows: DataFrame, copies: Column | None = None) -> DataFrame:
    """Summaries and repaired turns of conversations (``conv_id, turn, role, text``).

    For each conversation a row with ``place`` 0 that holds the counts, the cost and the audit, and behind it in the same
    partition, in order, a row for each turn of the repaired conversation with the edit it comes from. ``copies`` is how
    often a row stands (1 by default); conversations whose rows all stand no time are empty but not lost.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    read = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        text.alias("text"), (F.lit(1) if copies is None else copies).alias("n"),
    )
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    empty = F.lit(None).cast("string")
    known = read.select(
        "conv_id", "turn", "n", "role", "text", F.substring("role", 1, 1).alias("initial"), (last == "").alias("blank"),
        (~last.isin(".", "!", "?")).alias("cut"),
        F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("digest"),
    )
    # phase 0 names the conversation, 1 tells the codes of its rows, 2 their texts
    phases = F.array(
        F.struct(F.lit(0).alias("phase"), F.lit(1).alias("times"), empty.alias("role"), empty.alias("text")),
        F.struct(F.lit(1).alias("phase"), F.col("n").alias("times"), empty.alias("role"), empty.alias("text")),
        F.struct(F.lit(2).alias("phase"), F.col("n").alias("times"), F.col("role").alias("role"), F.col("text").alias("text")),
    )
    dealt = known.select("conv_id", "turn", "initial", "blank", "cut", "digest", F.explode(phases).alias("p"))
    dealt = dealt.filter("p.times > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("p.times"))))
    flat = dealt.select("conv_id", "p.phase", "turn", "initial", "blank", "cut", "digest", "p.role", "p.text")
    ordered = flat.repartition("conv_id").sortWithinPartitions(
        "conv_id", "phase", F.col("turn").asc_nulls_first(), "digest"
    )
    return ordered.mapInArrow(_stream, _OUT)


def summaries(repaired: DataFrame) -> DataFrame:
    """One row per conversation of :func:`repair`, with the digest of its repaired ``role:text`` lines."""
    kept = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, digest, done = None, None, []

        def flush() -> pa.RecordBatch:
            rows = [{**h, "repaired_sha256": d} for h, d in done]
            done.clear()
            return pa.RecordBatch.from_pylist(rows, pa.schema([(c, _FIELDS.field(c).type) for c in kept] + [("repaired_sha256", pa.string())]))

        for batch in batches:
            heads = {c: batch.column(c).to_pylist() for c in kept}
            places, roles, texts = (batch.column(c).to_pylist() for c in ("place", "role", "text"))
            for i, (place, role, text) in enumerate(zip(places, roles, texts, strict=True)):
                if place == 0:
                    if head is not None:
                        done.append((head, digest.hexdigest()))
                    head, digest = {c: heads[c][i] for c in kept}, hashlib.sha256()
                else:
                    digest.update(f"{chr(10) if place > 1 else ''}{role}:{text}".encode())
            if done:
                yield flush()
        if head is not None:
            done.append((head, digest.hexdigest()))
            yield flush()

    return repaired.mapInArrow(
        run, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    )


def damaged(rows: DataFrame) -> tuple[DataFrame, Column]:
    """Rows with planted faults by the checksum of ``conv_id:turn``, and how often each stands (see the query)."""
    space = F.lit(" ")
    name = F.concat(*(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id",)), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(F.encode(name, "UTF-8")) % 20
    text = F.coalesce(F.col("text"), space)
    hurt = rows.select(
        "conv_id", "turn", F.when(kind == 4, F.lit("user")).otherwise(F.coalesce(F.col("role"), space)).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("_copies"),
    )
    return hurt, F.col("_copies")
