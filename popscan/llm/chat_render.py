"""Chat formatting by incremental rendering of a black-box template.

Successive prefixes of a conversation are rendered and compared: what a turn adds to the output is its span, and a
template that changes what stood before is found out. The text inside a span is located by rendering the turn once
more with a sentinel in place of its text; for trained roles that part is the loss mask.

A conversation's rows stream through one task in order, and every prefix is rendered whole, whatever its length, so a
change of any earlier turn is seen; that work grows with the square of the conversation. For a template that the caller
declares ``append_only``, the prefix holds the last ``block`` to twice ``block`` turns; when older turns leave it, the
last turn must render as before, else the turn counts as rewritten.

Defined results: null texts and null roles are empty; rows order by turn (null first), then role and text, and ties
repeat; rows without a conversation id form one conversation; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]
_SENTINEL = ""
FORMATTED = (
    "conv_id long, turn long, role string, piece string, start long, end long, loss_start long, loss_end long, "
    "rewritten_from long"
)


class Marks:
    """Turns between instruction marks: ``<s>``, then ``[INST]role[/INST]text</s>`` for each.

    A mark inside a role or text gets a backslash behind its first character, and one more if it has some already, so
    nothing between two marks reads as a mark, and :meth:`plain` restores the text.
    """

    _marked = re.compile(r"(<|\[)(\\*)(/?s>|/?INST\])")
    _escaped = re.compile(r"(<|\[)\\(\\*)(/?s>|/?INST\])")
    _turn = re.compile(r"(?:<s>)?\[INST\](.*?)\[/INST\](.*?)</s>", re.S)

    def escape(self, text: str) -> str:
        return self._marked.sub(r"\1\\\2\3", text)

    def plain(self, text: str) -> str:
        return self._escaped.sub(r"\1\2\3", text)

    def __call__(self, turns: list[Turn]) -> str:
        return "<s>" + "".join(f"[INST]{self.escape(r)}[/INST]{self.escape(t)}</s>" for r, t in turns)

    def read(self, output: str) -> list[Turn]:
        """Roles and texts of a formatted output."""
        out, at = [], 0
        while at < len(output):
            m = self._turn.match(output, at)
            if not m:
                raise ValueError(f"no turn at {at}")
            out.append((self.plain(m[1]), self.plain(m[2])))
            at = m.end()
        return out


class Tracker:
    """Spans of one conversation's turns, fed one by one."""

    def __init__(self, template: Template, trained: frozenset[str], block: int | None):
        self.template, self.trained, self.block = template, trained, block  # None: prefixes are whole
        self.turns: list[Turn] = []
        self.output = ""  # rendering of turns
        self.base = 0  # characters of the whole output before this rendering's last turns, beyond its own length
        self.last = ""

    def feed(self, role: str, text: str) -> tuple[str, int, int, int | None, int | None, int | None]:
        """Piece, start, end, start and end of the loss mask, and from where earlier output was rewritten."""
        rewritten = None
        if self.block and len(self.turns) >= 2 * self.block:
            self.turns = self.turns[-self.block :]
            shorter = self.template(self.turns)
            if not shorter.endswith(self.last):
                rewritten = self.base + len(self.output) - len(self.last)
            self.base += len(self.output) - len(shorter)
            self.output = shorter
        new = self.template([*self.turns, (role, text)])
        same = len(self.output) if new.startswith(self.output) else len(os.path.commonprefix([self.output, new]))
        if same < len(self.output):
            rewritten = self.base + same
        piece, start, end = new[same:], self.base + same, self.base + len(new)
        mask = (None, None)
        if role in self.trained:
            probe = self.template([*self.turns, (role, _SENTINEL)])
            at = probe.find(_SENTINEL, min(same, len(probe)))
            foot = probe[at + len(_SENTINEL) :]
            if at >= 0 and new.startswith(probe[:at]) and new.endswith(foot) and at + len(foot) <= len(new):
                mask = (self.base + at, self.base + len(new) - len(foot))
        self.turns.append((role, text))
        self.output, self.last = new, piece
        return piece, start, end, *mask, rewritten


def in_order(conversations: DataFrame) -> DataFrame:
    """Rows of each conversation in one partition, in order."""
    c = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    return c.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def render(
    conversations: DataFrame, template: Template | None = None, trained: tuple[str, ...] = ("assistant",), block: int = 64,
    append_only: bool = False,
) -> DataFrame:
    """One row per turn: the piece it adds to the output, its span and loss mask in characters, rewritten or not."""
    form, roles = template or Marks(), frozenset(trained)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tracker, current = None, object()
        names = [x.split()[0] for x in FORMATTED.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), *[pa.int64()] * 5]
        for whole in batches:
            for lo in range(0, whole.num_rows, 1024):
                rows = []
                for r in whole.slice(lo, 1024).to_pylist():
                    if tracker is None or r["conv_id"] != current:
                        tracker, current = Tracker(form, roles, block if append_only else None), r["conv_id"]
                    rows.append((r["conv_id"], r["turn"], r["role"], *tracker.feed(r["role"], r["text"])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
                )

    return in_order(conversations).mapInArrow(run, FORMATTED)


def read_back(formatted: DataFrame, template: Marks | None = None) -> DataFrame:
    """Digests of each conversation, read from the output of :func:`render` alone, in the order it gives."""
    form = template or Marks()
    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
        "rewrites long"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict | None = None

        def close(rows: list[dict]) -> None:
            rows.append(
                {
                    "conv_id": state["id"], "n_turns": state["turns"], "turns_sha256": state["all"].hexdigest(),
                    "loss_chars": state["loss"], "loss_sha256": state["mask"].hexdigest(),
                    "formatted_chars": state["chars"], "rewrites": state["rewrites"],
                }
            )

        kinds = pa.schema(
            [
                ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                ("rewrites", pa.int64()),
            ]
        )
        for whole in batches:
            rows: list[dict] = []
            for lo in range(0, whole.num_rows, 1024):
                for r in whole.slice(lo, 1024).to_pylist():
                    if state is None or r["conv_id"] != state["id"]:
                        if state is not None:
                            close(rows)
                        state = {
                            "id": r["conv_id"], "turns": 0, "all": hashlib.sha256(), "mask": hashlib.sha256(),
                            "loss": 0, "chars": 0, "rewrites": 0,
                        }
                    for role, text in form.read(r["piece"]):
                        state["turns"] += 1
                        state["all"].update(f"{role}\n{text}\n".encode())
                    if r["loss_start"] is not None:
                        text = form.plain(r["piece"][r["loss_start"] - r["start"] : r["loss_end"] - r["start"]])
                        state["loss"] += len(text)
                        state["mask"].update(text.encode())
                    state["chars"] += len(r["piece"])
                    state["rewrites"] += r["rewritten_from"] is not None
            if rows:
                yield pa.RecordBatch.from_pylist(rows, kinds)
        if state is not None:
            rows = []
            close(rows)
            yield pa.RecordBatch.from_pylist(rows, kinds)

    return formatted.mapInArrow(run, schema)
