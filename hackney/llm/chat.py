"""Chat formatting by a finite-state machine over roles.

A declarative template says how a turn is written, which roles may follow which
and which roles are trained on. The machine walks the turns of a conversation in
order and emits text segments, each with its loss flag. What looks like the
template's own marks inside a text or role is escaped, and reading back undoes it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackney.llm.frames import kind_of, pick


@dataclass(frozen=True)
class Template:
    """How turns are written; the defaults are the library's plain format."""

    opening: str = "### "
    role_end: str = ": "
    closing: str = " </turn>\n"
    escape: str = "\\"
    loss_roles: frozenset[str] = frozenset({"assistant"})
    # Roles that may come next, by the role before; the empty role is the beginning.
    follows: dict[str, frozenset[str]] = field(
        default_factory=lambda: {
            "": frozenset({"system", "user"}),
            "system": frozenset({"user"}),
            "user": frozenset({"assistant"}),
            "assistant": frozenset({"user"}),
        }
    )
    # Roles that a whole conversation may end with.
    ends: frozenset[str] = frozenset({"assistant"})

    def marks(self) -> list[str]:
        """What must not stand unescaped in a text: the marks without the blanks around them."""
        return [self.escape, self.opening.strip(), self.closing.strip()]

    def protect(self, text: str, *more: str) -> str:
        return re.sub("|".join(map(re.escape, [*self.marks(), *more])), lambda m: self.escape + m[0], text)

    def restore(self, text: str, *more: str) -> str:
        marks = "|".join(map(re.escape, [*self.marks(), *more]))
        return re.sub(re.escape(self.escape) + f"({marks})", lambda m: m[1], text)

    def write_turn(self, role: str, text: str) -> list[tuple[str, bool]]:
        """A turn's segments: head, text, end."""
        head = self.opening + self.protect(role, self.role_end.strip()) + self.role_end
        return [(head, False), (self.protect(text), role in self.loss_roles), (self.closing, False)]

    def read_turns(self, formatted: str) -> Iterator[tuple[str, str]]:
        """Role and text of each turn of a formatted text."""

        def until(stop: str, at: int, *more: str) -> int:
            marks = "|".join(map(re.escape, [*self.marks(), *more]))
            for match in re.compile(f"{re.escape(self.escape)}(?:{marks})|{re.escape(stop)}").finditer(formatted, at):
                if match[0] == stop:
                    return match.start()
            raise ValueError(f"no {stop!r} after {at}")

        at, mark = 0, self.role_end.strip()
        while at < len(formatted):
            if not formatted.startswith(self.opening, at):
                raise ValueError(f"no turn at {at}")
            at += len(self.opening)
            role_end = until(self.role_end, at, mark)
            text_at = role_end + len(self.role_end)
            text_end = until(self.closing, text_at)
            yield self.restore(formatted[at:role_end], mark), self.restore(formatted[text_at:text_end])
            at = text_end + len(self.closing)


# Segments that a turn is written in: head, text, end.
SEGMENTS = 3


class Turns:
    """The machine: one step per turn."""

    def __init__(self, template: Template):
        self.template, self.before, self.in_order = template, "", True

    def step(self, role: str) -> bool:
        """Whether the turn may come here; a turn that may not does not stop the rest from being written."""
        allowed = role in self.template.follows.get(self.before, frozenset())
        self.before = role
        self.in_order = self.in_order and allowed
        return allowed


def _by_conversation(frame: DataFrame, *order: str) -> DataFrame:
    """The rows of a conversation together and in order, so that a task can stream through them."""
    return frame.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def format_turns(conversations: DataFrame, template: Template | None = None) -> DataFrame:
    """Segments of all conversations: conv_id, place, turn_place, segment, loss, allowed.

    Rows of a conversation are taken by turn, then role and text, nulls first; a null text or
    role is empty, rows with a null conv_id are one conversation, repeated rows are turns of their
    own. A turn out of order is written all the same and marked as not allowed. `place` counts
    the segments of a conversation from 0, `turn_place` its turns. Other columns are ignored;
    an empty table gives an empty table.

    A task streams through its sorted rows and holds one batch, however long a conversation is.
    """
    template = template or Template()
    rows = pick(conversations, "conv_id", "turn", "role", "text")
    rows = rows.select("conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, machine, place, turn_place = object(), Turns(template), 0, 0
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            ids, roles, texts = (batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))
            for conv, role, text in zip(ids, roles, texts, strict=True):
                if conv != current:
                    current, machine, place, turn_place = conv, Turns(template), 0, 0
                allowed = machine.step(role)
                for segment, loss in template.write_turn(role, text):
                    for column, value in zip(out, (conv, place, turn_place, segment, loss, allowed), strict=True):
                        column.append(value)
                    place += 1
                turn_place += 1
            kinds = [batch.schema.field("conv_id").type, pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_()]
            arrays = [pa.array(column, kind) for column, kind in zip(out, kinds, strict=True)]
            yield pa.record_batch(arrays, ["conv_id", "place", "turn_place", "segment", "loss", "allowed"])

    kind = kind_of(rows, "conv_id")
    return _by_conversation(rows, "turn", "role", "text").mapInArrow(
        written, f"conv_id {kind}, place long, turn_place long, segment string, loss boolean, allowed boolean"
    )


def read_back(segments: DataFrame, template: Template | None = None) -> DataFrame:
    """What the formatted conversations say: one row each.

    conv_id, n_turns, turns_sha256 (of role, newline, text, newline per turn), loss_chars and
    loss_sha256 (of the unescaped text under the loss flags), formatted_chars, valid (all turns
    allowed, and the last a role to end with). Digests are taken turn by turn while streaming.
    """
    template = template or Template()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]

    class Reading:
        def __init__(self, conv: object):
            self.conv, self.n_turns, self.loss_chars, self.chars = conv, 0, 0, 0
            self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
            self.valid, self.last, self.open = True, "", ""

        def take(self, segment: str, loss: bool, allowed: bool, ends_turn: bool) -> None:
            self.chars += len(segment)
            self.valid = self.valid and allowed
            if loss:
                text = template.restore(segment)
                self.loss_chars += len(text)
                self.loss.update(text.encode())
            self.open += segment
            if ends_turn:
                for role, text in template.read_turns(self.open):
                    self.turns.update(f"{role}\n{text}\n".encode())
                    self.n_turns, self.last = self.n_turns + 1, role
                self.open = ""

        def row(self) -> tuple:
            valid = self.valid and self.last in template.ends
            return (self.conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, valid)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: Reading | None = None
        kinds: list[pa.DataType] = []

        def told(done: list[tuple]) -> pa.RecordBatch:
            columns = zip(*done, strict=True) if done else [[]] * len(names)
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            text, whole = pa.string(), pa.int64()
            kinds = [batch.schema.field("conv_id").type, whole, text, whole, text, whole, pa.bool_()]
            done = []
            columns = (batch.column(c).to_pylist() for c in ("conv_id", "segment", "loss", "allowed", "place"))
            for conv, segment, loss, allowed, place in zip(*columns, strict=True):
                if current is None or conv != current.conv:
                    done += [current.row()] if current else []
                    current = Reading(conv)
                current.take(segment, loss, allowed, ends_turn=place % SEGMENTS == SEGMENTS - 1)
            yield told(done)
        if current:
            yield told([current.row()])

    kind = kind_of(segments, "conv_id")
    return _by_conversation(segments, "place").mapInArrow(
        read,
        f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean",
    )
