r"""Chat formatting: a finite-state machine over roles, driven by a declarative template.

A template names, for every role, the text before and after a turn and whether
the turn's own text is under the loss; and, for every state, which roles may
follow.  Turns are read in order; the machine emits text segments, each with a
loss flag, and marks a turn that the current state does not allow as not
valid (it is formatted all the same, and the machine goes on from its role).
Read back, a conversation shows how many turns were out of order and whether it
ends in a final state (one that stops at a user's turn does not).

Control strings inside texts are made harmless and come back exactly: a
backslash doubles, and one more is put behind the first character of every place
where a control string starts.  So a control string in the output is always the
template's own, and removing one backslash before any character restores the
text.  A template is checked when it is built: control strings hold no
backslash, and none can arise across the seam of a text and a marker.

Turns are shuffled once by conversation and sorted by turn (ties: role, then text);
tasks stream over them with the state of one conversation, so the length
of a conversation is not bounded by memory.

Defined results: null text and null role are empty; an unknown or empty role uses
the template's ``other`` form, which carries the escaped role; a null conversation
id is a conversation of its own; null turns come last; repeated rows are turns of their own; an
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warnindex.llm.common import arrow_rows

START = None  # the state before the first turn; no role, an empty one neither, leads back to it


@dataclass(frozen=True)
class Turn:
    before: str
    after: str
    loss: bool = False
    after_loss: bool = False  # the closing marker (end of sequence) is learnt too


@dataclass(frozen=True)
class Template:
    roles: dict[str, Turn]
    other: Turn  # ``before`` and ``after`` surround the role; the text follows up to ``close``
    close: str
    follows: dict[str | None, tuple[str, ...]]  # state -> roles that may come next; the role is the next state
    final: tuple[str, ...] = ("assistant",)
    controls: tuple[str, ...] = ()
    _break: re.Pattern = field(init=False, repr=False, compare=False)

    def __post_init__(self):
        marks = [t for r in self.roles.values() for t in (r.before, r.after)] + [self.other.before, self.other.after, self.close]
        for c in self.controls:
            if len(c) < 2 or "\\" in c:
                raise ValueError(f"control string {c!r} is too short or holds the escape character")
            for m in marks:
                for n in range(1, len(c)):
                    if m.startswith(c[n:]):
                        raise ValueError(f"{c!r} could arise across the seam before {m!r}")
                    if m.endswith(c[:n]):
                        raise ValueError(f"{c!r} could arise across the seam after {m!r}")
        for m in marks:
            if not any(c in m for c in self.controls):
                raise ValueError(f"marker {m!r} holds no control string")
        if len({t.before for t in self.roles.values()} | {self.other.before}) != len(self.roles) + 1:
            raise ValueError("roles need markers of their own")
        object.__setattr__(self, "_break", re.compile("(?=" + "|".join(map(re.escape, self.controls)) + ")"))

    def escape(self, text: str) -> str:
        out, at, s = [], 0, text.replace("\\", "\\\\")
        for m in self._break.finditer(s):
            out.append(s[at:m.start() + 1] + "\\")
            at = m.start() + 1
        return "".join(out) + s[at:]


_ESCAPED = re.compile(r"\\(.)", re.S)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


INST = Template(
    roles={
        "system": Turn("<<SYS>>\n", "\n<</SYS>>\n"),
        "user": Turn("[INST] ", " [/INST]"),
        "assistant": Turn("<s> ", " </s>\n", loss=True, after_loss=False),
    },
    other=Turn("[ROLE] ", " [/ROLE] "),
    close=" [/END]\n",
    follows={START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    final=("assistant",),
    controls=("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[/END]"),
)

SEGMENTS = "conv_id long, seq long, role string, text string, loss boolean, valid boolean"


class Machine:
    """Formats the turns of one conversation, one after the other."""

    def __init__(self, t: Template):
        self.t, self.state, self.seq = t, START, 0

    def turn(self, role: str, text: str) -> Iterator[tuple[int, str, str, bool, bool]]:
        t = self.t
        valid = role in t.follows.get(self.state, ())
        form = t.roles.get(role)
        if form is None:
            parts = [(t.other.before + t.escape(role) + t.other.after, False), (t.escape(text), t.other.loss), (t.close, False)]
        else:
            parts = [(form.before, False), (t.escape(text), form.loss), (form.after, form.after_loss)]
        for s, loss in parts:
            yield self.seq, role, s, loss, valid
            self.seq += 1
        self.state = role


def ordered(turns: DataFrame, id_col: str, *order) -> DataFrame:
    return turns.repartition(id_col).sortWithinPartitions(F.col(id_col).asc_nulls_first(), *order)


def format_chats(turns: DataFrame, template: Template = INST, id_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Text segments in order: conv_id, seq, role, text, loss, valid."""
    t = turns.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
                     F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    t = ordered(t, "conv_id", F.col("turn").asc_nulls_last(), "role", "text")

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, machine = object(), None
        for b in arrow_rows(batches):
            out = []
            for conv, role, text in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                if conv != now:
                    now, machine = conv, Machine(template)
                out.extend((conv, *s) for s in machine.turn(role, text))
            cols = list(zip(*out))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["conv_id", "seq", "role", "text", "loss", "valid"])

    return t.mapInArrow(go, SEGMENTS)


class Reader:
    """Reads the formatted text of one conversation back, piece by piece, without
    knowing the turns: only the template's markers separate them.  ``feed`` takes
    pieces cut anywhere but inside a control string's marker, with their loss flag."""

    def __init__(self, t: Template):
        self.t = t
        opens = {r.before: (name, r.after) for name, r in t.roles.items()}
        opens[t.other.before] = (None, t.other.after)
        self.opens = opens
        self.start = re.compile("|".join(map(re.escape, opens)))
        self.role = self.until = None
        self.named = False
        self.turns, self.chars, self.loss_chars = 0, 0, 0
        self.state, self.invalid = START, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()
        self.rest = ""

    def feed(self, piece: str, loss: bool) -> None:
        self.chars += len(piece)
        if loss:
            plain = unescape(piece)
            self.loss_chars += len(plain)
            self.loss.update(plain.encode("utf-8", "surrogatepass"))
        s = self.rest + piece
        while s:
            if self.until is None:
                m = self.start.match(s)
                if not m:
                    break
                name, self.until = self.opens[m[0]]
                self.named = name is None
                self.role = name
                s = s[m.end():]
                if not self.named:
                    self._head()
            else:
                end = s.find(self.until)
                if end < 0:
                    keep = s
                    s = ""
                    self.rest = keep
                    return
                body, s = unescape(s[:end]), s[end + len(self.until):]
                if self.named:
                    self.role, self.named, self.until = body, False, self.t.close
                    self._head()
                else:
                    self.all.update(body.encode("utf-8", "surrogatepass") + b"\n")
                    self.turns, self.until = self.turns + 1, None
        self.rest = s

    def _head(self) -> None:
        self.invalid += self.role not in self.t.follows.get(self.state, ())
        self.state = self.role
        self.all.update(self.role.encode("utf-8", "surrogatepass") + b"\n")

    def done(self) -> tuple[int, str, int, str, int]:
        if self.rest or self.until is not None:
            raise ValueError("formatted text ends inside a turn")
        return self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


    def order(self) -> tuple[int, bool]:
        """Turns that their state did not allow, and whether the last one leaves a final state."""
        return self.invalid, self.state in self.t.final


def read_back(segments: DataFrame, template: Template = INST) -> DataFrame:
    """Digests of every conversation and the order of its turns (``invalid_turns``, ``complete``), recovered from the
    formatted text and its loss flags."""
    s = ordered(segments.select("conv_id", "seq", "text", "loss"), "conv_id", "seq")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "invalid_turns", "complete"]

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, reader = object(), None

        def batch(rows):
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for b in arrow_rows(batches):
            out = []
            for conv, text, loss in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                if conv != now:
                    if reader is not None:
                        out.append((now, *reader.done(), *reader.order()))
                    now, reader = conv, Reader(template)
                reader.feed(text, loss)
            if out:
                yield batch(out)
        if reader is not None:
            yield batch([(now, *reader.done(), *reader.order())])

    return s.mapInArrow(go, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
                           "invalid_turns long, complete boolean")
