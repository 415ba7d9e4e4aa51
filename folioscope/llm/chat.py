"""Chat formatting: a finite-state machine over roles and a declarative template.

A template lists the markers of each role, whether a role's texts count for the
loss, and which role may follow which.  Formatting walks the turns of a
conversation in order, checks each step against the machine, and emits segments
(text, loss flag).  Control strings inside a text or a role name get a backslash
after their first character, and backslashes are doubled, so a formatted
conversation reads back exactly; `read_back` does that.

Turns are taken by (turn, role, text), nulls first.  Rows are sorted within
partitions of the conversation key and streamed, so a worker holds one turn, not
one conversation; only the turns' order ties a conversation to one task.

Defined results: a null text or role counts as empty.  Roles outside the
template use its general marker and break the order.  A conversation out of
order is formatted all the same, with valid false and the first bad turn's
position.  Repeated turns are turns like others.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import limit_batches


@dataclass(frozen=True)
class Turn:
    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """begin opens a conversation; order maps a state ('' at the start) to the roles that may follow; final lists where one may end."""

    begin: str
    turns: dict[str, Turn]
    other: Turn
    other_end: str
    order: dict[str, tuple[str, ...]]
    final: tuple[str, ...]
    controls: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        marks = [self.begin, self.other.open, self.other.close, *(m for t in self.turns.values() for m in (t.open, t.close))]
        object.__setattr__(self, "controls", tuple(dict.fromkeys(marks)))
        firsts = {m[:1] for m in marks}
        if any(len(m) < 2 or "\\" in m or firsts & set(m[1:]) for m in marks):
            raise ValueError("a marker needs a first character that no marker has elsewhere, and no backslash")

    @cached_property
    def _escapes(self) -> re.Pattern:
        return re.compile("(\\\\)|" + "|".join(f"(?<={re.escape(c[0])})(?={re.escape(c[1:])})" for c in sorted(self.controls, key=len, reverse=True)))

    def escape(self, text: str) -> str:
        return self._escapes.sub(lambda m: "\\\\" if m[1] else "\\", text)

    def escape_role(self, role: str) -> str:
        return self.escape(role).replace(self.other_end, "\\" + self.other_end)

    @cached_property
    def _heads(self) -> list[tuple[str, str]]:
        return sorted(((t.open, role) for role, t in self.turns.items()), key=lambda x: -len(x[0]))

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """The segments of one turn."""
        turn = self.turns.get(role)
        head = turn.open if turn else self.other.open + self.escape_role(role) + self.other_end
        turn = turn or self.other
        return [(head, False), (self.escape(text), turn.loss), (turn.close, False)]

    def take(self, formatted: str) -> tuple[str, str, int] | None:
        """The first turn of a string that starts at a turn: role, text and where it ends; None if it isn't all there."""
        for mark, role in self._heads:
            if formatted.startswith(mark):
                turn, at = self.turns[role], len(mark)
                break
        else:
            if not formatted.startswith(self.other.open):
                return None
            m = re.compile(r"((?:[^\\]|\\.)*?)" + re.escape(self.other_end), re.S).match(formatted, len(self.other.open))
            if not m:
                return None
            role, turn, at = unescape(m[1]), self.other, m.end()
        end = formatted.find(turn.close, at)
        return None if end < 0 else (role, unescape(formatted[at:end]), end + len(turn.close))


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


#: Instruction marks in brackets, with begin and end of a model's turn.
INSTRUCT = Template(
    begin="<s>",
    turns={"system": Turn("[SYS]", "[/SYS]"), "user": Turn("[INST]", "[/INST]"), "assistant": Turn("[OUT]", "</s>", loss=True)},
    other=Turn("[TURN ", "[/TURN]"),
    other_end="]",
    order={"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    final=("assistant",),
)

_SEGMENTS = "conv {kind}, position bigint, segment string, loss boolean, error boolean"


def format_chats(turns: DataFrame, template: Template = INSTRUCT, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Segments in order within each partition: (conv, position, segment, loss, error).

    Concatenated by conversation they are the formatted text.  position counts
    the turns from 0, the opening mark has -1; error marks a turn out of order.
    """
    limit_batches(turns.sparkSession)
    kind = turns.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        started, conv, state, at = False, None, "", 0
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for own, who, what in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if not started or own != conv:
                    started, conv, state, at = True, own, "", 0
                    for column, x in zip(out, (own, -1, template.begin, False, False), strict=True):
                        column.append(x)
                bad = who not in template.order.get(state, ())
                for segment, loss in template.segments(who, what):
                    for column, x in zip(out, (own, at, segment, loss, bad), strict=True):
                        column.append(x)
                state, at = who, at + 1
            yield pa.RecordBatch.from_arrays([pa.array(out[0], batch.column(0).type), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()), pa.array(out[3], pa.bool_()), pa.array(out[4], pa.bool_())], names=["conv", "position", "segment", "loss", "error"])

    dealt = turns.select(F.col(key).alias("conv"), F.col(turn).alias("at"), F.coalesce(F.col(role), F.lit("")).alias("who"), F.coalesce(F.col(text), F.lit("")).alias("what"))
    dealt = dealt.repartition("conv").sortWithinPartitions("conv", F.col("at").asc_nulls_first(), "who", "what").select("conv", "who", "what")
    return dealt.mapInArrow(run, _SEGMENTS.format(kind=kind))


class _Reader:
    """Reads one conversation's segments back and takes its digests."""

    def __init__(self, template: Template):
        self.template, self.rest, self.opened = template, "", False
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0
        self.state, self.first_bad = "", None

    def feed(self, position: int, segment: str, loss: bool, bad: bool) -> None:
        self.chars += len(segment)
        if bad and self.first_bad is None:
            self.first_bad = position
        if loss:
            plain = unescape(segment)
            self.loss_chars += len(plain)
            self.loss.update(plain.encode())
        self.rest += segment
        if not self.opened:
            if not self.rest.startswith(self.template.begin):
                raise ValueError("a conversation doesn't start with its mark")
            self.opened, self.rest = True, self.rest[len(self.template.begin) :]
        while found := self.template.take(self.rest):
            self.state, text, end = found
            self.rest = self.rest[end:]
            self.n_turns += 1
            self.turns.update(f"{self.state}\n{text}\n".encode())

    def row(self, conv) -> tuple:
        if self.rest:
            raise ValueError("a formatted conversation doesn't read back")
        valid = self.first_bad is None and self.state in self.template.final
        return conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, valid, self.first_bad


def read_back(segments: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Digests of conversations, parsed from the segments that `format_chats` returns, in their order.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
    valid, first_bad_turn); valid says that the order holds and that the last
    turn may end a conversation.
    """
    kind = segments.schema["conv"].dataType.simpleString()
    schema = f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, valid boolean, first_bad_turn bigint"
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, conv, kinds = None, None, None
        for batch in batches:
            kinds = kinds or [batch.column(0).type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.int64()]
            done = []
            for own, position, segment, loss, bad in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if position < 0:
                    if reader:
                        done.append(reader.row(conv))
                    reader, conv = _Reader(template), own
                reader.feed(position, segment, loss, bad)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), kinds, strict=True)], names=names)
        if reader:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(reader.row(conv), kinds, strict=True)], names=names)

    return segments.mapInArrow(run, schema)
