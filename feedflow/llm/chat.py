"""Chat formatting: a finite-state machine over roles, driven by a declarative template.

``segments`` turns rows (conversation, turn, role, text) into text segments in reading order, each with a loss flag; joined
together they are the formatted conversation. ``read_back`` parses that text again. Both keep one open conversation per
task and hold one turn at a time, so a conversation may have any number of turns.

Defined results: null text and null role are empty text; equal turn numbers are ordered by role, then text; repeated rows
are turns of their own; null ``conv_id`` is one conversation; an empty table gives no rows; columns other than the four
are ignored. A conversation that breaks the turn order is formatted all the same and has ``valid`` false.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedflow.llm.shared import prepared


@dataclass(frozen=True)
class Turn:
    """How a role's turn is written: what stands before and after its text, and whether the text is learned."""

    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks of a chat format and the turn order it allows. ``allowed`` maps a state (the last role, or ``start``) to roles."""

    start: str = "<s>"
    turns: dict = field(
        default_factory=lambda: {
            "system": Turn("<<SYS>>\n", "\n<</SYS>>\n"),
            "user": Turn("[INST] ", " [/INST]"),
            "assistant": Turn(" ", "</s>", loss=True),
            "tool": Turn("[TOOL] ", " [/TOOL]"),
        }
    )
    # Roles that the template doesn't name keep their name in the text.
    other: Turn = Turn("[ROLE {}] ", " [/ROLE]")
    allowed: dict = field(
        default_factory=lambda: {
            "start": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user", "tool"),
            "tool": ("tool", "assistant"),
        }
    )
    last: tuple = ("assistant",)


# Every mark of a template holds one of these, so a text in which they are escaped holds no mark.
OPENERS = re.compile(r"[\\<\[\]]")
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
PLAIN = r"([^\\<\[\]]*(?:\\.[^\\<\[\]]*)*)"


def escape(text: str) -> str:
    return OPENERS.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


class Machine:
    """States of one conversation: the last role seen; a role the state doesn't allow makes the conversation invalid."""

    def __init__(self, template: Template) -> None:
        self.template, self.state, self.valid = template, "start", True

    def step(self, role: str) -> None:
        self.valid = self.valid and role in self.template.allowed.get(self.state, ())
        self.state = role

    def ends(self) -> bool:
        return self.valid and self.state in self.template.last

    def write(self, role: str, text: str) -> Iterator[tuple[str, bool]]:
        """The turn's segments with their loss flags."""
        opening = self.template.start if self.state == "start" else ""
        turn = self.template.turns.get(role)
        before = turn.before if turn else self.template.other.before.format(escape(role))
        turn = turn or self.template.other
        self.step(role)
        yield opening + before, False
        yield escape(text), turn.loss
        yield turn.after, False


SEGMENTS = "conv_id bigint, seq bigint, segment string, loss boolean, valid boolean"


def segments(df: DataFrame, template: Template | None = None) -> DataFrame:
    """``conv_id, seq, segment, loss, valid`` in reading order within each task; a conversation lies in one task.

    ``valid`` says whether the turn order holds up to and including this segment; in a conversation's last row,
    which has an empty segment, whether the conversation as a whole is well-formed.
    """
    template = template or Template()
    prepared(df.sparkSession)
    rows = (
        df.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.coalesce("role", F.lit("")).alias("role"),
                  F.coalesce("text", F.lit("")).alias("text"))
        .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, conv, seq, any_row = Machine(template), None, 0, False
        for batch in batches:
            out: list[tuple] = []
            for conv_id, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                if not any_row or conv_id != conv:
                    if any_row:
                        out.append((conv, seq, "", False, machine.ends()))
                    machine, conv, seq, any_row = Machine(template), conv_id, 0, True
                for segment, loss in machine.write(role, text):
                    out.append((conv, seq, segment, loss, machine.valid))
                    seq += 1
            if out:
                yield segment_batch(out)
        if any_row:
            yield segment_batch([(conv, seq, "", False, machine.ends())])

    return rows.mapInArrow(run, SEGMENTS)


def segment_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_())
    names = ["conv_id", "seq", "segment", "loss", "valid"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def reader(template: Template) -> re.Pattern:
    """One turn of formatted text; the group that is set names the role."""
    forms = [
        f"{re.escape(turn.before)}(?P<t{i}>{PLAIN[1:-1]}){re.escape(turn.after)}" for i, turn in enumerate(template.turns.values())
    ]
    before, after = template.other.before.split("{}")
    forms.append(f"{re.escape(before)}(?P<role>{PLAIN[1:-1]}){re.escape(after)}(?P<other>{PLAIN[1:-1]}){re.escape(template.other.after)}")
    return re.compile("|".join(forms), re.DOTALL)


class Reading:
    """Reads one formatted conversation piece by piece and digests its turns and learned text."""

    def __init__(self, template: Template, pattern: re.Pattern) -> None:
        self.template, self.pattern = template, pattern
        self.roles = list(template.turns)
        self.rest, self.opened, self.turns, self.chars, self.loss_chars = "", False, 0, 0, 0
        self.turns_hash, self.loss_hash, self.valid = hashlib.sha256(), hashlib.sha256(), False

    def take(self, segment: str, loss: bool, valid: bool) -> None:
        self.valid = valid
        self.chars += len(segment)
        if loss:
            learned = unescape(segment)
            self.loss_chars += len(learned)
            self.loss_hash.update(learned.encode())
        self.rest += segment
        if not self.opened:
            if not self.rest.startswith(self.template.start):
                return
            self.rest, self.opened = self.rest[len(self.template.start) :], True
        while match := self.pattern.match(self.rest):
            named = {k: v for k, v in match.groupdict().items() if v is not None}
            if "role" in named:
                role, text = unescape(named["role"]), named["other"]
            else:
                ((group, text),) = named.items()
                role = self.roles[int(group[1:])]
            self.turns += 1
            self.turns_hash.update(f"{role}\n{unescape(text)}\n".encode())
            self.rest = self.rest[match.end() :]

    def row(self, conv_id) -> tuple:
        if self.rest:
            raise ValueError(f"conversation {conv_id} does not parse: {self.rest[:80]!r}")
        return (conv_id, self.turns, self.turns_hash.hexdigest(), self.loss_chars, self.loss_hash.hexdigest(), self.chars, self.valid)


DIGESTS = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
           "formatted_chars bigint, valid boolean")


def read_back(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """Parse the output of ``segments`` again: one row of digests per conversation.

    It reads the joined text, not the segment bounds, so it fails if a text could pass for a mark.
    """
    template = template or Template()
    pattern = reader(template)
    names = [part.split()[0] for part in DIGESTS.split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())

    def rows(found: list[tuple]) -> pa.RecordBatch:
        columns = zip(*found, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reading, conv = None, None
        for batch in batches:
            out: list[tuple] = []
            for conv_id, seq, segment, loss, valid in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if reading is None or seq == 0:
                    if reading is not None:
                        out.append(reading.row(conv))
                    reading, conv = Reading(template, pattern), conv_id
                reading.take(segment, loss, valid)
            if out:
                yield rows(out)
        if reading is not None:
            yield rows([reading.row(conv)])

    return formatted.select("conv_id", "seq", "segment", "loss", "valid").mapInArrow(run, DIGESTS)
