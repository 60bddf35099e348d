"""Chat formatting: a state machine over roles checks turn order, a template emits text segments with loss flags.

A template lists the marks before and after each role's texts, whether the text is trained on, and which role may follow which.
The output has a row per segment, so a conversation of any length is formatted in the memory of one turn. Marks that
occur inside a text are escaped, so the formatted conversation can be read back whole.

NULL texts are empty, a NULL role is the role of no name, and rows without a conv_id are one conversation. Turns that share a
number stand in the order of role and text, repeated rows included; NULL turn numbers come first. Roles that the template does
not list get general marks with their name inside and are out of order wherever they stand. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START = ""


@dataclass(frozen=True)
class Role:
    opens: str
    closes: str
    loss: bool = False
    follows: tuple[str, ...] = ()
    may_end: bool = False


@dataclass(frozen=True)
class Template:
    """Marks begin with ``<`` or ``[`` and hold neither sign nor a backslash anywhere else but in doubled first signs."""

    roles: dict[str, Role]
    named: tuple[str, str, str] = ("[ROLE]", "[SAYS]", "[/ROLE]")
    marks: tuple[str, ...] = field(init=False)

    def __post_init__(self) -> None:
        marks = [mark for role in self.roles.values() for mark in (role.opens, role.closes)] + [*self.named]
        if len(set(marks)) != len(marks) or not all(re.fullmatch(r"([<\[])\1?[^<\[\\]+", mark) for mark in marks):
            raise ValueError("marks differ and begin with < or [, which stand nowhere else in them")
        object.__setattr__(self, "marks", tuple(marks))

    def escape(self, text: str) -> str:
        """Double every backslash and put one inside every mark, after its first sign."""
        text = text.replace("\\", "\\\\")
        for mark in self.marks:
            text = text.replace(mark, f"{mark[0]}\\{mark[1:]}")
        return text

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """(segment, loss) of one turn: opening, text, closing."""
        known = self.roles.get(role)
        if known is None:
            opens, says, closes = self.named
            opens, closes, loss = f"{opens}{self.escape(role)}{says}", closes, False
        else:
            opens, closes, loss = known.opens, known.closes, known.loss
        return [(opens, False), (self.escape(text), loss), (closes, False)]

    def allowed(self, state: str, role: str) -> bool:
        return role in self.roles and state in self.roles[role].follows

    def read(self) -> "Reader":
        return Reader(self)


class Reader:
    """Turns of one formatted conversation, fed in pieces cut anywhere; holds one turn at a time."""

    def __init__(self, template: Template):
        self.template = template
        self.pattern = re.compile("|".join(re.escape(m) for m in sorted(template.marks, key=len, reverse=True)))
        self.opens = {role.opens: name for name, role in template.roles.items()}
        self.buffer = ""

    def feed(self, piece: str) -> Iterator[tuple[str, str]]:
        """(role, text) of each turn that is complete now."""
        self.buffer += piece
        while True:
            marks = list(self._marks())
            first = self.template.named[0]
            needed = 3 if marks and marks[0][2] == first else 2
            if len(marks) < needed:
                return
            inner = self.buffer[marks[0][1] : marks[1][0]]
            if needed == 2:
                yield self.opens[marks[0][2]], self.template.unescape(inner)
            else:
                text = self.buffer[marks[1][1] : marks[2][0]]
                yield self.template.unescape(inner), self.template.unescape(text)
            self.buffer = self.buffer[marks[needed - 1][1] :]

    def _marks(self) -> Iterator[tuple[int, int, str]]:
        for found in self.pattern.finditer(self.buffer):
            yield found.start(), found.end(), found.group()


INSTRUCTION = Template(
    {
        "system": Role("<<SYS>>", "<</SYS>>", follows=(START,)),
        "user": Role("[INST]", "[/INST]", follows=(START, "system", "assistant", "tool")),
        "assistant": Role("<s>", "</s>", loss=True, follows=("user", "tool"), may_end=True),
        "tool": Role("[TOOL]", "[/TOOL]", follows=("assistant",)),
    }
)

SEGMENTS = "conv_id long, turn_no long, segment_no long, segment string, loss boolean, role string, in_order boolean"


def _ordered(rows: DataFrame, *order: str) -> DataFrame:
    keys = [F.col(c).asc_nulls_first() for c in ("conv_id", *order)]
    return rows.repartition("conv_id").sortWithinPartitions(*keys)


def format_segments(conversations: DataFrame, template: Template = INSTRUCTION) -> DataFrame:
    """Segments of all conversations (conv_id, turn, role, text), in the order of segment_no.

    ``in_order`` says whether the template lets the turn's role follow the one before it; after a turn out of order the
    machine goes on from that turn's role. ``turn_no`` counts turns from 0.
    """

    def formatted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state, turn = object(), START, 0
        for batch in batches:
            rows = []
            for conv, role, text in zip(batch["conv_id"], batch["role"], batch["text"]):
                conv = None if pd.isna(conv) else int(conv)
                if conv != current:
                    current, state, turn = conv, START, 0
                good = template.allowed(state, role)
                for k, (segment, loss) in enumerate(template.segments(role, text)):
                    rows.append((conv, turn, 3 * turn + k, segment, loss, role, good))
                state, turn = role, turn + 1
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in SEGMENTS.split(", ")])
            yield out.astype({"conv_id": "Int64"})

    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")),
    )
    return _ordered(rows, "turn", "role", "text").mapInPandas(formatted, SEGMENTS)


def verdicts(segments: DataFrame, template: Template = INSTRUCTION) -> DataFrame:
    """One row per conversation: conv_id, first_fault (number of its first turn out of order, NULL for none), complete."""
    last = F.max_by("role", "segment_no")
    ends = [name for name, role in template.roles.items() if role.may_end]
    return segments.groupBy("conv_id").agg(
        F.min(F.when(~F.col("in_order"), F.col("turn_no"))).alias("first_fault"),
        last.isin(ends).alias("complete"),
    )


def valid_segments(segments: DataFrame, template: Template = INSTRUCTION) -> DataFrame:
    """Segments of the conversations whose turns are all in order and that end where they may."""
    good = verdicts(segments, template).where("first_fault IS NULL AND complete").select(F.col("conv_id").alias("id"))
    return segments.join(good, F.col("conv_id").eqNullSafe(F.col("id")), "left_semi")


def read_back(segments: DataFrame, template: Template = INSTRUCTION) -> DataFrame:
    """One row per conversation, parsed from its formatted text: counts and digests of turns and of the trained text.

    conv_id, n_turns, turns_sha256 (role, line feed, text, line feed of each turn), loss_chars, loss_sha256,
    formatted_chars. The conversation is streamed; a turn is the most that is held.
    """

    def parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        current, begun, rows = None, False, []

        def close() -> None:
            rows.append((current, n_turns, turns.hexdigest(), loss_chars, losses.hexdigest(), chars))

        for batch in batches:
            for conv, segment, loss in zip(batch["conv_id"], batch["segment"], batch["loss"]):
                conv = None if pd.isna(conv) else int(conv)
                if not begun or conv != current:
                    if begun:
                        close()
                    current, begun, reader = conv, True, template.read()
                    turns, losses = hashlib.sha256(), hashlib.sha256()
                    n_turns = loss_chars = chars = 0
                chars += len(segment)
                if loss:
                    plain = template.unescape(segment)
                    loss_chars += len(plain)
                    losses.update(plain.encode("utf-8", "surrogatepass"))
                for role, text in reader.feed(segment):
                    n_turns += 1
                    turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
            if rows:
                yield pd.DataFrame(rows, columns=names).astype({"conv_id": "Int64"})
                rows = []
        if begun:
            close()
            yield pd.DataFrame(rows, columns=names).astype({"conv_id": "Int64"})

    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return _ordered(segments.select("conv_id", "segment_no", "segment", "loss"), "segment_no").mapInPandas(parsed, schema)
