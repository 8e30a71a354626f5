"""Chat formatting: a state machine over roles and a declarative template make training text.

Each turn becomes three segments, opening mark, text and closing mark, with a flag that says whether
the segment counts for the loss. Control strings inside texts are broken by an escape character, and
``read_back`` undoes that, so formatted text always parses back to the turns it came from.

Both directions stream over rows sorted by conversation and turn: memory holds one turn, however long a
conversation is. A conversation stays in one task because its text, like a digest over it, has an order.

Null texts and roles count as empty. Turns with equal numbers are ordered by role and text, a null turn comes first;
repeated rows are repeated turns. A null ``conv_id`` is a conversation of its own. Roles without marks of their own
are written with their name. Turn orders that the machine refuses are formatted all the same and
marked as not valid. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"

#: Which role may follow which ("" is the start), and where a conversation may end.
TRANSITIONS = {
    ("", "system"), ("", "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user"),
}
FINAL_ROLES = {"assistant"}


@dataclass(frozen=True)
class Template:
    """Marks around the turns of each role; what stands under the loss; how other roles are written."""

    marks: dict[str, tuple[str, str]] = field(
        default_factory=lambda: {
            "system": ("<<SYS>>", "<</SYS>>"),
            "user": ("[INST] ", " [/INST]"),
            "assistant": ("<s>", "</s>"),
        }
    )
    other: tuple[str, str, str] = ("[TURN]", "[AS]", "[/TURN]")
    loss_roles: frozenset[str] = frozenset({"assistant"})

    def __post_init__(self) -> None:
        marks = [m for pair in self.marks.values() for m in pair] + list(self.other)
        bare = self.controls()
        if len(set(bare)) < len(bare):
            raise ValueError("every mark needs a control string of its own")
        for control in bare:
            if len(control) < 2 or ESCAPE in control:
                raise ValueError(f"{control!r} can't be escaped")
            for cut in range(1, len(control)):
                tail = control[cut:]
                if any(m.startswith(tail) or tail.startswith(m) for m in marks):
                    raise ValueError(f"{control!r} can form across the end of a text")

    def controls(self) -> list[str]:
        return [m.strip() for pair in self.marks.values() for m in pair] + list(self.other)

    def opening(self, role: str) -> tuple[str, str]:
        if role in self.marks:
            return self.marks[role]
        return self.other[0] + self.escape(role) + self.other[1], self.other[2]

    def escape(self, text: str) -> str:
        text = text.replace(ESCAPE, ESCAPE * 2)
        found = "|".join(map(re.escape, self.controls()))
        return re.sub(f"(?=(?:{found}))(.)", lambda m: m[1] + ESCAPE, text, flags=re.S)

    def unescape(self, text: str) -> str:
        return re.sub(r"\\(\\?)", r"\1", text)

    def parse(self, text: str, at: int = 0) -> tuple[str, str, int] | None:
        """``(role, text, end)`` of the turn at ``at``; None while it isn't whole."""
        for role, (before, after) in self.marks.items():
            if text.startswith(before, at):
                control = after.strip()
                close = text.find(control, at + len(before))
                if close < 0:
                    return None
                start = close - after.index(control)
                return role, self.unescape(text[at + len(before) : start]), start + len(after)
        opening, named, closing = self.other
        if text.startswith(opening, at):
            name = text.find(named, at)
            close = text.find(closing, at)
            if name < 0 or close < 0:
                return None
            role = self.unescape(text[at + len(opening) : name])
            return role, self.unescape(text[name + len(named) : close]), close + len(closing)
        if any(len(text) - at < len(m) and m.startswith(text[at:]) for m in (*(b for b, _ in self.marks.values()), opening)):
            return None
        raise ValueError(f"no mark at {at}")


def ordered_turns(turns: DataFrame) -> DataFrame:
    """Conversations side by side in partitions, their turns in order; ids as text, so null stays null."""
    plain = turns.select(
        F.col("conv_id").cast("string").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    return plain.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def format_turns(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """``conv_id, segment, text, loss, valid``: the segments of every conversation, in order.

    ``valid`` is true while the machine accepts the roles so far and, at the segment that ends a
    turn, tells whether the conversation might end there.
    """
    template = template or Template()

    def segments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state, number, fine, began = None, "", 0, True, False
        for frame in frames:
            out = []
            for conv, role, text in zip(frame["conv_id"].to_list(), frame["role"], frame["text"]):
                if not began or conv != current:
                    current, state, number, fine, began = conv, "", 0, True, True
                fine = fine and (state, role) in TRANSITIONS
                state = role
                before, after = template.opening(role)
                ends = fine and role in FINAL_ROLES
                out += [
                    (conv, number, before, False, fine),
                    (conv, number + 1, template.escape(text), role in template.loss_roles, fine),
                    (conv, number + 2, after, False, ends),
                ]
                number += 3
            yield pd.DataFrame(out, columns=["conv_id", "segment", "text", "loss", "valid"])

    schema = "conv_id string, segment long, text string, loss boolean, valid boolean"
    return ordered_turns(turns).mapInPandas(segments, schema)


def read_back(segments: DataFrame, template: Template | None = None) -> DataFrame:
    """One row per conversation, parsed from formatted segments that stand in order.

    ``turns_sha256`` covers role, line feed, text, line feed of each turn; ``loss_sha256`` the unescaped text
    under the loss mask.
    """
    template = template or Template()
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]

    class Reader:
        def __init__(self, conv) -> None:
            self.conv, self.turns, self.loss_chars, self.chars, self.valid = conv, 0, 0, 0, False
            self.all, self.loss, self.pending = hashlib.sha256(), hashlib.sha256(), ""

        def take(self, text: str, loss: bool, valid: bool) -> None:
            self.chars += len(text)
            self.valid = valid
            if loss:
                plain = template.unescape(text)
                self.loss_chars += len(plain)
                self.loss.update(plain.encode())
            self.pending += text
            while self.pending and (turn := template.parse(self.pending)):
                role, plain, end = turn
                self.turns += 1
                self.all.update(f"{role}\n{plain}\n".encode())
                self.pending = self.pending[end:]

        def row(self):
            if self.pending:
                raise ValueError(f"conversation {self.conv} ends inside a turn")
            return (self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.valid)

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = None
        for frame in frames:
            out = []
            for conv, text, loss, valid in zip(frame["conv_id"].to_list(), frame["text"], frame["loss"], frame["valid"]):
                if reader is None or conv != reader.conv:
                    if reader is not None:
                        out.append(reader.row())
                    reader = Reader(conv)
                reader.take(text, bool(loss), bool(valid))
            yield pd.DataFrame(out, columns=columns)
        if reader is not None:
            yield pd.DataFrame([reader.row()], columns=columns)

    schema = (
        "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, valid boolean"
    )
    return segments.mapInPandas(read, schema).withColumn("conv_id", F.col("conv_id").cast("long"))
