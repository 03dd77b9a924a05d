"""Chat formatting by a finite-state machine over roles.

A declarative ``Template`` names the roles, the allowed successions and the
control strings around a turn.  The machine streams over the turns of each
conversation in order, notes whether the succession is allowed, and emits per
turn the segments (text, in the loss or not).  A text's escape characters and
control strings get an escape character in front, so the formatted text has
exactly one reading; ``read_back`` takes it apart again.

Conversations are brought together by a shuffle on their id and a sort; tasks
hold one turn at a time, so a conversation of any length needs no more memory
than its longest turn.

Defined results: null text is empty; null role is the empty role, which like
any unknown role gets the generic header and makes the conversation invalid;
turns are ordered by turn (null first), then role and text, and repeated rows are
turns of their own; rows with a null conversation id are one conversation; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEGMENTS = "array<struct<text: string, loss: boolean>>"


@dataclass
class Template:
    headers: dict[str, str] = field(default_factory=lambda: {
        "system": "### System: ", "user": "### User: ", "assistant": "### Assistant: "})
    other: tuple[str, str] = ("### Role <", ">: ")  # header of any other role
    footer: str = " </turn>\n"
    escape: str = "\\"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: from each state the roles that may follow; "" is the start
    after: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    final: tuple[str, ...] = ("user", "assistant")

    def controls(self) -> list[str]:
        """All control strings, without the white space at their ends."""
        found = [*self.headers.values(), *self.other, self.footer, self.escape]
        return sorted({c.strip() for c in found}, key=lambda c: (-len(c), c))


class Codec:
    """Escaping, writing and reading of single turns."""

    def __init__(self, t: Template):
        self.t = t
        some = "|".join(map(re.escape, t.controls()))
        self.guard = re.compile(f"({some})")
        self.plain = re.compile(re.escape(t.escape) + f"({some})")
        skip = f"(?:{re.escape(t.escape)}(?:{some})|[^{re.escape(t.escape)}])*?"
        known = "|".join(f"(?P<r{i}>{re.escape(h)})" for i, h in enumerate(t.headers.values()))
        self.turn = re.compile(f"(?:{known}|{re.escape(t.other[0])}(?P<role>{skip}){re.escape(t.other[1])})"
                               f"(?P<text>{skip}){re.escape(t.footer)}")

    def escaped(self, text: str) -> str:
        return self.guard.sub(lambda m: self.t.escape + m[1], text)

    def unescaped(self, text: str) -> str:
        return self.plain.sub(lambda m: m[1], text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        head = self.t.headers.get(role) or self.t.other[0] + self.escaped(role) + self.t.other[1]
        return [(head, False), (self.escaped(text), role in self.t.loss_roles), (self.t.footer, False)]

    def read(self, formatted: str) -> Iterator[tuple[str, str]]:
        """(role, text) of the turns of a formatted text."""
        at, roles = 0, list(self.t.headers)
        while at < len(formatted):
            m = self.turn.match(formatted, at)
            if not m:
                raise ValueError(f"no turn at character {at}")
            role = next((r for i, r in enumerate(roles) if m[f"r{i}"] is not None), None)
            yield self.unescaped(m["role"]) if role is None else role, self.unescaped(m["text"])
            at = m.end()


def _formatting(t: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, state, conv, begun, nth = Codec(t), "", None, False, 0
        for b in batches:
            out = []
            for c, role, text in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if not begun or c != conv:
                    begun, conv, state, nth = True, c, "", 0
                role = role or ""
                allowed = state is not None and role in t.after.get(state, ())
                state = role if allowed else None  # None: the conversation is invalid from here on
                out.append({"conv": c, "nth": nth, "role": role, "allowed": allowed,
                            "may_end": state is not None and state in t.final,
                            "segments": [{"text": x, "loss": y} for x, y in codec.segments(role, text or "")]})
                nth += 1
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("conv", pa.int64()), ("nth", pa.int64()), ("role", pa.string()), ("allowed", pa.bool_()),
                ("may_end", pa.bool_()),
                ("segments", pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())])))]))
    return run


def format_turns(turns: DataFrame, template: Template | None = None, conv_col: str = "conv_id",
                 turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, nth, role, allowed, may_end, segments) per turn, the turns of a
    conversation together and in order in one partition."""
    src = turns.select(F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
                       F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    return src.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text") \
        .select("conv", "role", "text") \
        .mapInArrow(_formatting(template or Template()),
                    f"conv long, nth long, role string, allowed boolean, may_end boolean, segments {SEGMENTS}")


def _reading(t: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, conv, row, turns, loss = Codec(t), None, None, None, None
        kind = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                          ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                          ("valid", pa.bool_())])

        def finished() -> dict:
            return row | {"turns_sha256": turns.hexdigest(), "loss_sha256": loss.hexdigest(),
                          "valid": row["valid"] and row["end"]}

        for b in batches:
            out = []
            for c, allowed, may_end, segments in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if row is None or c != conv:
                    if row is not None:
                        out.append(finished())
                    conv, turns, loss = c, hashlib.sha256(), hashlib.sha256()
                    row = {"conv_id": c, "n_turns": 0, "loss_chars": 0, "formatted_chars": 0, "valid": True}
                formatted = "".join(s["text"] for s in segments)
                for role, text in codec.read(formatted):
                    row["n_turns"] += 1
                    turns.update(f"{role}\n{text}\n".encode())
                masked = codec.unescaped("".join(s["text"] for s in segments if s["loss"]))
                loss.update(masked.encode())
                row["loss_chars"] += len(masked)
                row["formatted_chars"] += len(formatted)
                row["valid"] &= allowed
                row["end"] = may_end
            yield pa.RecordBatch.from_pylist([{k: r[k] for k in kind.names} for r in out], kind)
        if row is not None:
            yield pa.RecordBatch.from_pylist([{k: finished()[k] for k in kind.names}], kind)
    return run


def read_back(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """Per conversation what its formatted text says: turns, digests of the
    turns and of the text under the loss mask, and whether the order is valid.
    Takes the rows of ``format_turns`` where they lie, without a shuffle."""
    return formatted.select("conv", "allowed", "may_end", "segments").mapInArrow(
        _reading(template or Template()),
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, valid boolean")
