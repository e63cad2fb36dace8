"""Conversations as training text: a finite-state machine over roles and a declarative template.

The template gives the marks of a turn and the roles whose text is learned. Every turn becomes segments: its opening, its text
and its closing; only the text of a learned role is under the loss. Control strings inside texts are escaped: a backslash is
put after the "<" of every "<", backslashes, "|", and taken out again on reading, so any text comes back as it was.

Turns are streamed in order; memory holds one turn, however long a conversation is.

Defined cases: null text or role is empty; turns of a conversation are ordered by turn (null first), role and text, so
repeated rows are repeated turns; a null conv_id is one conversation; a conversation whose roles break the order is formatted as it
is, with the first turn that broke it; an empty table gives no segments; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.common import Scratch


@dataclass(frozen=True)
class Template:
    """Marks around a turn, learned roles, and the roles that may follow each state."""

    open: str = "<|im_start|>"
    after_role: str = "\n"
    close: str = "<|im_end|>\n"
    learned: tuple[str, ...] = ("assistant",)
    start: str = "start"
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "start": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user", "tool"),
            "tool": ("assistant", "tool"),
        }
    )
    final: tuple[str, ...] = ("assistant",)


CHATML = Template()


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_role(role: str) -> str:
    """A role also must not end its line."""
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def unescape_role(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


_SEGMENTS = "conv_id long, position long, part int, segment string, loss boolean, state_error boolean"


def format_conversations(turns: DataFrame, template: Template = CHATML) -> DataFrame:
    """Segments of ``turns`` (conv_id, turn, role, text): conv_id, position of the turn, part, segment, loss, state_error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, begun, position, state = None, False, 0, template.start
        for batch in batches:
            out: list[tuple] = []
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if not begun or conv != now:
                    now, begun, position, state = conv, True, 0, template.start
                role, text = role or "", text or ""
                wrong = role not in template.follows.get(state, ())
                state = role
                opening = template.open + escape_role(role) + template.after_role
                out.append((conv, position, 0, opening, False, wrong))
                out.append((conv, position, 1, escape(text), role in template.learned, wrong))
                out.append((conv, position, 2, template.close, False, wrong))
                position += 1
            if out:
                names = [c.split()[0] for c in _SEGMENTS.split(", ")]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return (
        turns.select(F.col("conv_id").cast("long"), "turn", "role", "text")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .mapInArrow(run, _SEGMENTS)
    )


_DIGEST = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
    "first_error long, complete boolean"
)


def read_back(segments: DataFrame, template: Template = CHATML) -> DataFrame:
    """Per conversation, parsed from the formatted text and its loss flags: digests, sizes, first turn out of order, and
    whether it ends in a final role."""
    head = re.compile(re.escape(template.open) + r"(.*?)" + re.escape(template.after_role), re.S)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, begun = None, False
        rows: list[tuple] = []

        def reset() -> dict:
            return {"n": 0, "turns": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "all": 0, "error": None, "role": None}

        def close() -> None:
            if begun:
                rows.append((now, s["n"], s["turns"].hexdigest(), s["chars"], s["loss"].hexdigest(), s["all"], s["error"], s["role"] in template.final))

        def out() -> pa.RecordBatch:
            names = [c.split()[0] for c in _DIGEST.split(", ")]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        s = reset()
        for batch in batches:
            for conv, position, part, segment, loss, wrong in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if not begun or conv != now:
                    close()
                    now, begun, s = conv, True, reset()
                s["all"] += len(segment)
                if part == 0:
                    s["role"] = unescape_role(head.fullmatch(segment)[1])
                    s["turns"].update(f"{s['role']}\n".encode())
                elif part == 1:
                    text = unescape(segment)
                    s["turns"].update(f"{text}\n".encode())
                    if loss:
                        s["chars"] += len(text)
                        s["loss"].update(text.encode())
                else:
                    if segment != template.close:
                        raise ValueError(f"conversation {conv} lacks the end of turn {position}")
                    s["n"] += 1
                if wrong and s["error"] is None:
                    s["error"] = position
            if len(rows) >= 1000:
                yield out()
                rows.clear()
        close()
        if rows:
            yield out()

    return (
        segments.select(*(c.split()[0] for c in _SEGMENTS.split(", ")))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "position", "part")
        .mapInArrow(run, _DIGEST)
    )


def write_segments(turns: DataFrame, scratch: Scratch, template: Template = CHATML) -> DataFrame:
    """The formatted segments, written once and read back."""
    return scratch.keep(format_conversations(turns, template), "segments")
