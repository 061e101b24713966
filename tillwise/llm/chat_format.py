"""Chat formatting with a renderer known only from outside: turns are located by rendering prefixes.

A renderer maps a list of ``(role, text)`` to one string. For each conversation its prefixes of 0, 1, 2, ...
turns are rendered. If each output begins with the one before, the difference is the turn's span. The text
inside the span is found by rendering the prefix once more with a probe character in place of the text: what
stands before and after the probe frames the text. A prefix whose output does not begin with the previous one
shows that the template rewrites history; ``rewritten_at`` is the first such turn (from 0), and spans are
then null, since no turn has a fixed place.

``BRACKETS`` marks turns by ``[ROLE]`` strings and escapes the characters of its control strings inside texts
and roles, so that no text can open or close a turn; ``unescape`` reverses it and ``read_back`` recovers the
turns from the formatted string alone.

Defined cases: turns go by (turn, role, text), nulls first, so repeated turn numbers and repeated rows have
one order and each row is a turn; a null text or role is empty; rows of a null id form one conversation; an
empty table gives an empty result; other columns are ignored. A conversation is one output string, so one
task holds it; tasks read the sorted rows as a stream and hold one conversation at a time. Rendering prefixes
takes time in the square of a conversation's turns, which is the price of knowing nothing about the template.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import udf

Turn = tuple[str, str]
Renderer = Callable[[list[Turn]], str]

_ESCAPES = {"\\": "\\\\", "[": "\\(", "]": "\\)", "<": "\\{", ">": "\\}"}
_PLAIN = {escaped[1]: char for char, escaped in _ESCAPES.items()}
_TABLE = str.maketrans(_ESCAPES)
_MARKED = re.compile(r"<s>\[ROLE\]([^\[\]<>]*)\[TEXT\]([^\[\]<>]*)\[END\]</s>\n")
_ROWS = 1000
_CHARS = 1 << 24


def escape(text: str) -> str:
    return text.translate(_TABLE)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _PLAIN[m[1]], text, flags=re.DOTALL) if "\\" in text else text


class _Remembered(dict):
    """Escaped texts of the conversation at hand, which is rendered again and again; forgotten beyond ``_CHARS``."""

    chars = 0

    def __missing__(self, text: str) -> str:
        if self.chars > _CHARS:
            self.clear()
            self.chars = 0
        escaped = self[text] = escape(text)
        self.chars += len(escaped)
        return escaped


_ESCAPED = _Remembered()


def BRACKETS(turns: list[Turn]) -> str:  # noqa: N802
    return "".join([f"<s>[ROLE]{_ESCAPED[role]}[TEXT]{_ESCAPED[text]}[END]</s>\n" for role, text in turns])


def read_back(formatted: str) -> list[Turn]:
    """The turns of a string made by ``BRACKETS``; an error if anything else stands in it."""
    turns, at = [], 0
    for m in _MARKED.finditer(formatted):
        if m.start() != at:
            break
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"no turn at character {at}")
    return turns


def locate(turns: list[Turn], render: Renderer) -> tuple[str, int | None, list[tuple[int, int, int, int] | None]]:
    """Output for all turns, the first turn that rewrites history, and (start, text start, text end, end) per turn."""
    before, spans = render([]), []
    for n, (role, text) in enumerate(turns, 1):
        after = render(turns[:n])
        if not after.startswith(before):
            return render(turns), n - 1, [None] * len(turns)
        spans.append((len(before), *_text_span(turns[: n - 1], role, text, render, before, after), len(after)))
        before = after
    return before, None, spans


def _text_span(earlier: list[Turn], role: str, text: str, render: Renderer, before: str, after: str) -> tuple[int, int]:
    """Place of the last turn's text in ``after``; an empty place at the end if the template shows no text."""
    for probe in map(chr, range(0xE000, 0xF900)):  # private-use characters; one that the turn does not hold
        if probe in text or probe in role:
            continue
        probed = render([*earlier, (role, probe)])
        own = probed[len(before):] if probed.startswith(before) else ""
        if own.count(probe) != 1:
            continue
        head, tail = own.split(probe)
        start, end = len(before) + len(head), len(after) - len(tail)
        if start <= end and after.startswith(head, len(before)) and after.endswith(tail):
            return start, end
    return len(after), len(after)


_SPAN = T.StructType().add("role", "string").add("start", "integer").add("text_start", "integer").add("text_end", "integer").add("end", "integer").add("loss", "boolean")
_OUT = T.StructType().add("conv_id", "long").add("formatted", "string").add("rewritten_at", "integer").add("spans", T.ArrayType(_SPAN))
_ARROW_SPAN = pa.struct([("role", pa.string()), *[(k, pa.int32()) for k in ("start", "text_start", "text_end", "end")], ("loss", pa.bool_())])
_ARROW = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()), ("rewritten_at", pa.int32()), ("spans", pa.list_(_ARROW_SPAN))])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            part = batch.slice(start, _ROWS)
            yield from zip(*[column.to_pylist() for column in part.columns])


def _formatter(render: Renderer, loss_role: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, chars = [], 0
        for conv_id, rows in groupby(_rows(batches), key=lambda row: row[0]):
            turns = [(role or "", text or "") for _, role, text in rows]
            formatted, rewritten, places = locate(turns, render)
            spans = None if rewritten is not None else [
                dict(zip(("role", "start", "text_start", "text_end", "end", "loss"), (role, *place, role == loss_role)))
                for (role, _), place in zip(turns, places)
            ]
            done.append({"conv_id": conv_id, "formatted": formatted, "rewritten_at": rewritten, "spans": spans})
            chars += len(formatted)
            if len(done) >= _ROWS or chars > 1 << 24:
                yield pa.RecordBatch.from_pylist(done, _ARROW)
                done, chars = [], 0
        if done:
            yield pa.RecordBatch.from_pylist(done, _ARROW)

    return run


def format_conversations(conversations: DataFrame, render: Renderer = BRACKETS, *, loss_role: str = "assistant") -> DataFrame:
    """``(conv_id, formatted, rewritten_at, spans)``: one row per conversation of ``(conv_id, turn, role, text)``.

    ``spans`` has, per turn, its place and the place of its text in code points of ``formatted``; ``loss`` is
    true for turns of ``loss_role``, whose text spans are the loss mask.
    """
    rows = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", "role", "text").repartition("conv_id")
    ordered = rows.sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return ordered.mapInArrow(_formatter(render, loss_role), _OUT)


@udf(T.StructType().add("n_turns", "long").add("turns_sha256", "string").add("loss_chars", "long").add("loss_sha256", "string").add("formatted_chars", "long"), useArrow=True)
def _digest(formatted, spans):
    turns = read_back(formatted)
    every = hashlib.sha256()
    for role, text in turns:
        every.update(f"{role}\n{text}\n".encode())
    loss, chars = hashlib.sha256(), 0
    for span in spans:
        if span["loss"]:
            text = unescape(formatted[span["text_start"]: span["text_end"]])
            loss.update(text.encode())
            chars += len(text)
    return len(turns), every.hexdigest(), chars, loss.hexdigest(), len(formatted)


def digest(formatted: DataFrame) -> DataFrame:
    """Digests of what ``format_conversations`` wrote with ``BRACKETS``, read back from its strings and spans."""
    return formatted.select("conv_id", _digest("formatted", "spans").alias("d")).select("conv_id", "d.*")
