"""Chat formatting by a grammar round trip.

    turn := "### " role ":\\n" text "\\n</turn>\\n"

A text may not hold a bare control string (### or </turn>); one after backslashes stands for itself
with a backslash less.  Each turn is rendered as it is and parsed again; while the parser does not
return the same role and text, its control strings get a backslash more.  The loss mask covers the
texts of assistant turns.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The grammar's control strings and the roles with names of their own.
_CONTROL = re.compile(r"(\\*)(###|</turn>)")
_HEAD = re.compile(r"### ([^\n]*):\n")
_END = "\n</turn>\n"
ROLES = {"user": "User", "assistant": "Assistant", "system": "System"}
_NAMES = {v: k for k, v in ROLES.items()}


def escape(text: str) -> str:
    return _CONTROL.sub(r"\\\1\2", text)


def unescape(text: str) -> str:
    """Raises on a bare control string."""

    def less(m: re.Match) -> str:
        if not m[1]:
            raise ValueError(f"bare {m[2]} at {m.start()}")
        return m[0][1:]

    return _CONTROL.sub(less, text)


def render(role: str, text: str) -> str:
    return f"### {ROLES.get(role) or '%' + quote(role, safe='')}:\n{text}{_END}"


def parse(data: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, text, start and end of the text in `data`) of each turn; raises where the grammar does not hold."""
    at = 0
    while at < len(data):
        head = _HEAD.match(data, at)
        if not head:
            raise ValueError(f"no turn at {at}")
        end = data.find(_END, head.end())
        if end < 0:
            raise ValueError(f"turn at {at} has no end")
        name = head[1]
        role = _NAMES[name] if name in _NAMES else unquote(name[1:]) if name[:1] == "%" else None
        if role is None:
            raise ValueError(f"unknown role {name!r}")
        yield role, unescape(data[head.end() : end]), head.end(), end
        at = end + len(_END)


def formatted(role: str | None, text: str | None) -> tuple[str, int, int]:
    """A turn that parses back to its role and text, and where its text stands."""
    role, text = role or "", text or ""
    inside = text
    for _ in range(3):
        data = render(role, inside)
        try:
            turns = list(parse(data))
        except ValueError:
            turns = []
        if [t[:2] for t in turns] == [(role, text)]:
            return data, turns[0][2], turns[0][3]
        inside = escape(inside if turns else text)
    raise ValueError("turn does not survive its round trip")


def format_turns(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Per row: conv_id, turn, formatted text, and start and end of its loss span (both null but for
    assistant turns).  Null roles and texts are empty; each row is a turn, repeated ones too."""
    rows = rows.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            roles, texts = b.column(2).to_pylist(), b.column(3).to_pylist()
            out = [formatted(r, t) for r, t in zip(roles, texts)]
            spans = [[x[k] if r == "assistant" else None for x, r in zip(out, roles)] for k in (1, 2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([x[0] for x in out], pa.string()), *(pa.array(s, pa.int64()) for s in spans)], ["conv_id", "turn", "formatted", "loss_start", "loss_end"]
            )

    return rows.mapInArrow(run, "conv_id long, turn long, formatted string, loss_start long, loss_end long")


def read_back(turns: DataFrame) -> DataFrame:
    """Per conversation, parsed from its formatted turns: n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars.

    Turns stand by number, those with equal numbers by their formatted text; null numbers first, and
    rows without a conversation id form one conversation.  A conversation is hashed as its sorted
    turns stream by, so a long one needs no more memory than a short one.
    """
    rows = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "formatted")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: list | None = None  # conversation, turns, their hash, loss characters, their hash, characters

        def row(c: list) -> tuple:
            return c[0], c[1], c[2].hexdigest(), c[3], c[4].hexdigest(), c[5]

        for b in batches:
            done = []
            for conv, _, text, start, end in zip(*(c.to_pylist() for c in b.columns)):
                if now is None or now[0] != conv:
                    if now is not None:
                        done.append(row(now))
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said, _, _ in parse(text):
                    now[1] += 1
                    now[2].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                if start is not None:
                    loss = unescape(text[start:end])
                    now[3] += len(loss)
                    now[4].update(loss.encode("utf-8", "surrogatepass"))
                now[5] += len(text)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row(now), kinds)], names)

    return rows.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
