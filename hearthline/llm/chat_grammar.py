r"""Chat formatting with a grammar round trip.

A turn is rendered as `<|im_start|>role\ntext<|im_end|>\n`. A deterministic parser reads the rendered turn
back; where the turns it recovers differ from the source, the conflicting field is escaped, and the turn is
rendered and parsed again until both are identical. Escaping puts a backslash after the `<` of every
`<|`, `<\|`, `<\\|`, ...; the parser takes one away from every `<\|`, `<\\|`, ... . In roles, backslashes
and newlines are escaped too. Every turn parses on its own, and a rendered turn holds no control string but
its own two, so a conversation, being its turns one after another, parses into just these turns.

Turns are rendered in parallel; a conversation of any length is then read as a sorted stream, turn by turn,
and only running digests are held.

Defined cases: a null text or role is empty; turns are ordered by turn (null first), role, text, and
repeated rows are repeated turns; a null conv_id is a conversation of its own; an empty table gives no rows;
other columns are ignored. The loss mask covers the texts of the turns whose role is `assistant`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The control strings of the template.
START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"

_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END), re.S)
_MARK = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_ROLE_CODE = {"\\": "\\\\", "\n": "\\n"}
_ROLE_PLAIN = {v: k for k, v in _ROLE_CODE.items()}


def escape(text: str) -> str:
    return _MARK.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def _escape_role(role: str) -> str:
    return re.sub(r"[\\\n]", lambda m: _ROLE_CODE[m[0]], escape(role))


def _unescape_role(role: str) -> str:
    return unescape(re.sub(r"\\[\\n]", lambda m: _ROLE_PLAIN[m[0]], role))


def render(role: str, text: str) -> str:
    return f"{START}{role}\n{text}{END}\n"


def parse(rendered: str) -> list[tuple[str, str]] | None:
    """The (role, text) turns of a rendered string, None where it isn't of the grammar."""
    turns, at = [], 0
    while at < len(rendered):
        m = _TURN.match(rendered, at)
        if m is None or START in m[1] or END in m[1] or START in m[2] or rendered[m.end() : m.end() + 1] != "\n":
            return None
        turns.append((_unescape_role(m[1]), unescape(m[2])))
        at = m.end() + 1
    return turns


def format_turn(role: str, text: str) -> str:
    """The turn, escaped only if its plain rendering doesn't parse back into itself."""
    source = [(role, text)]
    for r, t in ((role, text), (role, escape(text)), (_escape_role(role), text), (_escape_role(role), escape(text))):
        rendered = render(r, t)
        if parse(rendered) == source:
            return rendered
    raise AssertionError("an escaped turn parses back into itself")


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, rendered) of every row; role and text without nulls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rendered = [format_turn(r, t) for r, t in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rendered, pa.string())], [*batch.schema.names, "rendered"])

    picked = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return picked.mapInArrow(run, "conv_id long, turn long, role string, text string, rendered string")


class _Digest:
    def __init__(self, conv_id: int | None):
        self.conv_id, self.n_turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, rendered: str) -> None:
        for role, text in parse(rendered):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
            if role == LOSS_ROLE:
                self.loss_chars += len(text)
                self.loss.update(text.encode())
        self.chars += len(rendered)

    def row(self) -> tuple:
        return self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from the rendered turns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Digest | None = None
        for batch in batches:
            done = []
            for conv_id, rendered in zip(batch.column("conv_id").to_pylist(), batch.column("rendered").to_pylist()):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now.row())
                    now = _Digest(conv_id)
                now.add(rendered)
            yield _rows(done)
        if now is not None:
            yield _rows([now.row()])

    ordered = formatted.repartition("conv_id").sortWithinPartitions(F.col("conv_id"), F.col("turn").asc_nulls_first(), "role", "text")
    return ordered.select("conv_id", "rendered").mapInArrow(run, DIGESTS)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)
