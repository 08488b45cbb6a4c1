"""JSON-array files read in byte ranges, so that one large file is work for many tasks.

Whether a comma separates elements depends on everything before it: on being inside a string, behind a
backslash, and on the depth of brackets. So a first pass reads every range once and follows it from each of
the three possible states of its first byte; the outcomes of a file's ranges are composed in order, which
gives every range its true start. A second pass cuts the elements: a range owns those whose opening comma (or
root bracket) it holds, and reads on behind its end until the last of them closes. Ranges and their states
are rows; the driver sees the number of bytes only.

The position of an element is the byte offset of its text in the file: unique, in file order, and the same
for any size of ranges.

A file whose root isn't an array, that doesn't end with the root's closing bracket, or that goes on behind it,
becomes a single record with `_file_error`; its text is not copied. An element that is no JSON by itself is
left to the record parser, and becomes a dead letter on its own. Spark leaves out files of no bytes at all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.operators.records import NOT_AN_ARRAY, NOT_JSON_FILE
from hearthline.sources.byte_ranges import RANGE_BYTES, RANGES, STEP, byte_ranges, files_of, open_file, steps, steps_from, tasks_for

OUTSIDE, INSIDE, ESCAPED = 0, 1, 2
_QUOTE, _BACKSLASH, _COMMA = ord('"'), ord("\\"), ord(",")
_DEPTH = np.zeros(256, np.int8)
_DEPTH[[ord("["), ord("{")]] = 1
_DEPTH[[ord("]"), ord("}")]] = -1
_BLANK = np.isin(np.arange(256), [0x20, 0x09, 0x0A, 0x0D])
_NONE = np.iinfo(np.int64).max

STATES = RANGES + ", state int, depth long, error string"


def _outside(raw: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """Positions of the structural bytes outside strings, and the state behind the last byte."""
    signs = np.flatnonzero((raw == _QUOTE) | (raw == _COMMA) | (_DEPTH[raw] != 0) | (raw == _BACKSLASH))
    kind = raw[signs]
    back = signs[kind == _BACKSLASH]
    escaped_end = state == ESCAPED and not len(raw)
    if len(back) or state == ESCAPED:
        # Backslashes in a row pair up; the byte behind an odd row is taken literally.
        rows = np.concatenate([[-1], back]) if state == ESCAPED else back
        first = np.concatenate([[True], np.diff(rows) > 1])
        begin = rows[first]
        length = np.diff(np.append(np.flatnonzero(first), len(rows)))
        literal = (begin + length)[length % 2 == 1]
        escaped_end = bool(len(literal)) and literal[-1] == len(raw)
        keep = (kind != _BACKSLASH) & ~np.isin(signs, literal)
        signs, kind = signs[keep], kind[keep]
    quotes = kind == _QUOTE
    inside = (np.cumsum(quotes) + (state != OUTSIDE)) % 2
    last = inside[-1] if len(inside) else int(state != OUTSIDE)
    return signs[~quotes & (inside == 0)], ESCAPED if escaped_end and last else int(last)


@dataclass
class Outcome:
    """What a run of bytes does from one start state; depths count from its start.

    `low` is the least depth behind any bracket but the last, `delta` the depth behind the last one.
    """

    state: int
    delta: int = 0
    low: int = _NONE
    brackets: bool = False

    def read(self, raw: np.ndarray) -> None:
        at, self.state = _outside(raw, self.state)
        change = _DEPTH[raw[at]]
        depth = np.cumsum(change[change != 0], dtype=np.int64)
        if len(depth):
            self.append(int(depth[-1]), int(depth[:-1].min()) if len(depth) > 1 else _NONE)

    def append(self, delta: int, low: int) -> None:
        """Put a later run with brackets behind this one."""
        before = min(self.low, self.delta) if self.brackets else _NONE
        self.low = min(before, self.delta + low if low < _NONE else _NONE)
        self.delta, self.brackets = self.delta + delta, True


SUMMARY = RANGES + ", first int, last int, states array<int>, deltas array<long>, lows array<long>, brackets array<boolean>"


def _summaries(ranges: DataFrame, range_bytes: int) -> DataFrame:
    """Of every range the outcome from each start state, and its first and last byte that isn't blank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for uri, size, start in zip(*(batch.column(c).to_pylist() for c in ("file", "size", "start"))):
                outcomes = [Outcome(s) for s in (OUTSIDE, INSIDE, ESCAPED)]
                first = last = -1
                with open_file(uri) as file:
                    for _, raw in steps(file, start, min(size, start + range_bytes)):
                        text = np.flatnonzero(~_BLANK[raw])
                        if len(text):
                            first, last = (int(raw[text[0]]) if first < 0 else first), int(raw[text[-1]])
                        for o in outcomes:
                            o.read(raw)
                rows.append((uri, size, start, first, last, *([getattr(o, f) for o in outcomes] for f in ("state", "delta", "low", "brackets"))))
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema)

    long = pa.list_(pa.int64())
    fields = [("file", pa.string()), ("size", pa.int64()), ("start", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("states", pa.list_(pa.int32())), ("deltas", long), ("lows", long), ("brackets", pa.list_(pa.bool_()))]
    names, schema = [n for n, _ in fields], pa.schema(fields)
    return ranges.mapInArrow(run, SUMMARY)


def _composed(table: pa.Table) -> pa.Table:
    """Start state and depth of every range of a file, and what is wrong with the file."""
    rows = sorted(table.to_pylist(), key=lambda r: r["start"])
    now, out = Outcome(OUTSIDE), []
    for r in rows:
        out.append({"file": r["file"], "size": r["size"], "start": r["start"], "state": now.state, "depth": now.delta})
        i = now.state
        if r["brackets"][i]:
            now.append(r["deltas"][i], r["lows"][i])
        now.state = r["states"][i]
    first = next((r["first"] for r in rows if r["first"] >= 0), -1)
    last = next((r["last"] for r in reversed(rows) if r["last"] >= 0), -1)
    error = None
    if now.state != OUTSIDE or now.delta != 0 or (first == ord("[") and (last != ord("]") or now.low < 1)):
        error = NOT_JSON_FILE
    elif first != ord("["):
        error = NOT_AN_ARRAY if first >= 0 else NOT_JSON_FILE
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
    names = ["file", "size", "start", "state", "depth", "error"]
    return pa.table({n: pa.array([error if n == "error" else r[n] for r in out], k) for n, k in zip(names, kinds)})


def _elements(file: pa.NativeFile, size: int, start: int, end: int, state: int, depth: int) -> Iterator[tuple[int, bytes]]:
    """(offset, text) of the elements whose opening comma or root bracket lies in [start, end)."""
    parts: list[bytes] | None = None
    opened, first_of_array = 0, False
    for offset, raw in steps_from(file, start, end, size):
        at, state = _outside(raw, state)
        change = _DEPTH[raw[at]].astype(np.int64)
        after = depth + np.cumsum(change)
        depth = int(after[-1]) if len(after) else depth
        # Commas at depth 1, the bracket that opens the root, and the one that closes it.
        cuts = at[((change == 0) & (after == 1)) | ((change > 0) & (after == 1)) | ((change < 0) & (after == 0))].tolist()
        whole = raw.tobytes()
        begin = 0
        for cut in cuts:
            if parts is not None:
                parts.append(whole[begin:cut])
                text = b"".join(parts)
                if text.strip() or not (first_of_array and whole[cut : cut + 1] == b"]"):
                    yield opened + len(text) - len(text.lstrip()), text.strip()
                parts = None
            if offset + cut >= end:
                return
            if whole[cut : cut + 1] != b"]":
                parts, opened, first_of_array = [], offset + cut + 1, whole[cut : cut + 1] == b"["
            begin = cut + 1
        if parts is None and offset + len(raw) >= end:
            return
        if parts is not None:
            parts.append(whole[begin:])


RECORDS = "value string, _source_file string, _pos long, _file_error string"


def array_range_records(spark: SparkSession, path: str | list[str], ingested_at: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Record text per element of JSON-array files, like `array_records`, but the files are read in ranges.

    Every byte is read twice, by Python workers; files are opened through the file systems that Arrow knows.
    Bytes that are no UTF-8 become U+FFFD.
    """
    files = files_of(spark, path)
    tasks = tasks_for(files, range_bytes)
    summaries = _summaries(byte_ranges(files, range_bytes, tasks), range_bytes)
    starts = summaries.groupBy("file").applyInArrow(_composed, STATES).repartition(tasks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for r in batch.to_pylist():
                if r["error"]:
                    if r["start"] == 0:
                        rows.append((None, r["file"], 0, r["error"]))
                    continue
                with open_file(r["file"]) as file:
                    for pos, text in _elements(file, r["size"], r["start"], min(r["size"], r["start"] + range_bytes), r["state"], r["depth"]):
                        rows.append((text.decode("utf-8", "replace"), r["file"], pos, None))
                        held += len(text)
                        if held > 4 * STEP:
                            yield pack(rows)
                            rows, held = [], 0
        yield pack(rows)

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        kinds = pa.string(), pa.string(), pa.int64(), pa.string()
        names = ["value", "_source_file", "_pos", "_file_error"]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    return starts.mapInArrow(run, RECORDS).withColumn("_ingested_at", F.lit(ingested_at))
