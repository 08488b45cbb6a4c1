"""CSV files read in byte ranges, line breaks inside quotes included.

A line break ends a record if an even number of quotes lies before it, as a quote inside a field is doubled.
So a first pass counts the quotes of every range, running sums per file tell which ranges begin inside a
field, and a second pass cuts the records: a range owns those that begin in it and reads on behind its end
until the last of them is complete. Ranges and their parities are rows; the driver sees the number of bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.sources.byte_ranges import RANGE_BYTES, RANGES, STEP, byte_ranges, files_of, open_file, steps, steps_from, tasks_for

_QUOTE, _BREAK = ord('"'), ord("\n")


def _records(file: pa.NativeFile, size: int, start: int, end: int, inside: bool) -> Iterator[tuple[int, bytes]]:
    """(offset, text) of the records that begin in [start, end): at 0, or behind a line break that ends one."""
    opened, parts = (0, []) if start == 0 else (0, None)
    # A record that begins with the range is announced by the break before it.
    begin = max(0, start - 1)
    quotes = int(inside)
    for offset, raw in steps_from(file, begin, end, size):
        signs = np.flatnonzero((raw == _QUOTE) | (raw == _BREAK))
        is_quote = raw[signs] == _QUOTE
        open_quotes = (np.cumsum(is_quote) + quotes) % 2
        whole, at = raw.tobytes(), 0
        for cut in signs[~is_quote & (open_quotes == 0)].tolist():
            if parts is not None:
                parts.append(whole[at:cut])
                yield opened, b"".join(parts)
            at, opened, parts = cut + 1, offset + cut + 1, []
            if opened >= end:
                return
        quotes = int(open_quotes[-1]) if len(signs) else quotes
        if parts is not None:
            parts.append(whole[at:])
        elif offset + len(raw) >= end:
            return
    if parts is not None and opened < end:
        yield opened, b"".join(parts)


def csv_records(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(file, pos, record): the text of every record that isn't blank, with the byte where it begins."""
    files = files_of(spark, path)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            quotes = []
            for uri, size, start in zip(*(batch.column(c).to_pylist() for c in ("file", "size", "start"))):
                with open_file(uri) as file:
                    # As far as the byte before the next range, where that one begins to read.
                    before, end = max(0, start - 1), min(size, start + range_bytes)
                    end = end if end == size else end - 1
                    quotes.append(sum(int((raw == _QUOTE).sum()) for _, raw in steps(file, before, end)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(quotes, pa.int64())], [*batch.schema.names, "quotes"])

    tasks = tasks_for(files, range_bytes)
    counted = byte_ranges(files, range_bytes, tasks).mapInArrow(count, RANGES + ", quotes long")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    inside = (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside")
    starts = counted.select("file", "size", "start", inside).repartition(tasks)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for r in batch.to_pylist():
                with open_file(r["file"]) as file:
                    for pos, text in _records(file, r["size"], r["start"], min(r["size"], r["start"] + range_bytes), r["inside"]):
                        text = text.removesuffix(b"\r")
                        if text.strip():
                            rows.append((r["file"], pos, text.decode("utf-8", "replace")))
                            held += len(text)
                        if held > 4 * STEP:
                            yield pack(rows)
                            rows, held = [], 0
        yield pack(rows)

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        kinds = pa.string(), pa.int64(), pa.string()
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["file", "pos", "record"])

    return starts.mapInArrow(cut, "file string, pos long, record string")


def read_csv_ranges(spark: SparkSession, path: str, schema: T.StructType, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Like `read_csv`, every column as text, by as many tasks as there are ranges.

    A file whose header doesn't name the columns of `schema` in their order fails the job.
    """
    texts = ", ".join(f"`{name}` string" for name in schema.names)
    header = F.when(F.col("pos") == 0, F.col("record"))
    options = {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
    names = F.from_csv(F.regexp_replace(header, "^\ufeff", ""), texts, options)
    right = [names[name] == F.lit(name) for name in schema.names]
    message = F.concat(F.lit("the header doesn't name the columns wanted: "), F.col("file"))
    checked = F.when(F.col("pos") != 0, F.lit(True)).when(F.forall(F.array(*right), lambda r: F.coalesce(r, F.lit(False))), F.lit(False))
    records = csv_records(spark, path, range_bytes)
    rows = records.withColumn("is_row", F.coalesce(checked, F.raise_error(message).cast("boolean"))).where("is_row")
    return rows.select(F.from_csv("record", texts, options).alias("r")).select("r.*")
