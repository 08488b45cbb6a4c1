"""Readers for device-message files.

A file holding one JSON array is one value for one task, which suits files of moderate size; with
`range_bytes` such files are cut into ranges (see `json_ranges`). JSON Lines files are always split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.operators.records import explode_elements, parse_records
from hearthline.sources.json_ranges import array_range_records


def _stamped(lines: DataFrame, ingested_at: str, source: Column) -> DataFrame:
    return lines.select("value", F.lit(ingested_at).alias("_ingested_at"), source.alias("_source_file"))


def array_records(spark: SparkSession, path: str | list[str], ingested_at: str) -> DataFrame:
    """Record text per element of JSON-array files: value, load time, file, position in the file."""
    files = spark.read.text(path, wholetext=True)
    return explode_elements(_stamped(files, ingested_at, F.col("_metadata.file_path")))


@F.pandas_udf(T.LongType())
def _row_of_block(blocks: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Number of each row among those of its block, from 0; a task reads one block after the other."""
    block, rows = None, 0
    for part in blocks:
        values = part.to_numpy()
        begins = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
        lengths = np.diff(np.append(begins, len(values)))
        first = np.zeros(len(begins), np.int64)
        if len(values) and values[0] == block:
            first[0] = rows
        out = np.arange(len(values)) - np.repeat(begins - first, lengths)
        if len(values):
            block, rows = values[-1], out[-1] + 1
        yield pd.Series(out)


#: The rows have to be numbered as they come from the file, before anything moves them.
_row_of_block = _row_of_block.asNondeterministic()


def block_number(file: Column, block_start: Column) -> Column:
    """Tells the blocks of a task apart."""
    return F.xxhash64(file, block_start)


def line_position(file: Column, block_start: Column) -> Column:
    """Number that is unique within a file and grows with the position of a line, at any setting of the reader.

    It is the byte where the line's block starts plus the number of the line in its block, of lines with text:
    these take two bytes or more, so a block has fewer of them than bytes. Only the number of the block goes
    to a Python worker; the text stays where it is.
    """
    return block_start + _row_of_block(block_number(file, block_start))


def line_records(spark: SparkSession, path: str | list[str], ingested_at: str) -> DataFrame:
    """Record text per non-blank line of JSON Lines files: value, load time, file, position."""
    file, start = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    lines = spark.read.text(path).select("value", file.alias("_source_file"), start.alias("_block"))
    return lines.where(F.col("value").rlike(r"\S")).select(
        "value",
        F.lit(ingested_at).alias("_ingested_at"),
        "_source_file",
        line_position(F.col("_source_file"), F.col("_block")).alias("_pos"),
    )


def refuse_bad_files(records: DataFrame) -> DataFrame:
    """The records, with an error raised by whichever task meets a file that is no JSON array."""
    message = F.concat(F.col("_file_error"), F.lit(": "), F.col("_source_file"))
    raised = F.when(F.col("_file_error").isNotNull(), F.raise_error(message).cast("string"))
    return records.withColumn("_file_error", raised)


def read_messages(
    spark: SparkSession,
    path: str | list[str],
    ingested_at: str,
    layout: str = "array",
    on_bad_file: str = "fail",
    range_bytes: int | None = None,
) -> DataFrame:
    """Parsed messages with `_raw_error`, from files in `array` or `lines` layout.

    With `range_bytes`, array files are read in ranges of that size by many tasks, and `_pos` is the byte
    where an element starts; without, a file is one task's work and `_pos` the number of the element.

    A file that is no JSON array fails the job that reads the messages, or becomes one dead letter with
    `on_bad_file='dead_letter'`.
    """
    if layout == "lines":
        return parse_records(line_records(spark, path, ingested_at))
    if layout != "array":
        raise ValueError(f"unknown layout {layout!r}")
    if on_bad_file not in ("fail", "dead_letter"):
        raise ValueError(f"unknown on_bad_file {on_bad_file!r}")
    if range_bytes is None:
        records = array_records(spark, path, ingested_at)
    else:
        records = array_range_records(spark, path, ingested_at, range_bytes)
    if on_bad_file == "fail":
        records = refuse_bad_files(records)
    return parse_records(records)
