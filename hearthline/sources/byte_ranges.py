"""Files as ranges of bytes that tasks open by themselves."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RANGE_BYTES = 32 << 20
#: Bytes looked at by one numpy step.
STEP = 1 << 20
#: The first step behind the end of a range; each further one is twice as long, as few records reach far.
FIRST_BEYOND = 1 << 12
#: A task is to read as much as this, unless there are too few of them: every core gets two, where there are ranges.
TASK_BYTES = 32 << 20
FEWEST_TASKS = 64
#: More tasks than this are not asked for; each then reads several ranges.
MOST_TASKS = 100_000

RANGES = "file string, size long, start long"


def files_of(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, size) of what Spark finds under the path; contents are not read."""
    found = spark.read.format("binaryFile").load(path)
    return found.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))


def byte_ranges(files: DataFrame, range_bytes: int, tasks: int) -> DataFrame:
    """(file, size, start) of every range, spread over the tasks."""
    last = F.greatest(F.col("size") - 1, F.lit(0).cast("long"))
    starts = files.select("file", "size", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(range_bytes).cast("long"))).alias("start"))
    return starts.repartition(tasks)


def tasks_for(files: DataFrame, range_bytes: int) -> int:
    """Tasks that read the ranges: enough for all cores, and beyond that by bytes, as every task costs a start."""
    if range_bytes < 1:
        raise ValueError(f"a range holds at least one byte, not {range_bytes}")
    size = F.greatest("size", F.lit(1))
    ranges, total = files.agg(F.sum(F.ceil(size / range_bytes)), F.sum(size)).first()
    cores = files.sparkSession.sparkContext.defaultParallelism
    wanted = max(FEWEST_TASKS, 2 * cores, -(-int(total or 0) // TASK_BYTES))
    return max(1, min(int(ranges or 0), wanted, MOST_TASKS))


def open_file(uri: str) -> pa.NativeFile:
    # Spark names local files with one slash, Arrow wants three.
    system, path = fs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", uri))
    return system.open_input_file(path)


def steps(file: pa.NativeFile, start: int, end: int) -> Iterator[tuple[int, np.ndarray]]:
    while start < end:
        raw = file.read_at(min(STEP, end - start), start)
        if not raw:
            return
        yield start, np.frombuffer(raw, np.uint8)
        start += len(raw)


def steps_from(file: pa.NativeFile, start: int, end: int, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Like `steps`, from `start` to the end of the file, with a cut at `end` and short steps behind it."""
    yield from steps(file, start, end)
    length = FIRST_BEYOND
    while end < size:
        yield from steps(file, end, min(size, end + length))
        end, length = end + length, min(2 * length, STEP)
