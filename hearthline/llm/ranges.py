"""Range-sorted tables whose tasks know what lies before them: running numbers without a single task."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: The column that holds the number of a row's range.
RANGE = "range_no"


def range_sorted(rows: DataFrame, *order: Column) -> DataFrame:
    """The rows in global order, checkpointed, with the number of their range: range i comes before range i + 1.

    The checkpoint keeps ranges and the order in them, so several passes see them alike, and a lost executor
    costs nothing that was sorted. A later step that puts several ranges into one task doesn't mix them.
    """
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(rows.sparkSession.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="hearthline-"))
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(RANGE, F.spark_partition_id()).checkpoint()


def numbered(ordered: DataFrame, name: str) -> DataFrame:
    """A `range_sorted` table with the number of each row, from 1, in the column `name`.

    Only one count per range comes to the driver.
    """
    before, total = {}, 0
    for part, count in sorted(ordered.groupBy(RANGE).count().collect()):
        before[part] = total
        total += count

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = None, 0
        for batch in batches:
            parts = batch.column(RANGE).to_numpy()
            starts = [0, *(np.flatnonzero(parts[1:] != parts[:-1]) + 1).tolist(), len(parts)]
            numbers = np.empty(len(parts), np.int64)
            for a, b in zip(starts, starts[1:]):
                if a < b and parts[a] != part:
                    part, at = int(parts[a]), before[int(parts[a])]
                numbers[a:b] = np.arange(at + 1, at + 1 + b - a)
                at += b - a
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers)], [*batch.schema.names, name])

    schema = ordered.schema
    return ordered.mapInArrow(run, type(schema)(list(schema.fields)).add(name, "long")).drop(RANGE)
