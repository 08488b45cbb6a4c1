"""Tables on shared storage, written as whole tables or as numbered batches.

A batch is the folder `_batch_id=<n>`. Writing a batch again replaces it, so a repeated attempt never
duplicates rows. The file format is a parameter; Parquet needs nothing beyond Spark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BATCH = "_batch_id"
DEFAULT_FORMAT = "parquet"


def create_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = DEFAULT_FORMAT) -> None:
    """An empty table with a schema, replacing what was there."""
    overwrite_table(spark.createDataFrame([], schema), path, fmt)


def overwrite_table(rows: DataFrame, path: str, fmt: str = DEFAULT_FORMAT, partition_by: Sequence[str] = ()) -> None:
    """Full refresh, partitions that no longer occur included."""
    writer = rows.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def replace_partitions(rows: DataFrame, path: str, partition_by: Sequence[str], stale: Sequence[Sequence[str]] = (), fmt: str = DEFAULT_FORMAT) -> None:
    """Write the partitions that the rows fall into, leaving the files of all others alone.

    `stale` lists values of `partition_by` of which no row is left: these partitions become empty.
    """
    rows.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).save(path)
    for values in stale:
        folder = "/".join(f"{c}={v}" for c, v in zip(partition_by, values))
        overwrite_table(rows.drop(*partition_by).limit(0), f"{path.rstrip('/')}/{folder}", fmt)


def append_rows(rows: DataFrame, path: str, fmt: str = DEFAULT_FORMAT) -> None:
    rows.write.format(fmt).mode("append").save(path)


def write_if_any(rows: DataFrame, path: str, fmt: str = DEFAULT_FORMAT) -> bool:
    """Full refresh; tells whether there were rows. Without any, an empty table replaces the one of before."""
    overwrite_table(rows, path, fmt)
    return not read_table(rows.sparkSession, path, rows.schema, fmt).isEmpty()


def write_batch(
    rows: DataFrame, path: str, batch_id: int, fmt: str = DEFAULT_FORMAT, partition_by: Sequence[str] = ()
) -> None:
    """Write one batch, replacing an earlier attempt at it."""
    writer = rows.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(f"{path.rstrip('/')}/{BATCH}={int(batch_id)}")


def write_batches(rows: DataFrame, path: str, fmt: str = DEFAULT_FORMAT) -> None:
    """Write every batch named by the column `_batch_id`, replacing those batches only."""
    (
        rows.write.format(fmt)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(BATCH)
        .save(path)
    )


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_if_there(spark: SparkSession, path: str, schema: T.StructType, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """The table, or no rows where nothing was written yet."""
    try:
        return read_table(spark, path, schema, fmt)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def as_of_batch(table: DataFrame, batch_id: int) -> DataFrame:
    """The table as it was after a batch; on a batch-partitioned table later folders are not read."""
    return table.where(F.col(BATCH) <= F.lit(batch_id))


def list_batches(table: DataFrame) -> DataFrame:
    """Batch numbers in order."""
    return table.select(BATCH).distinct().orderBy(BATCH)


def replay_counts(table: DataFrame) -> DataFrame:
    """Rows of each batch and of the table after it.

    The running sum sees one row per batch: batches are counted first.
    """
    counts = table.groupBy(BATCH).agg(F.count("*").alias("batch_rows"))
    upto = Window.orderBy(BATCH).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumn("cumulative_rows", F.sum("batch_rows").over(upto))


def replay_samples(
    table: DataFrame, batch_id: int | DataFrame, prefix: str = "syn_", n: int = 2
) -> tuple[DataFrame, DataFrame]:
    """Previews of a batch state: up to `n` events without and with the device-id prefix.

    With a table of batch numbers, the previews of all these states, which `_state` tells apart: the table is
    read once per kind. Its first `n` events of a kind by batch hold a preview of every state, namely those
    among them that the state has, as a state with fewer than `n` has all of its events among them.
    """
    prefixed = F.coalesce(F.col("DeviceId").startswith(prefix), F.lit(False))
    if isinstance(batch_id, int):
        state = as_of_batch(table, batch_id)
        return state.where(~prefixed).limit(n), state.where(prefixed).limit(n)
    states = batch_id.select(F.col(BATCH).alias("_state")).distinct()

    def previews(rows: DataFrame) -> DataFrame:
        first = rows.where(F.col(BATCH).isNotNull()).orderBy(BATCH).limit(n)
        return states.join(F.broadcast(first), F.col(BATCH) <= F.col("_state"))

    return previews(table.where(~prefixed)), previews(table.where(prefixed))
