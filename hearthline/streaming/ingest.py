"""Streaming bronze: message files as they arrive, good rows and dead letters per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hearthline.operators.records import explode_elements, parse_records
from hearthline.plans.bronze import write_bronze
from hearthline.sources.json_files import line_position


# Where the split of a line starts; lines are numbered when their micro-batch is written.
BLOCK = "_block_start"


def message_stream(
    spark: SparkSession, path: str, ingested_at: str, max_files: int | None = None, layout: str = "array"
) -> DataFrame:
    """Parsed messages with `_raw_error` from files arriving in a folder, in `array` or `lines` layout."""
    if layout not in ("array", "lines"):
        raise ValueError(f"unknown layout {layout!r}")
    reader = spark.readStream.option("wholetext", layout == "array")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    columns = ["value", F.lit(ingested_at).alias("_ingested_at"), F.col("_metadata.file_path").alias("_source_file")]
    if layout == "lines":
        lines = reader.text(path).select(*columns, F.col("_metadata.file_block_start").alias(BLOCK))
        return parse_records(lines.where(F.col("value").rlike(r"\S")))
    return parse_records(explode_elements(reader.text(path).select(*columns)))


def stream_to_bronze(messages: DataFrame, output: str, checkpoint: str, first_batch: int) -> StreamingQuery:
    """Write what has arrived, then stop.

    Micro-batches are numbered from `first_batch` on, which has to lie beyond the numbers that daily loads of
    the same table use. A batch replaces an earlier attempt at it, so a restart after a failure neither loses
    nor repeats rows.
    """

    def write(rows: DataFrame, number: int) -> None:
        if BLOCK in rows.columns:
            rows = rows.withColumn("_pos", line_position(F.col("_source_file"), F.col(BLOCK)))
        write_bronze(rows, output, first_batch + number)

    return (
        messages.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
