"""Streaming silver: validation and exact deduplication, by a watermark or against the stored keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hearthline.functions.timestamps import as_event_time
from hearthline.operators.dedup import exact_dedup
from hearthline.operators.validate import rejected_events, valid_events, with_rejection_reason
from hearthline.plans.incremental import load_silver
from hearthline.plans.silver import SilverOptions
from hearthline.schemas import BRONZE, IDENTITY, SILVER, SILVER_DEAD_LETTER
from hearthline.sources.tables import BATCH, read_if_there, read_table, write_batch


def silver_stream(bronze: DataFrame, processed_at: str, delay: str = "1 day", lenient: bool = True) -> DataFrame:
    """Valid events of a stream, one per identity key.

    Keys are remembered for `delay` behind the latest event time. An event older than that may be
    dropped as late, as with any watermark, and rejected rows don't appear; `stream_to_silver` keeps both.
    Near duplicates depend on arrival order across
    the whole table and are left to the batch layer.
    """
    valid = valid_events(with_rejection_reason(bronze, lenient))
    return (
        valid.withColumn("_event_time", as_event_time(F.col("TimestampUTC")).cast("timestamp"))
        .withWatermark("_event_time", delay)
        .dropDuplicatesWithinWatermark(IDENTITY)
        .drop("_event_time")
        .withColumn("_silver_processed_at", F.lit(processed_at))
    )


def stream_to_silver(
    bronze: DataFrame, output: str, checkpoint: str, processed_at: str, first_batch: int, lenient: bool = True
) -> StreamingQuery:
    """Write what has arrived as batches of silver and of its dead letters, then stop; nothing is lost.

    An event counts as new if no earlier batch of the table holds its identity key, those of other loads
    included, however late it arrives, and rejected rows become dead letters. Near duplicates are left to
    `stream_loads`. A batch that is written again
    compares itself with the batches before it only, and so comes out the same.
    """

    def write(rows: DataFrame, number: int) -> None:
        batch = first_batch + number
        judged = with_rejection_reason(rows, lenient)
        stamp = F.lit(processed_at).alias("_silver_processed_at")
        columns = [f.name for f in SILVER.fields if f.name in rows.columns]
        write_batch(rejected_events(judged).select(*columns, stamp, "_rejection_reason"), f"{output}/silver_dead_letter", batch)
        fresh = exact_dedup(valid_events(judged)).select(*columns, stamp)
        before = read_if_there(rows.sparkSession, f"{output}/silver", STREAM_SILVER).where(F.col(BATCH) < batch)
        fresh = fresh.join(before.select(*IDENTITY), IDENTITY, "left_anti").select(*fresh.columns)
        write_batch(fresh, f"{output}/silver", batch)

    return (
        bronze.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_loads(
    bronze: DataFrame, output: str, checkpoint: str, processed_at: str, first_batch: int, options: SilverOptions = SilverOptions()
) -> StreamingQuery:
    """Take in what has arrived as loads of `plans.incremental`, then stop; near duplicates are dropped as well.

    What a stream has to remember are the accepted events, a table by load and day: a micro-batch reads and
    rewrites the days that it touches. So nothing expires, late rows find their duplicates, and the result is
    that of one run over everything. A micro-batch that is written again replaces itself.
    """

    def write(rows: DataFrame, number: int) -> None:
        load_silver(rows.sparkSession, rows.select(*BRONZE.names), output, first_batch + number, processed_at, options)

    return bronze.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


STREAM_SILVER = T.StructType([*SILVER.fields, T.StructField(BATCH, T.LongType())])


def read_stream_silver(spark: SparkSession, output: str) -> DataFrame:
    return read_table(spark, f"{output}/silver", STREAM_SILVER)


def read_stream_dead_letters(spark: SparkSession, output: str) -> DataFrame:
    return read_table(spark, f"{output}/silver_dead_letter", SILVER_DEAD_LETTER)
