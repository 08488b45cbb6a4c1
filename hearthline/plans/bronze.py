"""Bronze layer: parsed messages and dead letters, written in one pass per batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.operators.records import dead_records, good_records
from hearthline.schemas import BRONZE
from hearthline.sources.tables import BATCH, write_batch

ROUTE = "_route"
_STORED = T.StructType(
    [
        *BRONZE.fields,
        T.StructField("_raw_error", T.StringType()),
        T.StructField(BATCH, T.LongType()),
        T.StructField(ROUTE, T.StringType()),
    ]
)


def write_bronze(parsed: DataFrame, path: str, batch_id: int) -> None:
    """Write a batch of parsed messages; good rows and dead letters go to separate folders of it."""
    route = F.when(F.col("_raw_error").isNull(), F.lit("good")).otherwise(F.lit("dead"))
    columns = [f.name for f in BRONZE.fields]
    write_batch(
        parsed.select(*columns, "_raw_error", route.alias(ROUTE)), path, batch_id, partition_by=[ROUTE]
    )


def _stored(spark: SparkSession, path: str, route: str, batch_id: int | None) -> DataFrame:
    rows = spark.read.schema(_STORED).parquet(path).where(F.col(ROUTE) == route).drop(ROUTE)
    return rows if batch_id is None else rows.where(F.col(BATCH) == batch_id)


def read_bronze(spark: SparkSession, path: str, batch_id: int | None = None) -> DataFrame:
    """Good rows of one batch or of all, with `_batch_id`."""
    return good_records(_stored(spark, path, "good", batch_id))


def read_bronze_dead_letters(spark: SparkSession, path: str, batch_id: int | None = None) -> DataFrame:
    return dead_records(_stored(spark, path, "dead", batch_id))
