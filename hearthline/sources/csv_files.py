"""CSV with a header and every column as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.sources.csv_ranges import read_csv_ranges


def write_csv(rows: DataFrame, path: str) -> None:
    """Header, UTF-8, quotes doubled inside quoted fields; timestamps as canonical UTC text."""
    texts = [
        F.date_format(f.name, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
        else F.col(f.name)
        for f in rows.schema.fields
    ]
    rows.select(*texts).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, range_bytes: int | None = None) -> DataFrame:
    """Rows of CSV files whose header names the columns of `schema`; every column is read as text.

    As fields may hold line breaks, a file is one task's work, unless `range_bytes` says into what ranges it is cut.
    """
    if range_bytes is not None:
        return read_csv_ranges(spark, path, schema, range_bytes)
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    return (
        spark.read.schema(texts)
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )
