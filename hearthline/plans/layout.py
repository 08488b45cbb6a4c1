"""Table layout and catalog: compaction, clustering on several columns, registration and the failure view."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.operators.ordering import clustered
from hearthline.operators.summary import devices_with_failures
from hearthline.sources.tables import DEFAULT_FORMAT


def compact(
    table: DataFrame,
    path: str,
    files: int | None = None,
    by: Sequence[str] = ("DeviceId", "TimestampUTC"),
    fmt: str = DEFAULT_FORMAT,
) -> None:
    """Rewrite a table to another path in few files, clustered for filters on the leading column."""
    clustered(table, files, by).write.format(fmt).mode("overwrite").save(path)


def cut_points(rows: DataFrame, column: str, cuts: int, sample: int = 20_000) -> list[str]:
    """At most `cuts` values that part the column into ranges of similar size.

    They come from at most `sample` rows, picked by a hash of the value; they only decide where rows are
    stored, and any values would do.
    """
    picked = rows.select(F.col(column).alias("v")).where(F.col("v").isNotNull())
    values = [r.v for r in picked.orderBy(F.xxhash64("v", F.rand(7)), "v").limit(sample).collect()]
    values.sort()
    return sorted({values[len(values) * i // (cuts + 1)] for i in range(1, cuts + 1)}) if values else []


def _place(column: str, points: list[str]) -> Column:
    """How many cut points lie at or below the value: its range, by halving."""
    if not points:
        return F.lit(0)
    middle = len(points) // 2
    left, right = _place(column, points[:middle]), _place(column, points[middle + 1 :])
    return F.when(F.coalesce(F.col(column) >= F.lit(points[middle]), F.lit(False)), right + F.lit(middle + 1)).otherwise(left)


def z_key(places: Sequence[Column], bits: int) -> Column:
    """The places with their bits interleaved, the first column's bit ahead at each level."""
    z = F.lit(0).cast("long")
    for bit in range(bits - 1, -1, -1):
        for place in places:
            z = F.shiftleft(z, 1).bitwiseOR(F.shiftright(place.cast("long"), bit).bitwiseAND(F.lit(1).cast("long")))
    return z


def compact_z(
    table: DataFrame,
    path: str,
    files: int,
    by: Sequence[str] = ("DeviceId", "TimestampUTC"),
    bits: int = 6,
    fmt: str = DEFAULT_FORMAT,
) -> None:
    """Rewrite a table to another path so that filters on any of the columns `by` can skip files.

    Rows lie along a Z curve over ranges of the columns. The least and greatest value of every file go to a
    small table beside it, from which `read_skipping` picks files.
    """
    places = [_place(c, cut_points(table, c, (1 << bits) - 1)) for c in by]
    keyed = table.withColumn("_z", z_key(places, bits))
    keyed.repartitionByRange(files, "_z", *by).sortWithinPartitions("_z", *by).drop("_z").write.format(fmt).mode("overwrite").save(f"{path}/data")
    stored = table.sparkSession.read.format(fmt).schema(table.schema).load(f"{path}/data")
    edges = [f(c).alias(f"{n}_{c}") for c in by for n, f in (("min", F.min), ("max", F.max))]
    nulls = [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in by]
    stats = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"), *edges, *nulls)
    stats.coalesce(1).write.mode("overwrite").parquet(f"{path}/files")


def read_skipping(spark: SparkSession, path: str, schema: T.StructType, ranges: Mapping[str, tuple], fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """Rows whose columns lie in closed ranges (low, high; None is open), from the files that can hold any.

    The names of these files come to the driver, which would list them anyway.
    """
    files, rows = spark.read.parquet(f"{path}/files"), F.lit(True)
    for column, (low, high) in ranges.items():
        if low is not None:
            files, rows = files.where(F.col(f"max_{column}") >= F.lit(low)), rows & (F.col(column) >= F.lit(low))
        if high is not None:
            files, rows = files.where(F.col(f"min_{column}") <= F.lit(high)), rows & (F.col(column) <= F.lit(high))
    names = [r.file for r in files.select("file").collect()]
    if not names:
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).schema(schema).load(names).where(rows)


def register(spark: SparkSession, name: str, path: str, fmt: str = DEFAULT_FORMAT) -> None:
    """Make a stored table queryable by name."""
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{name}` USING {fmt} LOCATION '{location}'")


def register_failure_view(summary: DataFrame, name: str = "devices_with_failures") -> None:
    """Session view of the devices with at least one failure."""
    devices_with_failures(summary).createOrReplaceTempView(name)
