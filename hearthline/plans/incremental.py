"""Silver and gold load by load: only the days that a load touches are worked on again.

Accepted events are stored by load and event day. Duplicates agree on the event time, so a day's silver rows
depend on that day's accepted events alone: a load rewrites the silver partitions of the days it holds (or
held, if it replaces an earlier attempt) from the accepted events of these days, and no others. The result is
that of one run over all loads, whatever their order, late events and repeated loads included.

What a load touches is noted before anything is replaced, so a load that broke off is simply run again. Gold
tables are partitioned by day too, and follow for the same days. The summary folds partial counts per day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.operators.devices import FAMILIES, dishwasher_table, unknown_device_table, washing_machine_table, with_families
from hearthline.operators.coffee import attribute_rows
from hearthline.operators.summary import folded_summary, summary_partials
from hearthline.plans.silver import SilverOptions, build_silver, deduplicated
from hearthline.schemas import BRONZE, SILVER
from hearthline.sources.tables import BATCH, read_if_there, read_table, replace_partitions, write_batch

DAY = "_day"

_DAY_FIELD = T.StructField(DAY, T.StringType())
_ACCEPTED = T.StructType([*BRONZE.fields, T.StructField(BATCH, T.LongType()), _DAY_FIELD])
_TOUCHED = T.StructType([_DAY_FIELD, T.StructField(BATCH, T.LongType())])
STORED_SILVER = T.StructType([*SILVER.fields, _DAY_FIELD, T.StructField(FAMILIES, T.StringType())])


def event_day() -> Column:
    """Day of the canonical event time."""
    return F.substring("TimestampUTC", 1, 10)


def _days(table: DataFrame) -> set[str]:
    """Distinct days: of a partitioned table read from the folders' names."""
    return {r[0] for r in table.select(DAY).distinct().collect()}


def load_silver(
    spark: SparkSession, bronze: DataFrame, output: str, batch_id: int, processed_at: str, options: SilverOptions = SilverOptions()
) -> list[str]:
    """Take in one load of bronze rows and return the days whose silver partitions were rewritten.

    Running a load again replaces it. Only names of days reach the driver: as many as the load has partitions.
    """
    if options.near_duplicates and not options.match_timestamp:
        raise ValueError("without the time, duplicates span days: use run_silver")
    layer = build_silver(bronze, processed_at, options)
    accepted, touched = f"{output}/accepted", f"{output}/touched"
    write_batch(layer.dead_letters, f"{output}/silver_dead_letter", batch_id)
    fresh = layer.valid.select(*BRONZE.names).withColumn(DAY, event_day())
    before = read_if_there(spark, accepted, _ACCEPTED).where(F.col(BATCH) == batch_id)
    noted = read_if_there(spark, touched, _TOUCHED).where(F.col(BATCH) == batch_id)
    days = sorted(_days(fresh) | _days(before) | _days(noted))
    write_batch(spark.createDataFrame([(d,) for d in days], T.StructType([_DAY_FIELD])), touched, batch_id)
    write_batch(fresh, accepted, batch_id, partition_by=[DAY])
    rewrite_silver(spark, output, days, processed_at, options)
    return days


def rewrite_silver(spark: SparkSession, output: str, days: list[str], processed_at: str, options: SilverOptions = SilverOptions()) -> None:
    """Silver partitions of the days, from all accepted events of these days."""
    events = read_table(spark, f"{output}/accepted", _ACCEPTED).where(F.col(DAY).isin(days))
    kept = deduplicated(events.drop(BATCH), options).withColumn("_silver_processed_at", F.lit(processed_at))
    _replace_days(with_families(kept).select(*STORED_SILVER.names), f"{output}/silver", days, [DAY, FAMILIES])


def _replace_days(rows: DataFrame, path: str, days: list[str], partition_by: list[str]) -> None:
    """Replace all partitions of the days; those that get no row any more become empty."""
    spark, fields = rows.sparkSession, T.StructType([T.StructField(c, T.StringType()) for c in partition_by])

    def stored() -> set[tuple]:
        return {tuple(r) for r in read_if_there(spark, path, fields).where(F.col(DAY).isin(days)).distinct().collect()}

    before = stored()
    stale = sorted(before - {tuple(r) for r in rows.select(*partition_by).distinct().collect()}) if before else []
    replace_partitions(rows, path, partition_by, stale)


def read_days(spark: SparkSession, output: str, days: list[str] | None = None) -> DataFrame:
    """Stored silver with its partition columns; of some days or of all."""
    silver = read_table(spark, f"{output}/silver", STORED_SILVER)
    return silver if days is None else silver.where(F.col(DAY).isin(days))


def load_gold(spark: SparkSession, output: str, days: list[str]) -> None:
    """Gold partitions of the days. Coffee machines come as one row per attribute, whose columns never change."""
    silver = read_days(spark, output, days)
    tables = {
        "gold_washing_machine": washing_machine_table(silver),
        "gold_coffee_attributes": attribute_rows(silver),
        "gold_dishwasher": dishwasher_table(silver),
        "gold_unknown_devices": unknown_device_table(silver),
    }
    for name, table in tables.items():
        _replace_days(table.withColumn(DAY, event_day()), f"{output}/gold/{name}", days, [DAY])
    _replace_days(summary_partials(silver, [DAY]), f"{output}/gold/summary_partials", days, [DAY])


def read_summary(spark: SparkSession, output: str) -> DataFrame:
    """Device summary of everything loaded, from the partial counts."""
    return folded_summary(read_table(spark, f"{output}/gold/summary_partials"))
