"""End to end: message files to bronze, silver and gold tables."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.operators.devices import FAMILIES, unknown_type_counts, with_families
from hearthline.operators.ordering import clustered
from hearthline.operators.quality import enforce, quality_alerts, quality_metrics
from hearthline.operators.records import NOT_AN_ARRAY, NOT_JSON_FILE
from hearthline.operators.summary import ordered_summary
from hearthline.plans.bronze import read_bronze, read_bronze_dead_letters, write_bronze
from hearthline.plans.gold import DEVICE_TABLES, build_gold
from hearthline.plans.silver import SilverOptions, build_silver
from hearthline.schemas import SILVER, SILVER_DEAD_LETTER
from hearthline.sources.csv_files import read_csv, write_csv
from hearthline.sources.json_files import read_messages
from hearthline.sources.tables import append_rows, overwrite_table, read_table

ROUTED_SILVER = T.StructType([*SILVER.fields, T.StructField(FAMILIES, T.StringType())])

# The field names of the results are the interface that callers know.

@dataclass(frozen=True)
class BronzeResult:
    rows_written: int
    dead_letter_count: int


@dataclass(frozen=True)
class SilverResult:
    rows_in: int
    rows_out: int
    dropped_invalid: int
    dropped_duplicate: int
    dropped_fuzzy: int
    invalid_pct: float
    post_dedup_pct: float


@dataclass(frozen=True)
class GoldResult:
    rows_by_table: dict[str, int]
    unknown_types: int
    unknown_types_path: str


@dataclass(frozen=True)
class RunResult:
    bronze: BronzeResult
    silver: SilverResult
    gold: GoldResult
    alerts: list[str] = field(default_factory=list)


def utc_now() -> str:
    return datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def run_bronze(
    spark: SparkSession,
    input_path: str | list[str],
    output: str,
    batch_id: int,
    ingested_at: str | None = None,
    layout: str = "array",
    on_bad_file: str = "fail",
) -> BronzeResult:
    """Ingest message files as one batch; running a batch again replaces it.

    With `on_bad_file='fail'` a file that is no JSON array raises ValueError and nothing is written.
    """
    parsed = read_messages(spark, input_path, ingested_at or utc_now(), layout, on_bad_file)
    path = f"{output}/bronze"
    try:
        write_bronze(parsed, path, batch_id)
    except (PySparkException, Py4JJavaError) as error:
        for reason in (NOT_AN_ARRAY, NOT_JSON_FILE):
            if f"{reason}: " in str(error):
                raise ValueError(reason) from error
        raise
    return BronzeResult(
        read_bronze(spark, path, batch_id).count(),
        read_bronze_dead_letters(spark, path, batch_id).count(),
    )


def run_silver(
    spark: SparkSession,
    output: str,
    options: SilverOptions = SilverOptions(),
    processed_at: str | None = None,
) -> tuple[SilverResult, DataFrame]:
    """Rebuild silver from all bronze batches; returns the counters and the quality checks.

    The counters read the silver table back, so deduplication runs once.
    """
    bronze = read_bronze(spark, f"{output}/bronze").drop("_batch_id")
    silver = build_silver(bronze, processed_at or utc_now(), options)
    routed = clustered(with_families(silver.events), by=[FAMILIES, "DeviceId", "TimestampUTC"])
    overwrite_table(routed, f"{output}/silver", partition_by=[FAMILIES])
    overwrite_table(silver.dead_letters, f"{output}/silver_dead_letter")
    counters = quality_metrics(silver.stages_for(read_silver(spark, output))).first()
    checks = quality_alerts(spark.createDataFrame([counters]))
    return SilverResult(**counters.asDict()), checks


def read_silver(spark: SparkSession, output: str) -> DataFrame:
    return read_routed_silver(spark, output).drop(FAMILIES)


def read_routed_silver(spark: SparkSession, output: str) -> DataFrame:
    """Silver with the column that it is partitioned by: what filters on a family reads its partitions only."""
    return read_table(spark, f"{output}/silver", ROUTED_SILVER)


def read_silver_dead_letters(spark: SparkSession, output: str) -> DataFrame:
    return read_table(spark, f"{output}/silver_dead_letter", SILVER_DEAD_LETTER)


def run_gold(spark: SparkSession, output: str, fmt: str = "parquet", skip_empty: bool = False) -> GoldResult:
    """Rebuild all gold tables from silver, as Parquet (or another table format) or CSV.

    With `skip_empty` a device table without rows is not listed; it is written all the same, so that no
    rows of an earlier run stay. The unknown device types become a table with their numbers of events.
    """
    silver = read_routed_silver(spark, output)
    tables = build_gold(silver)
    tables["gold_summary"] = ordered_summary(tables["gold_summary"])
    rows: dict[str, int] = {}
    for name, table in tables.items():
        path = f"{output}/gold/{name}"
        if fmt == "csv":
            write_csv(table, path)
            rows[name] = read_csv(spark, path, table.schema).count()
        else:
            overwrite_table(table, path, fmt)
            rows[name] = read_table(spark, path, table.schema, fmt).count()
        if skip_empty and name in DEVICE_TABLES and not rows[name]:
            del rows[name]
    path = f"{output}/gold/gold_unknown_types"
    types = unknown_type_counts(silver)
    overwrite_table(types, path)
    return GoldResult(rows, read_table(spark, path, types.schema).count(), path)


def run_layers(
    spark: SparkSession,
    input_path: str | list[str],
    output: str,
    batch_id: int,
    ingested_at: str | None = None,
    processed_at: str | None = None,
    layout: str = "array",
    on_bad_file: str = "fail",
    options: SilverOptions = SilverOptions(),
    on_breach: str = "warn",
    gold_format: str = "parquet",
) -> RunResult:
    """Bronze, silver and gold in turn, with a log of the quality checks.

    With `on_breach='fail'` an exceeded threshold stops the run before gold is rebuilt.
    """
    bronze = run_bronze(spark, input_path, output, batch_id, ingested_at, layout, on_bad_file)
    run_at = processed_at or utc_now()
    silver, checks = run_silver(spark, output, options, run_at)
    append_rows(checks.withColumn("_run_at", F.lit(run_at)), f"{output}/quality_log")
    alerts = enforce(checks, on_breach)
    return RunResult(bronze, silver, run_gold(spark, output, gold_format), alerts)
