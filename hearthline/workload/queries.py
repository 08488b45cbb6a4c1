"""Registered queries: every operator over the whole device-event set derived from the benchmark tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.functions.similarity import token_sort_ratio
from hearthline.functions.text import is_blank, is_failure
from hearthline.functions.timestamps import canonical_utc
from hearthline.operators import coffee, dedup, devices, drift, near_duplicates, ordering, quality, summary
from hearthline.operators.records import dead_records, explode_elements, good_records, parse_records
from hearthline.operators.validate import rejected_events, valid_events, with_rejection_reason
from hearthline.plans.bronze import read_bronze, read_bronze_dead_letters
from hearthline.plans.gold import DEVICE_TABLES, build_gold
from hearthline.plans.incremental import load_gold, load_silver, read_days, read_summary
from hearthline.plans.layers import ROUTED_SILVER, run_layers
from hearthline.plans.layout import compact, compact_z, read_skipping, register, register_failure_view
from hearthline.plans.silver import build_silver
from hearthline.schemas import BRONZE, IDENTITY, SILVER
from hearthline.session import shared_dir, staged
from hearthline.sources import tables
from hearthline.sources.csv_files import read_csv, write_csv
from hearthline.sources.json_files import read_messages
from hearthline.streaming.dedup import (
    read_stream_dead_letters,
    read_stream_silver,
    silver_stream,
    stream_loads,
    stream_to_silver,
)
from hearthline.streaming.ingest import message_stream, stream_to_bronze
from hearthline.workload.device_events import device_events, load, messages

Query = Callable[[SparkSession, str], DataFrame]

PROCESSED_AT = "2024-02-02T00:00:00Z"


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return device_events(spark, sf_dir).drop("_batch_id")


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_rejection_reason(_bronze(spark, sf_dir))


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_events(_judged(spark, sf_dir))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_silver(_bronze(spark, sf_dir), PROCESSED_AT).events


# --- bronze ---------------------------------------------------------------------------------------


def _leaf(path: str) -> Column:
    return F.get_json_object("Attributes", path)


def _attribute_leaves() -> list[Column]:
    """A few leaves instead of the JSON text, whose spacing is free."""
    return [
        _leaf("$.Temperature").alias("temperature"),
        _leaf("$.FailureIds[0]").alias("first_failure"),
        _leaf("$[0].Id").alias("first_id"),
        F.when(~F.ltrim("Attributes").startswith("{") & ~F.ltrim("Attributes").startswith("["), F.col("Attributes")).alias(
            "bare_value"
        ),
    ]


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = messages(spark, sf_dir)
    return parse_records(rows.select(F.col("record").alias("value"), "_ingested_at", "_source_file", "_pos"))


def bronze_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return good_records(_records(spark, sf_dir)).select(*IDENTITY, "_pos", "_ingested_at", *_attribute_leaves())


def bronze_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dead_records(_records(spark, sf_dir)).select(
        F.get_json_object("_raw_error", "$._error").alias("error"),
        F.get_json_object("_raw_error", "$._raw").alias("raw"),
        "_ingested_at",
    )


def _array_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON-array text per batch of a thousand events; every fifth batch is broken in some way."""
    arrays = (
        messages(spark, sf_dir)
        .groupBy("_batch_id")
        .agg(F.sort_array(F.collect_list(F.struct("_pos", "element"))).alias("_elements"))
    )
    joined = F.array_join("_elements.element", ", ")
    text = (
        F.when(F.col("_batch_id") % 10 == 4, F.concat(F.lit('{"events": ['), joined, F.lit("]}")))
        .when(F.col("_batch_id") % 10 == 9, F.concat(F.lit("["), joined, F.lit("] trailing")))
        .otherwise(F.concat(F.lit("["), joined, F.lit("]")))
    )
    return arrays.select(
        text.alias("value"),
        F.lit("2024-02-01T00:00:00Z").alias("_ingested_at"),
        F.concat(F.lit("batch-"), F.col("_batch_id").cast("string")).alias("_source_file"),
    )


def _array_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_records(explode_elements(_array_files(spark, sf_dir)))


def bronze_array_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return good_records(_array_messages(spark, sf_dir)).select(*IDENTITY, "_source_file", "_pos", *_attribute_leaves())


def bronze_array_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes of array elements, character by character."""
    return good_records(_array_messages(spark, sf_dir)).select("_source_file", "_pos", "Attributes")


def bronze_split_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same text from files that many tasks read in ranges; the byte positions put the elements in order."""
    path = shared_dir(spark, "arrays")
    files = _array_files(spark, sf_dir).select("value", F.col("_source_file").alias("file"))
    files.write.partitionBy("file").text(path)
    rows = good_records(read_messages(spark, path, PROCESSED_AT, on_bad_file="dead_letter", range_bytes=1 << 16))
    name = F.regexp_extract("_source_file", "file=([^/]+)/", 1)
    place = F.row_number().over(Window.partitionBy("_source_file").orderBy("_pos")) - 1
    return rows.select(name.alias("_source_file"), place.cast("long").alias("_pos"), "Attributes")


def bronze_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages stored as JSON Lines and read back: rows and distinct positions per device."""
    path = shared_dir(spark, "lines")
    messages(spark, sf_dir).select(F.col("message").alias("value")).write.text(path)
    rows = good_records(read_messages(spark, path, PROCESSED_AT, layout="lines"))
    return rows.groupBy("DeviceId").agg(
        F.count("*").alias("rows"), F.count_distinct("_source_file", "_pos").alias("positions")
    )


def bronze_bad_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dead_records(_array_messages(spark, sf_dir)).select(
        "_source_file", F.get_json_object("_raw_error", "$._error").alias("error")
    )


# --- silver ---------------------------------------------------------------------------------------


def validate_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir).select(*IDENTITY, "_pos", "_rejection_reason")


def dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_silver(_bronze(spark, sf_dir), PROCESSED_AT).dead_letters


def missing_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = with_rejection_reason(_bronze(spark, sf_dir).drop("Status"))
    return rejected_events(judged).select("DeviceId", "Status", "_pos", "_rejection_reason")


def normalize_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO forms cut from the event times: offsets, fractions, no seconds, no time, impossible dates."""
    day, hm = F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm")
    sec = F.date_format("ts", "HH:mm:ss")
    forms = [
        F.concat(day, F.lit("T"), sec),
        F.concat(day, F.lit("T"), sec, F.lit("Z")),
        F.concat(day, F.lit("T"), sec, F.lit("+02:00")),
        F.concat(day, F.lit("T"), sec, F.lit("-0530")),
        F.concat(day, F.lit("T"), sec, F.lit(".75Z")),
        F.concat(day, F.lit("T"), hm, F.lit("Z")),
        F.concat(day, F.lit(" "), sec),
        day,
        F.concat(F.lit("2024-02-30T"), sec),
        F.lit("2024"),
    ]
    form = F.get(F.array(*forms), (F.col("event_id") % len(forms)).cast("int"))
    events = load(spark, sf_dir, "events").select("event_id", form.alias("raw"))
    return events.select(
        "event_id",
        "raw",
        canonical_utc(F.col("raw")).alias("lenient"),
        canonical_utc(F.col("raw"), lenient=False).alias("strict"),
    )


def normalize_device_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_events(_judged(spark, sf_dir), "initcap").groupBy("DeviceType").agg(F.count("*").alias("rows"))


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_dedup(_valid(spark, sf_dir)).select(*IDENTITY, "Attributes", "_pos")


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.duplicate_keys(_valid(spark, sf_dir))


def restrict_to_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose identity occurs among the failures."""
    valid = _valid(spark, sf_dir)
    return dedup.restrict_to_keys(valid, valid.where(is_failure(F.col("Status")))).select(*IDENTITY, "_pos")


def part_name_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-sort similarity of every part name to the name with the next key, in both letter modes.

    The number of partitions is fixed: merged by their size, which is small, they would leave the comparisons
    to few tasks; and neither side is broadcast, as both grow.
    """
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = load(spark, sf_dir, "part").select("p_partkey", "p_name")
    following = part.select((F.col("p_partkey") - 1).alias("p_partkey"), F.upper("p_name").alias("next_name"))
    pairs = part.repartition(n, "p_partkey").join(following.repartition(n, "p_partkey").hint("merge"), "p_partkey")
    return pairs.select(
        "p_partkey",
        F.round(token_sort_ratio(F.col("p_name"), F.col("next_name")), 6).alias("score"),
        F.round(token_sort_ratio(F.col("p_name"), F.col("next_name"), False), 6).alias("raw_score"),
    )


def status_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Similarity of every event's status to each of the three program states."""
    statuses = _valid(spark, sf_dir).groupBy("Status").agg(F.count("*").alias("events"))
    return statuses.select(
        "Status",
        "events",
        *[
            F.round(token_sort_ratio(F.col("Status"), F.lit(label)), 6).alias(name)
            for name, label in [
                ("to_start", "Program Start"),
                ("to_end", "Program End"),
                ("to_failure", "Program Failure"),
            ]
        ],
    )


def candidate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = near_duplicates.candidate_pairs(_valid(spark, sf_dir))
    return pairs.withColumn("status_fuzzy", F.round("status_fuzzy", 6))


def candidate_pairs_per_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = near_duplicates.candidate_pairs(_valid(spark, sf_dir), match_timestamp=False)
    return pairs.withColumn("status_fuzzy", F.round("status_fuzzy", 6))


def fuzzy_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.drop_near_duplicates(_valid(spark, sf_dir)).select(*IDENTITY, "_pos")


def fuzzy_dedup_case_sensitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = near_duplicates.drop_near_duplicates(_valid(spark, sf_dir), case_insensitive=False)
    return kept.select(*IDENTITY, "_pos")


def fuzzy_dedup_no_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = near_duplicates.drop_near_duplicates(_valid(spark, sf_dir), match_timestamp=False)
    return kept.select(*IDENTITY, "_pos")


def silver_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir)


def silver_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.silver_order(_silver(spark, sf_dir)).select(*IDENTITY)


def silver_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The even batches as the table, updated with the odd batches and a repeat of every tenth batch."""
    rows = device_events(spark, sf_dir)
    table = valid_events(with_rejection_reason(rows.where(F.col("_batch_id") % 2 == 0)))
    updates = valid_events(
        with_rejection_reason(rows.where((F.col("_batch_id") % 2 == 1) | (F.col("_batch_id") % 10 == 0)))
    ).withColumn("_ingested_at", F.lit("2024-02-03T00:00:00Z"))
    return dedup.upsert(dedup.exact_dedup(table), updates).select(*IDENTITY, "_ingested_at", "_pos")


def _loads(spark: SparkSession, sf_dir: str, gold: bool = False) -> str:
    """Device events in three loads, none of them in the order of arrival, and the first load once more."""
    output, rows = shared_dir(spark, "loads"), device_events(spark, sf_dir)
    for load in (2, 0, 1, 2):
        days = load_silver(spark, rows.where(F.col("_batch_id") % 3 == load).drop("_batch_id"), output, load, PROCESSED_AT)
        if gold:
            load_gold(spark, output, days)
    return output


def incremental_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_days(spark, _loads(spark, sf_dir)).select(*SILVER.names)


def incremental_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_summary(spark, _loads(spark, sf_dir, gold=True))


def fuzzy_dedup_crowded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of very many keys: part names as statuses of three devices, in both letter modes."""
    kind = F.when((F.col("p_type") == "PROMO") & (F.col("p_size") % 2 == 0), F.lower("p_type")).otherwise(F.col("p_type"))
    rows = load(spark, sf_dir, "part").select(
        F.concat(F.lit("dev_"), F.col("p_partkey") % 3).alias("DeviceId"),
        F.lit("2024-01-01T00:00:00Z").alias("TimestampUTC"),
        F.lit("Part").alias("DeviceType"),
        F.concat_ws(" ", kind, "p_brand").alias("Status"),
        F.col("p_partkey").alias("_pos"),
    )
    parts = []
    for threshold in (60, 90, 97):
        for fold in (True, False):
            kept = near_duplicates.drop_near_duplicates(rows, threshold, fold, order=["_pos"])
            parts.append(kept.select(F.lit(threshold).alias("threshold"), F.lit(fold).alias("fold"), "DeviceId", "Status", "_pos"))
    return ordering.concatenated(parts)


# --- gold -----------------------------------------------------------------------------------------


def gold_washing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return devices.washing_machine_table(_silver(spark, sf_dir), with_temperature_unit=True)


def gold_dishwasher(spark: SparkSession, sf_dir: str) -> DataFrame:
    return devices.dishwasher_table(_silver(spark, sf_dir))


def gold_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return devices.unknown_device_table(_silver(spark, sf_dir))


def gold_coffee(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns are found in the data, as in production."""
    return coffee.coffee_machine_table(staged(_silver(spark, sf_dir), "silver"))


def gold_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Washing machines with Attributes that are cut off, of another shape, or of values that are no numbers."""
    text = F.get(
        F.array(
            F.expr("substr(Attributes, 1, length(Attributes) - 3)"),
            F.lit("[1, 2]"),
            F.lit("7"),
            F.lit(None).cast("string"),
            F.lit('{"Temperature": "warm", "SpinningSpeed": "900.0", "TwinDos": [5], "FailureIds": [1, "x", null]}'),
            F.col("Attributes"),
        ),
        (F.col("_pos") % 6).cast("int"),
    )
    rows = _valid(spark, sf_dir).withColumn("Attributes", text)
    table = devices.washing_machine_table(rows)
    return table.select(*IDENTITY, "Temperature_C", "SpinningSpeed", "TwinDos_Colour", "TwinDos_White", "FailureId")


def coffee_name_clashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that would take a reserved column, that share a column name, and one that is repeated in an event."""
    more = """concat(substr(Attributes, 1, length(Attributes) - 1), ', {"Id": "Status", "Value": 1, "Unit": "x"}',
 ', {"Id": "Cup Size", "Value": ', _pos % 5, ', "Unit": "cl"}, {"Id": "Temperature", "Value": 1, "Unit": "K"}]')"""
    rows = _valid(spark, sf_dir).where(F.lower("DeviceType").contains("coffee")).withColumn("Attributes", F.expr(more))
    rows = staged(rows, "clashes")
    first = coffee.coffee_machine_table(rows)
    last = coffee.coffee_machine_table(rows, on_duplicate="last")
    return first.withColumn("counts", F.lit("first")).unionByName(last.withColumn("counts", F.lit("last"))).drop("_ingested_at", "_source_file")


def attribute_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coffee.attribute_rows(_silver(spark, sf_dir)).select(*IDENTITY, "Id", "Value", "Unit")


def attribute_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attribute Ids with their column stem."""
    ids = coffee.attribute_ids(_silver(spark, sf_dir))
    return ids.select("Id", F.regexp_replace("Id", r"(?U)[^\w]", "_").alias("stem"))


def attribute_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that occur in the data but not among the known ones, here those with a Celsius unit."""
    rows = _bronze(spark, sf_dir)
    known = coffee.attribute_rows(rows).where(F.col("Unit") == "Celsius").select("Id").distinct()
    return coffee.new_attribute_ids(rows, known)


def unknown_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return devices.unknown_type_counts(_silver(spark, sf_dir))


def unknown_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return devices.unknown_types(_silver(spark, sf_dir))


def id_prefix_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with and without the device-id prefix."""
    rows = _bronze(spark, sf_dir)
    parts = [
        ordering.with_id_prefix(rows).select(F.lit("prefixed").alias("part"), "DeviceId"),
        ordering.without_id_prefix(rows).select(F.lit("other").alias("part"), "DeviceId"),
    ]
    return ordering.concatenated(parts).groupBy("part", "DeviceId").agg(F.count("*").alias("rows"))


def failure_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir).where(is_failure(F.col("Status"))).select(*IDENTITY, "_pos")


# --- summary --------------------------------------------------------------------------------------


def device_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.ordered_summary(summary.device_summary(_silver(spark, sf_dir)))


def device_summary_elapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.device_summary(_silver(spark, sf_dir), elapsed=True)


def summary_join_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.device_summary_by_join(_silver(spark, sf_dir))


def devices_with_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary.devices_with_failures(summary.device_summary(_silver(spark, sf_dir)))


def summary_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary after every batch; a batch's events are counted once and never read again."""
    events = build_silver(device_events(spark, sf_dir), PROCESSED_AT).events
    partials = staged(summary.summary_partials(events, ["_batch_id"]), "partials")
    return summary.summary_by_batch(partials, "_batch_id")


# --- quality --------------------------------------------------------------------------------------


def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_silver(_bronze(spark, sf_dir), PROCESSED_AT).stages


def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_silver(_bronze(spark, sf_dir), PROCESSED_AT).metrics


def quality_by_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of every load; of any range of loads they add up to those of `stage_counts`."""
    return build_silver(device_events(spark, sf_dir), PROCESSED_AT).counters(["_batch_id"])


def quality_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs append their checks to the log; the one with the low limit would have stopped."""
    path, metrics = shared_dir(spark, "quality-log"), staged(quality_metrics(spark, sf_dir), "metrics")
    for run_at, limit in (("2024-02-02T00:00:00Z", 1.0), ("2024-02-03T00:00:00Z", 99.0)):
        checks = quality.quality_alerts(metrics, invalid_threshold=limit)
        tables.append_rows(checks.withColumn("_run_at", F.lit(run_at)), path)
        try:
            quality.enforce(checks.where(F.col("check") == "invalid_pct"), "fail")
            stopped = False
        except quality.QualityBreach:
            stopped = True
        tables.append_rows(checks.limit(1).select(F.lit("stopped").alias("check"), F.lit(stopped).alias("breached"), F.lit(run_at).alias("_run_at")), path)
    schema = "check string, value double, threshold double, breached boolean, message string, _run_at string"
    return spark.read.schema(schema).parquet(path).select("check", "value", "threshold", "breached", "_run_at")


def quality_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a low limit on invalid rows, so that one check fires."""
    metrics = build_silver(_bronze(spark, sf_dir), PROCESSED_AT).metrics
    return quality.quality_alerts(metrics, invalid_threshold=1.0)


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    washing = devices.washing_machine_table(_silver(spark, sf_dir))
    return quality.rule_violations(
        washing,
        {
            "canonical_time": F.col("TimestampUTC").rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"),
            "temperature_range": F.col("Temperature_C").between(0, 100),
            "no_blank_status": ~is_blank(F.col("Status")),
            "known_speed": F.col("SpinningSpeed").between(650, 1350),
        },
    )


def routing_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver is staged once, since every gold table reads it."""
    silver = staged(_silver(spark, sf_dir), "silver")
    gold = build_gold(silver)
    return quality.routing_counts(silver, {name: gold[name] for name in DEVICE_TABLES})


def routed_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same check on silver stored by family, where every gold table reads its partitions only."""
    path = shared_dir(spark, "routed")
    tables.overwrite_table(devices.with_families(_silver(spark, sf_dir)), path, partition_by=[devices.FAMILIES])
    silver = tables.read_table(spark, path, ROUTED_SILVER)
    gold = build_gold(silver)
    return quality.routing_counts(silver, {name: gold[name] for name in DEVICE_TABLES})


# --- tables, files and streams --------------------------------------------------------------------


def rows_by_device_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir).groupBy("DeviceType").agg(F.count("*").alias("rows"))


def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.sample_rows(_silver(spark, sf_dir), 100, seed=7).select(*IDENTITY)


def _batch_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device events as a batch-partitioned table, each batch written twice over."""
    path = shared_dir(spark, "batches")
    rows = device_events(spark, sf_dir)
    tables.write_batches(rows, path)
    tables.write_batches(rows.where(F.col("_batch_id") % 2 == 0), path)
    return tables.read_table(spark, path)


def replay_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    replay = tables.replay_counts(_batch_table(spark, sf_dir))
    return replay.withColumn("_batch_id", F.col("_batch_id").cast("bigint"))


def as_of_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as it was before its last batch."""
    table = _batch_table(spark, sf_dir)
    last = table.agg(F.max("_batch_id").alias("last")).first().last
    return tables.as_of_batch(table, last - 1).select(*IDENTITY, "_pos")


def batch_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.list_batches(device_events(spark, sf_dir))


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "silver-csv")
    write_csv(_silver(spark, sf_dir), path)
    return read_csv(spark, path, SILVER).select(*IDENTITY, "Attributes", "_silver_processed_at")


def csv_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One CSV file whose fields hold line breaks and quotes, read by several tasks."""
    path = shared_dir(spark, "broken-csv")
    broken = F.replace("Attributes", F.lit(", "), F.lit(',\n"'))
    write_csv(_valid(spark, sf_dir).select(*IDENTITY, broken.alias("Attributes"), "_pos").coalesce(1), path)
    schema = T.StructType([BRONZE[c] for c in (*IDENTITY, "Attributes", "_pos")])
    return read_csv(spark, path, schema, range_bytes=1 << 16)


def table_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a table that is created empty, filled, refreshed with nothing; and of the layers on an empty table."""
    path, rows = shared_dir(spark, "lifecycle"), _silver(spark, sf_dir)

    def state(step: str, table: DataFrame) -> DataFrame:
        # Written at once, as the table changes with the next step.
        return staged(table.agg(F.count("*").alias("rows")).select(F.lit(step).alias("step"), "rows"), "step")

    tables.create_table(spark, path, SILVER)
    steps = [state("created", tables.read_table(spark, path, SILVER))]
    any_rows = tables.write_if_any(rows, path)
    steps.append(state(f"filled {any_rows}", tables.read_table(spark, path, SILVER)))
    any_rows = tables.write_if_any(rows.where("false"), path)
    steps.append(state(f"refreshed {any_rows}", tables.read_table(spark, path, SILVER)))
    empty = build_silver(_bronze(spark, sf_dir).where("false"), PROCESSED_AT)
    steps.append(state("empty silver", empty.events))
    steps += [state(f"empty {name}", table) for name, table in build_gold(empty.events).items()]
    return ordering.concatenated(steps)


def replay_previews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of the two previews after every third batch: which rows they show is free."""
    table, parts = _batch_table(spark, sf_dir), []
    numbered = tables.list_batches(table).withColumn("_i", F.row_number().over(Window.orderBy(tables.BATCH)) - 1)
    batches = staged(numbered.where("_i % 3 = 0").select(tables.BATCH), "batches")
    for kind, rows in zip(("plain", "prefixed"), tables.replay_samples(table, batches, n=500)):
        sizes = rows.groupBy("_state").agg(
            F.count("*").alias("rows"), F.count_if(F.col("DeviceId").startswith("syn_")).alias("prefixed_rows")
        )
        counted = batches.join(sizes, F.col(tables.BATCH) == F.col("_state"), "left")
        parts.append(
            counted.select(
                F.col(tables.BATCH).cast("long").alias(tables.BATCH),
                F.lit(kind).alias("preview"),
                *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("rows", "prefixed_rows")],
            )
        )
    return ordering.concatenated(parts)


def layers_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table that a run from message lines to gold leaves."""
    source, output = shared_dir(spark, "messages"), shared_dir(spark, "lake")
    # The files' names follow the order, in which arrivals are compared.
    messages(spark, sf_dir).orderBy("_pos").select(F.col("message").alias("value")).write.text(source)
    result = run_layers(spark, source, output, batch_id=1, ingested_at=PROCESSED_AT, processed_at=PROCESSED_AT, layout="lines")
    counts = {"bronze": result.bronze.rows_written, "silver": result.silver.rows_out, **result.gold.rows_by_table}
    counts |= {"unknown_types": result.gold.unknown_types, "alerts": len(result.alerts)}
    return spark.createDataFrame(list(counts.items()), "`table` string, rows long")


def zorder_skipping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows found by device, by time and by both on a table clustered on the two, and whether files were skipped."""
    path, silver = shared_dir(spark, "zorder"), staged(_silver(spark, sf_dir), "silver")
    compact_z(silver, path, files=16)
    device = silver.agg(F.min("DeviceId")).first()[0]
    stored, parts = spark.read.parquet(f"{path}/files").count(), []
    filters = {"device": {"DeviceId": (device, device)}, "time": {"TimestampUTC": (None, "2024-01-02T23:59:59Z")}}
    filters["both"] = filters["device"] | filters["time"]
    for name, ranges in filters.items():
        rows = read_skipping(spark, path, SILVER, ranges)
        skips = len(rows.inputFiles()) < stored
        parts.append(rows.agg(F.count("*").alias("rows")).select(F.lit(name).alias("filter"), "rows", F.lit(skips).alias("skips")))
    return ordering.concatenated(parts)


def attribute_drift_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths that most events have and the known ones, a fifth, don't; in most events the unit is an object, too."""
    path, rows = shared_dir(spark, "schemas"), messages(spark, sf_dir)
    rows = rows.where(F.lower("DeviceType").rlike("washing|dishwasher") & ~F.col("Attributes").contains("FailureIds"))
    tables.overwrite_table(drift.family_schemas(rows.where("event_id % 5 = 0")), path)
    unit = F.regexp_replace("Attributes", '"(Celsius|Fahrenheit)"', '{"name": "$1", "scale": [1, 2]}')
    found = drift.family_schemas(rows.where("event_id % 5 <> 0").withColumn("Attributes", unit))
    return drift.schema_drift(drift.stored_schemas(spark, path), found).select("family", "path", "old_type", "new_type")


def registered_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A compacted table by its name in the catalog, and the failure view beside it."""
    path = shared_dir(spark, "registered")
    silver = staged(_silver(spark, sf_dir), "silver")
    compact(silver, path)
    name = "events_" + uuid.uuid4().hex
    register(spark, name, path)
    register_failure_view(summary.device_summary(silver), f"failing_{name}")
    return spark.sql(
        f"""select e.DeviceType, count(*) as rows, count(f.DeviceId) as rows_of_failing
from {name} e left join failing_{name} f on f.DeviceId = e.DeviceId and f.DeviceType = e.DeviceType group by e.DeviceType"""
    )


def compacted_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "compact")
    compact(_silver(spark, sf_dir), path)
    return tables.read_table(spark, path, SILVER).select(*IDENTITY, "_pos")


def _streamed(spark: SparkSession, sf_dir: str) -> str:
    """Bronze table filled by a stream over one JSON-array file per batch."""
    files = shared_dir(spark, "files")
    arrays = _array_files(spark, sf_dir)
    arrays.select("value", "_source_file").write.partitionBy("_source_file").text(files)
    output = shared_dir(spark, "bronze")
    stream = message_stream(spark, files, "2024-02-01T00:00:00Z")
    stream_to_bronze(stream, output, shared_dir(spark, "checkpoint"), first_batch=1_000).awaitTermination()
    return output


def streaming_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_bronze(spark, _streamed(spark, sf_dir)).select(*IDENTITY, "_pos")


def streaming_bad_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    dead = read_bronze_dead_letters(spark, _streamed(spark, sf_dir))
    return dead.groupBy(F.get_json_object("_raw_error", "$._error").alias("error")).agg(F.count("*").alias("files"))


def streaming_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver keys of a stream over the stored device events; the delay spans the data."""
    source, output = shared_dir(spark, "events"), shared_dir(spark, "silver")
    tables.overwrite_table(_bronze(spark, sf_dir), source)
    stored = tables.read_table(spark, source)
    stream = silver_stream(spark.readStream.schema(stored.schema).parquet(source), PROCESSED_AT, delay="400 days")
    query = (
        stream.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", shared_dir(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return tables.read_table(spark, output).select(*IDENTITY)


def _streamed_silver(spark: SparkSession, sf_dir: str) -> str:
    """Silver and dead letters of a stream over the stored device events, in two arrivals."""
    source, output, checkpoint = (shared_dir(spark, name) for name in ("events", "silver", "checkpoint"))
    rows = device_events(spark, sf_dir)
    for arrival in (0, 1):
        tables.append_rows(rows.where(F.col("_batch_id") % 2 == arrival).drop("_batch_id"), source)
        stream = spark.readStream.schema(BRONZE).parquet(source)
        stream_to_silver(stream, output, checkpoint, PROCESSED_AT, first_batch=1_000).awaitTermination()
    return output


def streaming_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No watermark: whatever arrives late is kept."""
    return read_stream_silver(spark, _streamed_silver(spark, sf_dir)).select(*IDENTITY)


def streaming_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals, the later events first, equal one run over all of them."""
    source, output, checkpoint = (shared_dir(spark, name) for name in ("events", "loads", "checkpoint"))
    rows = device_events(spark, sf_dir)
    for arrival in (1, 0):
        tables.append_rows(rows.where(F.col("_batch_id") % 2 == arrival).drop("_batch_id"), source)
        stream = spark.readStream.schema(BRONZE).parquet(source)
        stream_loads(stream, output, checkpoint, PROCESSED_AT, first_batch=1).awaitTermination()
    return read_days(spark, output).select(*SILVER.names)


def streaming_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_stream_dead_letters(spark, _streamed_silver(spark, sf_dir))
    return rows.select(*IDENTITY, "_pos", "_rejection_reason")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in [
        device_summary,
        device_summary_elapsed,
        summary_join_form,
        devices_with_failures,
        bronze_records,
        bronze_dead_letter,
        bronze_array_elements,
        bronze_array_text,
        bronze_lines,
        bronze_bad_files,
        validate_split,
        dead_letter,
        missing_column,
        normalize_timestamps,
        normalize_device_type,
        exact_dedup,
        duplicate_keys,
        restrict_to_keys,
        part_name_similarity,
        status_similarity,
        candidate_pairs,
        candidate_pairs_per_device,
        fuzzy_dedup,
        fuzzy_dedup_case_sensitive,
        fuzzy_dedup_no_time,
        silver_events,
        silver_ordered,
        silver_upsert,
        gold_washing,
        gold_dishwasher,
        gold_unknown,
        gold_coffee,
        attribute_long,
        attribute_ids,
        attribute_drift,
        unknown_type_counts,
        unknown_types,
        id_prefix_split,
        failure_events,
        stage_counts,
        quality_metrics,
        quality_alerts,
        quality_rules,
        routing_check,
        rows_by_device_type,
        sample_rows,
        replay_cumulative,
        as_of_batch,
        batch_list,
        csv_round_trip,
        compacted_table,
        streaming_bronze,
        streaming_bad_files,
        streaming_dedup,
        streaming_silver,
        streaming_dead_letter,
        bronze_split_array,
        incremental_silver,
        incremental_summary,
        fuzzy_dedup_crowded,
        gold_malformed,
        coffee_name_clashes,
        summary_by_batch,
        quality_by_batch,
        quality_log,
        routed_gold,
        csv_line_breaks,
        table_lifecycle,
        replay_previews,
        layers_end_to_end,
        streaming_near_duplicates,
        zorder_skipping,
        attribute_drift_all,
        registered_table,
    ]
}
