"""Per-device reliability summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearthline.functions.text import is_failure
from hearthline.functions.timestamps import as_event_time

DEVICE = ["DeviceId", "DeviceType"]


def _rate_pct(failures: Column, total: Column) -> Column:
    return F.coalesce(F.round(F.try_divide(failures, total) * F.lit(100.0), 2), F.lit(0.0))


def _days(first: Column, last: Column, elapsed: bool) -> Column:
    return F.timestamp_diff("DAY", first, last).cast("int") if elapsed else F.datediff(last, first)


def _finish(counts: DataFrame, elapsed: bool, also: Sequence[str] = ()) -> DataFrame:
    return counts.select(
        *DEVICE,
        *also,
        "total_events",
        "failure_events",
        "first_seen_utc",
        "last_seen_utc",
        _rate_pct(F.col("failure_events"), F.col("total_events")).alias("failure_rate_pct"),
        _days(F.col("first_seen_utc"), F.col("last_seen_utc"), elapsed).alias("days_active"),
    )


def summary_partials(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Events, failures, first and last event per device and, for example, load or day.

    Partials of disjoint sets of events add up: `folded_summary` makes a summary of any of them.
    """
    seen = events.select(*DEVICE, *by, as_event_time(F.col("TimestampUTC")).alias("_at"), is_failure(F.col("Status")).alias("_f"))
    return seen.groupBy(*DEVICE, *by).agg(
        F.count("*").alias("total_events"),
        F.sum(F.when(F.col("_f"), 1).otherwise(0)).alias("failure_events"),
        F.min("_at").alias("first_seen_utc"),
        F.max("_at").alias("last_seen_utc"),
    )


def _folded(partials: DataFrame) -> DataFrame:
    return partials.groupBy(*DEVICE).agg(
        F.sum("total_events").alias("total_events"),
        F.sum("failure_events").alias("failure_events"),
        F.min("first_seen_utc").alias("first_seen_utc"),
        F.max("last_seen_utc").alias("last_seen_utc"),
    )


def folded_summary(partials: DataFrame, elapsed: bool = False) -> DataFrame:
    """Device summary from partial counts; no event is read."""
    return _finish(_folded(partials), elapsed)


def device_summary(events: DataFrame, elapsed: bool = False) -> DataFrame:
    """Events, failures, first and last event, failure rate and days active per device.

    Days are calendar days between first and last event, or whole 24-hour periods with `elapsed`.
    """
    return _finish(summary_partials(events), elapsed)


def summary_by_batch(partials: DataFrame, batch: str, elapsed: bool = False) -> DataFrame:
    """The device summary after every batch, from partial counts per device and batch.

    A device appears from its first batch on, with one row per batch of its own; rows of other batches would
    repeat it.
    """
    upto = Window.partitionBy(*DEVICE).orderBy(batch).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = partials.select(
        *DEVICE,
        batch,
        F.sum("total_events").over(upto).alias("total_events"),
        F.sum("failure_events").over(upto).alias("failure_events"),
        F.min("first_seen_utc").over(upto).alias("first_seen_utc"),
        F.max("last_seen_utc").over(upto).alias("last_seen_utc"),
    )
    return _finish(running, elapsed, [batch])


def device_summary_by_join(events: DataFrame) -> DataFrame:
    """The same summary with failures counted apart and merged in; a cross-check of `device_summary`."""
    timed = events.withColumn("_at", as_event_time(F.col("TimestampUTC")))
    totals = timed.groupBy(*DEVICE).agg(
        F.count("*").alias("total_events"),
        F.min("_at").alias("first_seen_utc"),
        F.max("_at").alias("last_seen_utc"),
    )
    failures = events.where(is_failure(F.col("Status"))).groupBy(*DEVICE).agg(F.count("*").alias("_failures"))
    merged = totals.join(failures, DEVICE, "left").withColumn(
        "failure_events", F.coalesce("_failures", F.lit(0).cast("bigint"))
    )
    return _finish(merged, elapsed=False)


def ordered_summary(summary: DataFrame) -> DataFrame:
    """By device type, most unreliable devices first."""
    return summary.orderBy("DeviceType", F.desc("failure_rate_pct"), "DeviceId")


def devices_with_failures(summary: DataFrame) -> DataFrame:
    return summary.where(F.col("failure_events") > 0)
