"""Flat tables per device family: washing machines, dishwashers and the fallback for unknown types."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.functions.attributes import bit_flag, celsius, celsius_unit, integer, integers, number
from hearthline.functions.text import is_family
from hearthline.schemas import AUDIT, DEVICE_FAMILIES, DISHWASHER_ATTRIBUTES, IDENTITY, WASHING_ATTRIBUTES

#: Partition column of routed tables, and its value for events that belong to no family.
FAMILIES, UNKNOWN_FAMILY = "_families", "unknown"


def audit_columns(events: DataFrame) -> list[str]:
    return [c for c in AUDIT if c in events.columns]


def with_families(events: DataFrame) -> DataFrame:
    """Adds the family words that DeviceType contains, joined by `+`, as a column to partition a table by."""
    words = F.concat_ws("+", *[F.when(is_family(F.col("DeviceType"), f), F.lit(f)) for f in DEVICE_FAMILIES])
    return events.withColumn(FAMILIES, F.when(words != "", words).otherwise(UNKNOWN_FAMILY))


def of_family(events: DataFrame, family: str) -> DataFrame:
    """Events whose DeviceType contains the family word; a type with two such words is in both.

    Of a table partitioned by `with_families` only the partitions of the family are read.
    """
    if FAMILIES in events.columns:
        return events.where(F.col(FAMILIES).contains(family))
    return events.where(is_family(F.col("DeviceType"), family))


def of_unknown_type(events: DataFrame) -> DataFrame:
    """Events that belong to no known family."""
    if FAMILIES in events.columns:
        return events.where(F.col(FAMILIES) == UNKNOWN_FAMILY)
    known = reduce(lambda x, y: x | y, [is_family(F.col("DeviceType"), f) for f in DEVICE_FAMILIES])
    return events.where(~known)


def unknown_types(events: DataFrame) -> DataFrame:
    """Distinct DeviceType values outside the known families."""
    return of_unknown_type(events).select("DeviceType").distinct()


def unknown_type_counts(events: DataFrame) -> DataFrame:
    """DeviceType values outside the known families, with their numbers of events."""
    return of_unknown_type(events).groupBy("DeviceType").agg(F.count("*").alias("rows"))


def _failure_rows(a: Column) -> Column:
    """One row per failure id; an event without ids keeps one row with NULL."""
    return F.explode_outer(integers(a["FailureIds"])).alias("FailureId")


def washing_machine_table(events: DataFrame, with_temperature_unit: bool = False) -> DataFrame:
    """Washing-machine events, one row per failure id, temperature in Celsius, TwinDos in two columns."""
    a = F.col("_a")
    parsed = of_family(events, "washing").withColumn("_a", F.from_json("Attributes", WASHING_ATTRIBUTES))
    temperature = celsius(number(a["Temperature"]), a["Temperature_Unit"])
    unit = [celsius_unit(number(a["Temperature"])).alias("Temperature_Unit")] if with_temperature_unit else []
    return parsed.select(
        *IDENTITY,
        temperature.alias("Temperature_C"),
        *unit,
        integer(a["SpinningSpeed"]).alias("SpinningSpeed"),
        a["SpinningSpeed_Unit"].alias("SpinningSpeed_Unit"),
        integer(F.get(a["TwinDos"], 0)).alias("TwinDos_Colour"),
        integer(F.get(a["TwinDos"], 1)).alias("TwinDos_White"),
        a["TwinDos_Unit"].alias("TwinDos_Unit"),
        _failure_rows(a),
        *audit_columns(events),
    )


def dishwasher_table(events: DataFrame) -> DataFrame:
    """Dishwasher events, one row per failure id, temperature in Celsius, the wash bit as boolean."""
    a = F.col("_a")
    parsed = of_family(events, "dishwasher").withColumn("_a", F.from_json("Attributes", DISHWASHER_ATTRIBUTES))
    return parsed.select(
        *IDENTITY,
        celsius(number(a["Temperature"]), a["Temperature_Unit"], round_all=True).alias("Temperature_C"),
        bit_flag(a["QuickPowerWashActive"]).alias("QuickPowerWashActive"),
        _failure_rows(a),
        *audit_columns(events),
    )


def unknown_device_table(events: DataFrame) -> DataFrame:
    """Events of unknown types with their Attributes as they came."""
    return of_unknown_type(events).select(*IDENTITY, "Attributes", *audit_columns(events))
