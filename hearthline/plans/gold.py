"""Gold layer: one flat table per device family, the fallback table and the device summary."""

from __future__ import annotations

from pyspark.sql import DataFrame

from hearthline.operators.coffee import coffee_machine_table
from hearthline.operators.devices import dishwasher_table, unknown_device_table, washing_machine_table
from hearthline.operators.summary import device_summary

DEVICE_TABLES = ["gold_washing_machine", "gold_coffee_machine", "gold_dishwasher", "gold_unknown_devices"]


def build_gold(silver: DataFrame, coffee_columns: list[tuple[str, str]] | None = None) -> dict[str, DataFrame]:
    """Gold tables by name. Only finding the coffee columns, if not given, runs a job."""
    return {
        "gold_washing_machine": washing_machine_table(silver),
        "gold_coffee_machine": coffee_machine_table(silver, coffee_columns),
        "gold_dishwasher": dishwasher_table(silver),
        "gold_unknown_devices": unknown_device_table(silver),
        "gold_summary": device_summary(silver),
    }
