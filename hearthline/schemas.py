"""Column names, schemas and default settings shared by the layers."""

from __future__ import annotations

from pyspark.sql import types as T

# Field names of the device message and the audit columns stamped by each layer.
IDENTITY = ["DeviceId", "TimestampUTC", "DeviceType", "Status"]
AUDIT = ["_ingested_at", "_silver_processed_at", "_source_file"]
# Arrival order of events: load time, then file, then position in the file.
ARRIVAL = ["_ingested_at", "_source_file", "_pos"]

# Device families, recognised by a word in DeviceType.
DEVICE_FAMILIES = ["washing", "coffee", "dishwasher"]

# Rejection reasons, similarity threshold (0-100) and alert thresholds (percent).
MISSING_FIELD = "missing_required_field"
BAD_TIMESTAMP = "unparseable_timestamp"
SIMILARITY_THRESHOLD = 90
ALERT_INVALID_PCT = 5.0
ALERT_POST_DEDUP_PCT = 20.0


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


MESSAGE = T.StructType(_strings(*IDENTITY, "Attributes"))
BRONZE = T.StructType(
    [*_strings(*IDENTITY, "Attributes", "_ingested_at", "_source_file"), T.StructField("_pos", T.LongType())]
)
SILVER = T.StructType([*BRONZE.fields, *_strings("_silver_processed_at")])
SILVER_DEAD_LETTER = T.StructType([*SILVER.fields, *_strings("_rejection_reason")])

# Attribute leaves are read as text and cast one by one, so one bad leaf never empties its neighbours.
WASHING_ATTRIBUTES = T.StructType(
    [
        *_strings("Temperature", "Temperature_Unit", "SpinningSpeed", "SpinningSpeed_Unit"),
        T.StructField("TwinDos", T.ArrayType(T.StringType())),
        *_strings("TwinDos_Unit"),
        T.StructField("FailureIds", T.ArrayType(T.StringType())),
    ]
)
DISHWASHER_ATTRIBUTES = T.StructType(
    [
        *_strings("Temperature", "Temperature_Unit", "QuickPowerWashActive", "QuickPowerWashActive_Unit"),
        T.StructField("FailureIds", T.ArrayType(T.StringType())),
    ]
)
COFFEE_ATTRIBUTE = T.StructType(_strings("Id", "Value", "Unit"))
