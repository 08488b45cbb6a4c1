"""Required fields, event-time normalisation and the split into valid rows and dead letters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.functions.text import device_type_case, is_blank
from hearthline.functions.timestamps import canonical_utc
from hearthline.schemas import BAD_TIMESTAMP, IDENTITY, MISSING_FIELD


def with_required_columns(events: DataFrame) -> DataFrame:
    """Add identity columns the input lacks as NULL, so that all its rows are rejected."""
    missing = {c: F.lit(None).cast("string") for c in IDENTITY if c not in events.columns}
    return events.withColumns(missing) if missing else events


def with_rejection_reason(events: DataFrame, lenient: bool = True) -> DataFrame:
    """Adds `_canonical_ts` and `_rejection_reason` (NULL for valid rows)."""
    events = with_required_columns(events)
    as_text = events.withColumns({c: F.col(c).cast("string") for c in IDENTITY})
    blank = reduce(lambda x, y: x | y, [is_blank(F.col(c)) for c in IDENTITY])
    reason = F.when(blank, F.lit(MISSING_FIELD)).when(F.col("_canonical_ts").isNull(), F.lit(BAD_TIMESTAMP))
    return as_text.withColumn("_canonical_ts", canonical_utc(F.col("TimestampUTC"), lenient)).withColumn(
        "_rejection_reason", reason
    )


def valid_events(judged: DataFrame, device_type_mode: str = "none") -> DataFrame:
    """Accepted rows with the canonical UTC timestamp."""
    return (
        judged.where(F.col("_rejection_reason").isNull())
        .withColumns(
            {
                "TimestampUTC": F.col("_canonical_ts"),
                "DeviceType": device_type_case(F.col("DeviceType"), device_type_mode),
            }
        )
        .drop("_canonical_ts", "_rejection_reason")
    )


def rejected_events(judged: DataFrame) -> DataFrame:
    """Rejected rows as they arrived, with the reason."""
    return judged.where(F.col("_rejection_reason").isNotNull()).drop("_canonical_ts")
