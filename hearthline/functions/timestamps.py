"""Event-time normalisation without any dependence on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CANONICAL = "yyyy-MM-dd'T'HH:mm:ss'Z'"
STRICT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z?$"
# date, hour:minute, :second, then Z or an offset split into sign, hours and minutes
LENIENT = (
    r"^(\d{4}-\d{2}-\d{2})"
    r"(?:[T ](\d{2}:\d{2})(?:(:\d{2})(?:[.,]\d+)?)?"
    r"(?:Z|([+-])([01]\d|2[0-3])(?::?([0-5]\d))?)?)?$"
)


def canonical_utc(text: Column, lenient: bool = True) -> Column:
    """`yyyy-MM-ddTHH:mm:ssZ` in UTC, or NULL when the text is no valid time.

    The plain form, with or without `Z`, only needs a validity check. With `lenient`, ISO-8601 forms
    with an offset, a fraction (cut off), a blank for the `T`, no seconds or no time part are accepted too.
    """
    plain = F.when(
        F.substring(text, 1, 19).try_cast("timestamp_ntz").isNotNull(),
        F.concat(F.substring(text, 1, 19), F.lit("Z")),
    )
    if not lenient:
        return F.when(text.rlike(STRICT), plain)

    # Unmatched groups are empty: `2024-05-01 `, `2024-05-01 08:30` and full times are all valid casts.
    local = F.regexp_replace(text, LENIENT, "$1 $2$3").try_cast("timestamp_ntz")
    offset = F.rpad(F.regexp_replace(text, LENIENT, "$4$5:$6"), 6, "0").try_cast("interval hour to minute")
    general = F.date_format(local - F.coalesce(offset, F.expr("interval '0:00' hour to minute")), CANONICAL)
    return F.when(text.rlike(STRICT), plain).when(text.rlike(LENIENT), general)


def as_event_time(canonical: Column) -> Column:
    """Canonical text as a zone-less UTC timestamp."""
    return F.substring(canonical, 1, 19).try_cast("timestamp_ntz")
