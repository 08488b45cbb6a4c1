"""Text predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(text: Column) -> Column:
    """True for NULL and for text without any non-whitespace character (tabs and newlines included)."""
    return text.isNull() | ~text.rlike(r"(?U)\S")


def stripped(text: Column) -> Column:
    """Text without leading and trailing whitespace of any kind."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def is_failure(status: Column) -> Column:
    """Status mentions a failure, in any letter case."""
    return F.coalesce(F.lower(status).contains("failure"), F.lit(False))


def is_family(device_type: Column, family: str) -> Column:
    """DeviceType contains the family word, in any letter case."""
    return F.coalesce(F.lower(device_type).contains(family), F.lit(False))


def device_type_case(device_type: Column, mode: str = "none") -> Column:
    """Optional letter-case normalisation of DeviceType: `none` or `initcap`."""
    if mode == "none":
        return device_type
    if mode == "initcap":
        return F.initcap(device_type)
    raise ValueError(f"unknown mode {mode!r}")
