"""Attribute parsing: units, bits, numeric leaves and the coffee attribute list."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hearthline.functions.text import stripped
from hearthline.schemas import COFFEE_ATTRIBUTE


def number(text: Column) -> Column:
    return text.try_cast("double")


def integer(text: Column) -> Column:
    """Whole number from text; decimals such as `900.0` are truncated, anything else is NULL."""
    return text.try_cast("double").try_cast("int")


def integers(texts: Column) -> Column:
    return F.transform(texts, integer)


def celsius(value: Column, unit: Column, round_all: bool = False) -> Column:
    """Temperature in degrees Celsius; only units `f` and `fahrenheit` (any case) are converted.

    Converted values are rounded to two decimals; with `round_all` the others are rounded as well.
    """
    converted = F.round((value - F.lit(32.0)) * F.lit(5.0) / F.lit(9.0), 2)
    return F.when(F.lower(unit).isin("f", "fahrenheit"), converted).otherwise(
        F.round(value, 2) if round_all else value
    )


def celsius_unit(celsius_value: Column) -> Column:
    """`Celsius` wherever a temperature exists."""
    return F.when(celsius_value.isNotNull(), F.lit("Celsius"))


def bit_flag(text: Column) -> Column:
    """0/1 as a boolean; NULL when absent or not a number."""
    return integer(text) != 0


def coffee_attributes(json_text: Column) -> Column:
    """`array<struct<Id, Value, Unit>>` from a list of attribute objects or one bare object.

    Elements that are no objects are skipped and Ids are stripped; NULL when nothing parses.
    """
    elements = F.coalesce(
        F.from_json(json_text, "array<string>"),
        F.when(F.ltrim(json_text).startswith("{"), F.array(json_text)),
    )
    objects = F.filter(elements, lambda e: F.ltrim(e).startswith("{"))
    parsed = F.transform(objects, lambda e: F.from_json(e, COFFEE_ATTRIBUTE))
    return F.transform(
        parsed,
        lambda a: F.struct(
            stripped(a["Id"]).alias("Id"),
            number(a["Value"]).alias("Value"),
            a["Unit"].alias("Unit"),
        ),
    )
