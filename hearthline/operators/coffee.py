"""Coffee machines: attribute lists whose columns are found in the data."""

from __future__ import annotations

import logging
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.functions.attributes import coffee_attributes
from hearthline.functions.text import is_blank
from hearthline.operators.devices import audit_columns, of_family
from hearthline.schemas import IDENTITY

logger = logging.getLogger(__name__)


def with_attribute_list(events: DataFrame) -> DataFrame:
    """Coffee-machine events with the parsed list in `_attributes`."""
    return of_family(events, "coffee").withColumn("_attributes", coffee_attributes(F.col("Attributes")))


def attribute_ids(events: DataFrame) -> DataFrame:
    """Distinct attribute Ids that are neither NULL nor blank."""
    ids = with_attribute_list(events).select(F.explode("_attributes.Id").alias("Id"))
    return ids.where(~is_blank(F.col("Id"))).distinct()


def column_stem(attribute_id: str) -> str:
    """Column name for an Id (the naming rule is fixed, as reports rely on it): every character that is no letter, digit or underscore becomes `_`."""
    return re.sub(r"[^\w]", "_", attribute_id)


def columns_for(ids: list[str]) -> list[tuple[str, str]]:
    """(Id, column stem) in Id order, without reserved names; of Ids with one name the smallest stays."""
    chosen: dict[str, tuple[str, str]] = {}
    for attribute_id in sorted(ids):
        stem = column_stem(attribute_id)
        if stem in IDENTITY:
            logger.warning("attribute %r would take the reserved column %r and is skipped", attribute_id, stem)
        elif stem.lower() in chosen:
            logger.warning("attribute %r shares its column name with %r", attribute_id, chosen[stem.lower()][0])
        else:
            chosen[stem.lower()] = (attribute_id, stem)
    return list(chosen.values())


def discover_columns(events: DataFrame) -> list[tuple[str, str]]:
    """Columns for the Ids that occur in the data.

    The names, and nothing else, have to reach the driver to become a schema: they are as many as the table
    has columns. Data whose Ids never end belongs in `attribute_rows`, or under `columns` from a table of
    known Ids, with `new_attribute_ids` to tell what that table lacks.
    """
    return columns_for([r.Id for r in attribute_ids(events).collect()])


def coffee_machine_table(
    events: DataFrame, columns: list[tuple[str, str]] | None = None, on_duplicate: str = "first"
) -> DataFrame:
    """Coffee-machine events with a `_Value` and a `_Unit` column per attribute Id.

    `columns` fixes the schema; without it one discovery job finds the Ids. If an event repeats an Id,
    its first or last entry counts.
    """
    if on_duplicate not in ("first", "last"):
        raise ValueError(f"unknown on_duplicate {on_duplicate!r}")
    if columns is None:
        columns = discover_columns(events)

    # Ids to their places in the list, made once per event; every column looks its Id up there.
    listed = with_attribute_list(events).withColumn("_ids", F.transform("_attributes", lambda a: a["Id"]))
    if on_duplicate == "last":
        listed = listed.withColumns({"_attributes": F.reverse("_attributes"), "_ids": F.reverse("_ids")})

    def entry(attribute_id: str) -> Column:
        return F.try_element_at("_attributes", F.nullif(F.array_position("_ids", attribute_id), F.lit(0)).cast("int"))

    wide = [entry(attribute_id)[field].alias(f"{stem}_{field}") for attribute_id, stem in columns for field in ("Value", "Unit")]
    return listed.select(*IDENTITY, *wide, *audit_columns(events))


def attribute_rows(events: DataFrame) -> DataFrame:
    """One row per event and attribute; events without attributes keep one row with NULLs."""
    return (
        with_attribute_list(events)
        .select(*IDENTITY, F.explode_outer("_attributes").alias("_attribute"), *audit_columns(events))
        .select(
            *IDENTITY,
            F.col("_attribute.Id").alias("Id"),
            F.col("_attribute.Value").alias("Value"),
            F.col("_attribute.Unit").alias("Unit"),
            *audit_columns(events),
        )
    )


def new_attribute_ids(events: DataFrame, known: DataFrame) -> DataFrame:
    """Attribute Ids in the data that the table `known` (column Id) does not list."""
    return attribute_ids(events).join(known.select("Id"), "Id", "left_anti")
