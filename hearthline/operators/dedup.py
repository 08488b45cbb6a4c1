"""Exact duplicates: the first arrival per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearthline.schemas import ARRIVAL, IDENTITY


def first_n_per(rows: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The first `n` rows of each key by `order`.

    The limit on the row number lets every map task drop all but its own first `n` rows of a key, so a
    key with very many copies reaches the shuffle with at most `n` rows per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") <= n).drop("_rn")


def exact_dedup(events: DataFrame, order: Sequence[str] = ARRIVAL, key: Sequence[str] = IDENTITY) -> DataFrame:
    """First arrival per identity key."""
    return first_n_per(events, key, order, 1)


def duplicate_keys(events: DataFrame, key: Sequence[str] = IDENTITY) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return events.groupBy(*key).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def restrict_to_keys(events: DataFrame, keys: DataFrame, key: Sequence[str] = IDENTITY) -> DataFrame:
    """Rows whose key occurs in `keys`; copies in `keys` are thinned out before they are shuffled."""
    return events.join(keys.select(*key).distinct(), list(key), "left_semi")


def upsert(table: DataFrame, updates: DataFrame, order: Sequence[str] = ARRIVAL, key: Sequence[str] = IDENTITY) -> DataFrame:
    """Table rows whose key is not updated, plus the first arrival per updated key."""
    incoming = exact_dedup(updates, order, key)
    kept = table.join(incoming.select(*key), list(key), "left_anti")
    return kept.unionByName(incoming)
