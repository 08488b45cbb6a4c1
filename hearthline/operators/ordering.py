"""Sorted output, concatenation and repeatable samples."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthline.schemas import IDENTITY


def silver_order(silver: DataFrame) -> DataFrame:
    """By device and time, NULLs last."""
    return silver.orderBy(F.asc_nulls_last("DeviceId"), F.asc_nulls_last("TimestampUTC"))


def clustered(rows: DataFrame, files: int | None = None, by: Sequence[str] = ("DeviceId", "TimestampUTC")) -> DataFrame:
    """Range-partitioned and sorted within partitions, for few files with tight value ranges.

    The time is part of the range, so one device with very many events still spreads over files.
    """
    ranged = rows.repartitionByRange(files, *by) if files else rows.repartitionByRange(*by)
    return ranged.sortWithinPartitions(*by)


def concatenated(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of frames with the same columns in any order."""
    return reduce(lambda x, y: x.unionByName(y), parts)


def sample_rows(rows: DataFrame, k: int, seed: int = 0, key: Sequence[str] = IDENTITY) -> DataFrame:
    """`k` rows chosen by a hash of key and seed: the same rows on every run."""
    return rows.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), *key)), *key).limit(k)


def with_id_prefix(rows: DataFrame, prefix: str = "syn_") -> DataFrame:
    return rows.where(F.col("DeviceId").startswith(prefix))


def without_id_prefix(rows: DataFrame, prefix: str = "syn_") -> DataFrame:
    return rows.where(~F.coalesce(F.col("DeviceId").startswith(prefix), F.lit(False)))
