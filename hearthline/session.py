"""Session helpers: a builder with the settings the layers expect, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting by which a statement removes its shuffle files when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "hearthline", master: str | None = None, **conf: object) -> SparkSession:
    """Session with UTC times and adaptive execution; keyword `conf` entries use `__` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder named in `spark.checkpoint.dir`.

    The setting has to name storage every executor can reach. Only a local master, where driver and
    executors share one machine, may do without it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="hearthline-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Statements in here remove their shuffle files when they end."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before) if before else spark.conf.unset(SHUFFLE_CLEANUP)


def staged(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table written to the shared folder.

    Cuts the lineage, survives lost executors, and gives the planner the real size, by which it decides
    whether a join may broadcast the table. The shuffles that led to the table are removed once it is written:
    nothing reads them again, and those of many steps would add up on the executors' disks.
    """
    spark = rows.sparkSession
    path = shared_dir(spark, purpose)
    with _shuffles_removed(spark):
        rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@contextmanager
def staged_in_buckets(rows: DataFrame, purpose: str, key: str, buckets: int) -> Iterator[DataFrame]:
    """The rows as a table in the shared folder, in buckets of `key`: a join on the key leaves them where they are.

    For wide rows that several joins need. The rows should be partitioned by `key` into as many partitions, so that
    every bucket is one file. The bucketing is known to the catalog only, where the table has a name until the end of
    the context; all that reads it has to be written by then. The files stay, as those of `staged`.
    """
    spark = rows.sparkSession
    name = f"{purpose.replace('-', '_')}_{uuid.uuid4().hex}"
    with _shuffles_removed(spark):
        rows.write.bucketBy(buckets, key).option("path", shared_dir(spark, purpose)).saveAsTable(name, format="parquet")
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
