import pytest
from pyspark.sql import functions as F

from hearthline.session import SHUFFLE_CLEANUP, staged, staged_in_buckets


def bucketed(spark, rows):
    return staged_in_buckets(rows.repartition(4, "k"), "wide-rows", "k", 4)


def test_a_join_leaves_bucketed_rows_where_they_are(spark):
    rows = spark.range(1000).select(F.col("id").alias("k"), F.repeat(F.lit("x"), F.lit(50)).alias("text"))
    few = spark.range(0, 1000, 3).select(F.col("id").alias("k")).hint("merge")
    with bucketed(spark, rows) as wide:
        joined = wide.join(few, "k")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1
        assert {r.k for r in joined.collect()} == set(range(0, 1000, 3))


def test_the_name_ends_with_the_context_also_after_an_error(spark):
    before = spark.catalog.listTables()
    with pytest.raises(ValueError), bucketed(spark, spark.range(5).withColumnRenamed("id", "k")) as wide:
        assert wide.count() == 5
        raise ValueError
    assert spark.catalog.listTables() == before


def test_an_empty_table_has_buckets_too(spark):
    with bucketed(spark, spark.range(0).withColumnRenamed("id", "k")) as wide:
        assert wide.columns == ["k"] and wide.isEmpty()


def test_staging_leaves_the_setting_as_it_was(spark):
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    assert staged(spark.range(3).groupBy("id").count(), "rows").count() == 3
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before
