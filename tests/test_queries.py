"""Every registered query against its SQL twin on the smallest tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry
from hearthline.workload import queries
from hearthline.workload.device_events import messages
from hearthline.workload.oracle import ORACLE
from hearthline.workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        connection.sql(f"create view {file.removesuffix('.parquet')} as select * from '{SF_DIR}/{file}'")
    return connection


def by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([columns[i] for i in order], [tuple(r[i] for i in order) for r in rows])[1], key=repr)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    rows = QUERIES[name](spark, SF_DIR)
    twin = con.sql(ORACLE[name])
    assert sorted(rows.columns) == sorted(twin.columns)
    assert by_name(rows.columns, rows.collect()) == by_name(twin.columns, twin.fetchall())


def test_entry(spark):
    assert entry(spark).count() > 0


def test_part_names_are_compared_in_many_tasks(spark):
    rows = QUERIES["part_name_similarity"](spark, SF_DIR)
    assert rows.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_message_lines_are_sorted_by_many_tasks(spark, monkeypatch):
    """The lines lie in several files, whose names follow the order of arrival."""
    found = []

    def run(spark, source, *args, **kwargs):
        for name in sorted(f for f in os.listdir(source) if f.startswith("part-")):
            with open(f"{source}/{name}") as file:
                found.append(file.read().splitlines())
        raise InterruptedError

    monkeypatch.setattr(queries, "run_layers", run)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        with pytest.raises(InterruptedError):
            QUERIES["layers_end_to_end"](spark, SF_DIR)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(found) > 1
    assert [line for lines in found for line in lines] == [r.message for r in messages(spark, SF_DIR).orderBy("_pos").collect()]
