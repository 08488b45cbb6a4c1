"""Queries with a DuckDB twin."""

import pytest

from hearthline.llm.oracle import ORACLE
from hearthline.llm.queries import QUERIES
from tests.llm.conftest import SMALL


def by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", list(ORACLE))
def test_query(spark, con, name):
    rows, twin = QUERIES[name](spark, SMALL), con.sql(ORACLE[name])
    assert sorted(rows.columns) == sorted(twin.columns)
    assert by_name(rows.columns, rows.collect()) == by_name(twin.columns, twin.fetchall())


def test_the_operators_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
