import os

import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"

#: Names that operators use for columns of their own.
CLASHING = ["n", "h", "cls", "s", "size", "start", "kept", "n_words", "component_id", "score", "part", "bucket", "token", "label", "block", "epoch", "spans"]
ODD = "doc_id long, text string, lang string, source string, n_chars long"


def odd_rows():
    """Documents at the edges: nulls, blanks, repeats, one long text, ids that repeat, foreign letters."""
    prose = " ".join(f"Wort{i % 37} und étude {i}" for i in range(60))
    return [
        (1, None, "en", "a", 0),
        (2, "", "en", "a", 0),
        (3, " \t\n\x0b \x0c\r ", None, None, None),
        (4, "one two three", "en", "", 13),
        (5, "ONE two THREE", "en", "", 13),
        (6, prose, "de", "b", len(prose)),
        (6, prose, "de", "b", len(prose)),
        (7, prose + " end.", "de", "b", 0),
        (8, "mail x.y@mail.example.org, 10.0.0.1, +1 (555) 123-4567, 4111 1111 1111 1111\n" + prose, "en", "c", 1),
        (9, "a" * 5000, "en", "c", 5000),
        (10, "中文 字   é \U0001f642 <|endoftext|> x" * 5, "zh", "c", 1),
        (None, "no id " * 30, "en", "d", 1),
        (None, None, None, None, None),
        (11, " ".join(f"w{i}" for i in range(30_000)), "en", "d", 1),
        (6, "the same id, another text", "en", "b", 1),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd documents with further columns whose names clash with those of the operators."""
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(odd_rows(), ODD)
    return rows.withColumns({c: F.lit("clash") for c in CLASHING})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], ODD)


@pytest.fixture(scope="session")
def small(spark):
    if not os.path.isdir(SMALL):
        pytest.skip("test tables not present")

    def read(name):
        return spark.read.parquet(f"{SMALL}/{name}.parquet")

    return read


@pytest.fixture(scope="session")
def con():
    if not os.path.isdir(SMALL):
        pytest.skip("test tables not present")
    connection = duckdb.connect()
    for file in os.listdir(SMALL):
        connection.sql(f"create view {file.removesuffix('.parquet')} as select * from '{SMALL}/{file}'")
    return connection
