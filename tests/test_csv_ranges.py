import csv
import io

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hearthline.sources import byte_ranges
from hearthline.sources.csv_files import read_csv, write_csv
from hearthline.sources.csv_ranges import _records, csv_records

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("a", "b", "c")])
CELLS = st.text(alphabet='x",\n\r é', max_size=6)


@pytest.fixture(scope="module")
def shared_file(tmp_path_factory):
    return tmp_path_factory.mktemp("csv") / "t.csv"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(CELLS, CELLS), min_size=1, max_size=6), st.integers(1, 40))
def test_records_at_any_size_of_ranges(shared_file, rows, size):
    """Every record once, from the range it begins in, whatever lies at the borders."""
    text = io.StringIO(newline="")
    csv.writer(text, lineterminator="\n", quoting=csv.QUOTE_ALL).writerows(rows)
    raw = text.getvalue().encode()
    shared_file.write_bytes(raw)
    found = []
    with byte_ranges.open_file(f"file://{shared_file}") as file:
        for start in range(0, len(raw), size):
            inside = raw[: max(0, start - 1)].count(b'"') % 2 == 1
            found += list(_records(file, len(raw), start, min(len(raw), start + size), inside))
    assert [p for p, _ in found] == sorted({p for p, _ in found})
    back = [next(csv.reader(io.StringIO(t.decode(), newline=""))) for _, t in found]
    assert [tuple(r) for r in back] == rows


ROWS = [("x", 'say "hi"', "line\nbreak"), ("1,2", None, "\n\n"), ('"', "é\r\nü", "back\\slash"), ("", "a", " b ")] * 30


@pytest.mark.parametrize("range_bytes", [7, 100, 1 << 20])
def test_like_the_whole_file_reader(spark, tmp_path, monkeypatch, range_bytes):
    monkeypatch.setattr(byte_ranges, "MOST_TASKS", 6)
    write_csv(spark.createDataFrame(ROWS, SCHEMA).coalesce(2), str(tmp_path / "t"))
    key = lambda r: repr(tuple(r))
    whole = sorted(read_csv(spark, str(tmp_path / "t"), SCHEMA).collect(), key=key)
    assert len(whole) == len(ROWS)
    assert sorted(read_csv(spark, str(tmp_path / "t"), SCHEMA, range_bytes).collect(), key=key) == whole


def test_wrong_header(spark, tmp_path):
    write_csv(spark.createDataFrame(ROWS, SCHEMA), str(tmp_path / "t"))
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(tmp_path / "t"), T.StructType(list(reversed(SCHEMA.fields))), 50).collect()
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(tmp_path / "t"), T.StructType([*SCHEMA.fields, T.StructField("d", T.StringType())]), 50).collect()


def test_one_file_is_work_for_many_tasks(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b,c\n" + "".join(f'{i},"x\n{i}",z\n' for i in range(1000)))
    tasks = csv_records(spark, str(tmp_path / "t.csv"), 500).groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 10 and sum(r["count"] for r in tasks) == 1001


def test_header_only(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b,c\n\n")
    assert read_csv(spark, str(tmp_path / "t.csv"), SCHEMA, 3).collect() == []


def test_little_is_read_behind_a_range(tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b,c\n" + '1,"x\ny",z\n' * 100_000)
    read = []

    class Counting:
        def read_at(self, length, offset):
            read.append(length)
            return file.read_at(length, offset)

    with byte_ranges.open_file(f"file://{path}") as file:
        found = list(_records(Counting(), file.size(), 0, 1000, False))
    assert len(found) > 80 and {text for pos, text in found if pos} == {b'1,"x\ny",z'}
    assert sum(read) <= 1000 + byte_ranges.FIRST_BEYOND
