import json

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hearthline.operators.records import NOT_AN_ARRAY, NOT_JSON_FILE, dead_records, good_records
from hearthline.sources import byte_ranges, json_ranges
from hearthline.sources.json_files import read_messages
from hearthline.sources.json_ranges import ESCAPED, INSIDE, OUTSIDE, Outcome, _outside

AT = "2024-01-01T00:00:00Z"


def plain(raw, state):
    """The automaton byte by byte: structural positions outside strings, the state and the depths."""
    out, depth, depths = [], 0, []
    for i, c in enumerate(raw):
        if state == ESCAPED:
            state = INSIDE
        elif state == INSIDE:
            state = ESCAPED if c == ord("\\") else OUTSIDE if c == ord('"') else INSIDE
        elif c == ord('"'):
            state = INSIDE
        elif chr(c) in "[]{},":
            out.append(i)
            if c != ord(","):
                depth += 1 if chr(c) in "[{" else -1
                depths.append(depth)
    return out, state, depths


# Outside strings JSON has no backslash, and the scan needn't care about one.
VALUES = st.recursive(st.none() | st.booleans() | st.integers() | st.text(alphabet='a"\\[]{},é\n ', max_size=8), lambda v: st.lists(v, max_size=3) | st.dictionaries(st.text(alphabet='a"\\', max_size=3), v, max_size=3), max_leaves=8)


@settings(max_examples=300, deadline=None)
@given(st.lists(VALUES, max_size=5), st.lists(st.integers(0, 300), max_size=6))
def test_scan_like_an_automaton(values, cuts):
    raw = json.dumps(values, ensure_ascii=False).encode()
    cuts = sorted({min(c, len(raw)) for c in cuts} | {0, len(raw)})
    state = OUTSIDE
    for a, b in zip(cuts, cuts[1:]):
        at, state_after = _outside(np.frombuffer(raw[a:b], np.uint8), state)
        expected = plain(raw[a:b], state)
        assert (at.tolist(), state_after) == expected[:2]
        outcome = Outcome(state)
        outcome.read(np.frombuffer(raw[a:b], np.uint8))
        depths = expected[2]
        assert outcome.delta == (depths[-1] if depths else 0)
        assert outcome.low == (min(depths[:-1]) if len(depths) > 1 else json_ranges._NONE)
        state = state_after


def write(tmp_path, text, name="in.json"):
    path = tmp_path / name
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


ELEMENTS = [{"DeviceId": "a,\"]\\", "Attributes": [1, {"x": "}{"}]}, 7, None, "text, [\"]", [], {}, {"DeviceId": "é" * 40, "Status": "\\"}, "", {"Attributes": "\\\\\""}, [[[[]]]]]


@pytest.mark.parametrize("range_bytes", [1, 2, 3, 7, 64, 10_000])
@pytest.mark.parametrize("indent", [None, 1])
def test_any_size_of_ranges(spark, tmp_path, monkeypatch, range_bytes, indent):
    monkeypatch.setattr(byte_ranges, "MOST_TASKS", 5)
    text = json.dumps(ELEMENTS, ensure_ascii=False, indent=indent)
    path = write(tmp_path, text)
    rows = json_ranges.array_range_records(spark, path, AT, range_bytes).collect()
    rows.sort(key=lambda r: r._pos)
    assert [json.loads(r.value) for r in rows] == ELEMENTS
    raw = text.encode()
    assert all(raw[r._pos :].startswith(r.value.encode()) for r in rows)
    assert {(r._source_file, r._ingested_at, r._file_error) for r in rows} == {(f"file:{path}", AT, None)}


@pytest.mark.parametrize("step", [1, 2, 5, 1 << 20])
def test_any_size_of_steps(tmp_path, monkeypatch, step):
    monkeypatch.setattr(byte_ranges, "STEP", step)
    raw = json.dumps(ELEMENTS).encode()
    path = write(tmp_path, raw)
    with byte_ranges.open_file(f"file://{path}") as file:
        found = list(json_ranges._elements(file, len(raw), 0, len(raw), OUTSIDE, 0))
    assert [json.loads(t) for _, t in found] == ELEMENTS


def test_like_the_whole_file_reader(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(byte_ranges, "MOST_TASKS", 7)
    for i in range(3):
        write(tmp_path, json.dumps([{"DeviceId": f"d{i}-{j}", "Attributes": {"n": "x" * (j % 50), "l": [j]}} for j in range(400)]), f"f{i}.json")
    columns = ["DeviceId", "TimestampUTC", "Attributes", "_ingested_at", "_source_file"]

    def read(**options):
        return good_records(read_messages(spark, str(tmp_path), AT, **options)).orderBy("_source_file", "_pos").select(columns).collect()

    assert read() == read(range_bytes=1000) == read(range_bytes=1 << 20)


@pytest.mark.parametrize(
    "text, reason",
    [
        ('{"not": "an array"}', NOT_AN_ARRAY),
        ("7", NOT_AN_ARRAY),
        (" \n ", NOT_JSON_FILE),
        ("[1] trailing", NOT_JSON_FILE),
        ("[1] [2]", NOT_JSON_FILE),
        ("[1]]", NOT_JSON_FILE),
        ('[{"a": 1},', NOT_JSON_FILE),
        ('["open', NOT_JSON_FILE),
    ],
)
@pytest.mark.parametrize("range_bytes", [3, 100])
def test_files_that_are_no_array(spark, tmp_path, monkeypatch, text, reason, range_bytes):
    monkeypatch.setattr(byte_ranges, "MOST_TASKS", 3)
    path = write(tmp_path, text)
    with pytest.raises(Exception, match=reason):
        read_messages(spark, path, AT, range_bytes=range_bytes).collect()
    parsed = read_messages(spark, path, AT, range_bytes=range_bytes, on_bad_file="dead_letter")
    assert good_records(parsed).collect() == []
    assert [json.loads(r._raw_error)["_error"] for r in dead_records(parsed).collect()] == [reason]


def test_bad_elements_are_dead_letters_of_their_own(spark, tmp_path):
    path = write(tmp_path, '[{"DeviceId": "a"}, {"DeviceId": }, 3, ]')
    parsed = read_messages(spark, path, AT, range_bytes=10)
    assert [(r.DeviceId, r.Attributes) for r in good_records(parsed).orderBy("_pos").collect()] == [("a", None), (None, "3")]
    assert sorted(json.loads(r._raw_error)["_raw"] for r in dead_records(parsed).collect()) == ["", '{"DeviceId": }']


def test_empty_arrays_and_long_elements(spark, tmp_path):
    write(tmp_path, " [ \n ] ", "a.json")
    write(tmp_path, json.dumps([{"DeviceId": "x" * 5000}, {"DeviceId": "y"}]), "b.json")
    rows = good_records(read_messages(spark, str(tmp_path), AT, range_bytes=100)).orderBy("_pos").collect()
    assert [r.DeviceId for r in rows] == ["x" * 5000, "y"]


def test_one_file_is_work_for_many_tasks(spark, tmp_path):
    path = write(tmp_path, json.dumps([{"DeviceId": str(i)} for i in range(2000)]))
    rows = json_ranges.array_range_records(spark, path, AT, 1000)
    from pyspark.sql import functions as F

    tasks = rows.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    assert len(tasks) > 20 and sum(r["count"] for r in tasks) == 2000


@pytest.mark.parametrize("split_bytes, partitions", [(8192, 5), (4096, 3), (4096, None), (1 << 20, None), (1000, 1)])
def test_line_positions_at_any_reader_setting(spark, tmp_path, split_bytes, partitions):
    lines = [json.dumps({"DeviceId": f"{i}"}) + "\n" * (1 + i % 3) for i in range(5000)]
    for name in ("a", "b"):
        write(tmp_path, "".join(lines), name)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    if partitions:
        spark.conf.set("spark.sql.files.maxPartitionNum", partitions)
    try:
        rows = read_messages(spark, str(tmp_path), AT, layout="lines").select("_source_file", "_pos", "DeviceId").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.maxPartitionNum")
    assert len({(r._source_file, r._pos) for r in rows}) == len(rows) == 10_000
    for name in ("a", "b"):
        assert [r.DeviceId for r in sorted((r for r in rows if r._source_file.endswith(name)), key=lambda r: r._pos)] == [str(i) for i in range(5000)]


def test_small_ranges_share_tasks(spark, tmp_path):
    """Every task costs a start: there are as many as cores and bytes call for, not as many as ranges."""
    path = write(tmp_path, json.dumps([{"DeviceId": str(i)} for i in range(2000)]))
    files = byte_ranges.files_of(spark, path)
    assert byte_ranges.tasks_for(files, 10) == byte_ranges.FEWEST_TASKS
    assert byte_ranges.tasks_for(files, 1 << 20) == 1


def test_little_is_read_behind_a_range(tmp_path, monkeypatch):
    path = write(tmp_path, json.dumps(["x" * 20] * 100_000))
    seen = []
    structure = json_ranges._outside
    monkeypatch.setattr(json_ranges, "_outside", lambda raw, state: seen.append(len(raw)) or structure(raw, state))
    with byte_ranges.open_file(f"file://{path}") as file:
        size = file.size()
        found = list(json_ranges._elements(file, size, 0, 1000, OUTSIDE, 0))
    assert [t for _, t in found] == [b'"' + b"x" * 20 + b'"'] * len(found) and len(found) > 40
    assert sum(seen) <= 1000 + byte_ranges.FIRST_BEYOND
