import json

import pytest
from pyspark.sql import functions as F

from hearthline.operators.records import NOT_AN_ARRAY, NOT_JSON_FILE, dead_records, good_records, parse_records
from hearthline.plans.bronze import read_bronze, read_bronze_dead_letters, write_bronze
from hearthline.schemas import IDENTITY
from hearthline.sources.json_files import read_messages
from tests.conftest import as_messages

AT = "2024-01-01T00:00:00Z"
EVENT = {"DeviceId": "d", "TimestampUTC": "2024-01-01T00:00:00", "DeviceType": "Dishwasher", "Status": "End", "Attributes": {"b": 1, "a": [2]}}


@pytest.fixture
def write(tmp_path):
    def make(text, name="in.json"):
        path = tmp_path / name
        path.write_text(text if isinstance(text, str) else json.dumps(text), encoding="utf-8")
        return str(path)

    return make


def ingest(spark, path, **options):
    parsed = read_messages(spark, path, AT, **options)
    return good_records(parsed).orderBy("_pos").collect(), dead_records(parsed).collect()


def test_sample_file(spark, write, sample):
    good, dead = ingest(spark, write(as_messages(sample)))
    assert [(r.DeviceId, r.TimestampUTC, r.DeviceType, r.Status) for r in good] == [s[:4] for s in sample]
    assert [json.loads(r.Attributes) for r in good] == [s[4] for s in sample]
    assert dead == [] and {r._ingested_at for r in good} == {AT}
    assert [r._pos for r in good] == list(range(8)) and all(r._source_file.endswith("in.json") for r in good)


def test_elements_that_are_no_objects_become_rows(spark, write):
    good, dead = ingest(spark, write([None, 7, "x", '{"DeviceId": "no"}', [1, 2], EVENT]))
    assert [r.DeviceId for r in good] == [None] * 5 + ["d"]
    assert [r.Attributes and json.loads(r.Attributes) for r in good[:5]] == [None, 7, "x", '{"DeviceId": "no"}', [1, 2]]
    assert dead == []


def test_null_and_numeric_fields(spark, write):
    good, _ = ingest(spark, write([{"DeviceId": 123, "Status": None, "Attributes": None}, {}]))
    assert (good[0].DeviceId, good[0].Status, good[0].Attributes) == ("123", None, None)
    assert all(good[1][c] is None for c in [*IDENTITY, "Attributes"])


@pytest.mark.parametrize(
    "text, reason",
    [
        ('{"not": "an array"}', NOT_AN_ARRAY),
        ("7", NOT_AN_ARRAY),
        ("[1] trailing", NOT_JSON_FILE),
        ("[1] [2]", NOT_JSON_FILE),
        ("[1], [2]", NOT_AN_ARRAY),
        ('[{"a": 1},', NOT_JSON_FILE),
    ],
)
def test_files_that_are_no_array(spark, write, text, reason):
    path = write(text)
    with pytest.raises(Exception, match=reason):
        read_messages(spark, path, AT).collect()
    good, dead = ingest(spark, path, on_bad_file="dead_letter")
    assert good == []
    assert json.loads(dead[0]._raw_error) == {"_error": reason, "_raw": text}


def test_one_bad_file_among_good_ones(spark, write, tmp_path):
    write([EVENT], "a.json")
    write("[", "b.json")
    good, dead = ingest(spark, str(tmp_path), on_bad_file="dead_letter")
    assert len(good) == 1 and dead[0]._source_file.endswith("b.json")


def test_empty_array(spark, write):
    assert ingest(spark, write("[]")) == ([], [])


def test_repeated_object_key_keeps_the_last(spark, write):
    good, dead = ingest(spark, write('[{"DeviceId": "1", "DeviceId": "2"}, null, "text", 5]'))
    assert [r.DeviceId for r in good] == ["2", None, None, None] and dead == []
    assert [r.Attributes for r in good] == [None, None, '"text"', "5"]


def test_pretty_printed_array(spark, write):
    good, _ = ingest(spark, write(json.dumps([EVENT, EVENT], indent=2)))
    assert [r.DeviceId for r in good] == ["d", "d"]


def test_missing_file(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_messages(spark, str(tmp_path / "none.json"), AT)


def test_json_lines(spark, write):
    lines = [json.dumps({**EVENT, "DeviceId": f"d{i}"}) for i in range(500)]
    lines[100] = '{"cut": '
    lines[200] = "7"
    lines[300] = ""
    good, dead = ingest(spark, write("\n".join(lines)), layout="lines")
    assert [r.DeviceId for r in good] == [
        None if i == 200 else f"d{i}" for i in range(500) if i not in (100, 300)
    ]
    assert json.loads(dead[0]._raw_error)["_raw"] == '{"cut": '


@pytest.mark.parametrize("size", ["64k", "256k", "1m", "3m"])
def test_line_positions_follow_the_file_across_splits(spark, write, size):
    path = write("\n".join(json.dumps({**EVENT, "DeviceId": f"{i:07d}", "Attributes": "x" * (i % 500)}) for i in range(20000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        parsed = read_messages(spark, path, AT, layout="lines")
        assert parsed.rdd.getNumPartitions() > 1
        rows = parsed.orderBy("_pos").select("DeviceId", "_pos").collect()
        ids = [r.DeviceId for r in rows]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert ids == sorted(ids) and len(ids) == 20000 == len({r._pos for r in rows})


def test_elements_of_an_array_keep_their_text(spark, write):
    attributes = '{"b":1.0,"a":12345678901234567890123456789012345678901,"c":{"z":[1.25,"5"],"y":null}}'
    text = '[{"DeviceId": "d", "Attributes": ' + attributes + '}, "5", 5, "null", null, true]'
    good, dead = ingest(spark, write(text))
    assert dead == []
    assert [r.Attributes for r in good] == [attributes, '"5"', "5", '"null"', None, "true"]


def test_a_field_named_error_is_no_error(spark):
    rows = spark.createDataFrame([('{"DeviceId": "d", "_error": "x"}',)], "value string")
    row = parse_records(rows).first()
    assert row.DeviceId == "d" and row._raw_error is None


def test_trailing_text_in_a_record_is_an_error(spark):
    texts = ['{"DeviceId": "a"} x', '{"DeviceId": "a"}{"DeviceId": "b"}', '{"DeviceId": "a"}, {"DeviceId": "b"}', ""]
    rows = spark.createDataFrame([(t,) for t in texts], "value string")
    assert [json.loads(r._raw_error)["_raw"] for r in parse_records(rows).collect()] == texts


def test_a_batch_can_be_written_again(spark, write, tmp_path):
    path, table = write([EVENT, 7]), str(tmp_path / "table")
    for _ in range(2):
        write_bronze(read_messages(spark, path, AT), table, 0)
    write_bronze(read_messages(spark, write("[", "bad.json"), AT, on_bad_file="dead_letter"), table, 1)
    assert read_bronze(spark, table).count() == 2
    assert read_bronze(spark, table, 1).count() == 0
    assert read_bronze_dead_letters(spark, table).count() == read_bronze_dead_letters(spark, table, 1).count() == 1
    assert read_bronze(spark, table).where(F.col("DeviceId") == "d").first().Attributes == '{"b":1,"a":[2]}'
