import json

import pytest
from pyspark.sql import functions as F

from hearthline.operators.ordering import clustered, concatenated, sample_rows, silver_order, with_id_prefix, without_id_prefix
from hearthline.plans.layers import read_silver, read_silver_dead_letters, run_layers
from hearthline.plans.layout import compact, register, register_failure_view
from hearthline.operators.quality import QualityBreach
from hearthline.operators.summary import device_summary
from hearthline.plans.bronze import read_bronze, read_bronze_dead_letters
from hearthline.schemas import BRONZE, SILVER
from hearthline.session import shared_dir
from hearthline.sources import tables
from hearthline.sources.csv_files import read_csv, write_csv
from hearthline.streaming.dedup import read_stream_dead_letters, read_stream_silver, silver_stream, stream_to_silver
from hearthline.streaming.ingest import message_stream, stream_to_bronze
from tests.conftest import as_messages

T0 = "2024-01-01T00:00:00Z"
WM = "Washing machine"


def batch_rows(bronze):
    rows = bronze(*[(f"{'syn' if i % 2 else 'dev'}_{i}", T0, WM, "Start") for i in range(9)])
    return rows.withColumn("_batch_id", F.floor(F.col("_pos") / 3))


def test_batches(spark, bronze, tmp_path):
    path, rows = str(tmp_path / "t"), batch_rows(bronze)
    tables.write_batches(rows, path)
    tables.write_batches(rows.where("_batch_id = 1"), path)
    tables.write_batch(rows.where("_batch_id = 2").drop("_batch_id"), path, 2)
    table = tables.read_table(spark, path)
    assert [r._batch_id for r in tables.list_batches(table).collect()] == [0, 1, 2]
    assert [tuple(r) for r in tables.replay_counts(table).orderBy("_batch_id").collect()] == [(0, 3, 3), (1, 3, 6), (2, 3, 9)]
    assert tables.as_of_batch(table, 1).count() == 6
    plain, prefixed = tables.replay_samples(table, 1)
    assert plain.count() == prefixed.count() == 2
    plan = tables.as_of_batch(table, 1)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_batch_id" in plan


def test_previews_of_many_states(spark, bronze, tmp_path):
    """One read for all states gives the sizes that one call per state gives, of rows that the state has."""
    path = str(tmp_path / "t")
    tables.write_batches(batch_rows(bronze).where("_pos <> 1 and _pos <> 3"), path)
    table = tables.read_table(spark, path)
    states = spark.range(-1, 4).withColumnRenamed("id", "_batch_id")
    for n in (1, 2, 3, 50):
        many = tables.replay_samples(table, states, n=n)
        for batch in range(-1, 4):
            for one, rows in zip(tables.replay_samples(table, batch, n=n), many):
                shown = rows.where(F.col("_state") == batch).collect()
                assert len(shown) == len({r._pos for r in shown}) == one.count()
                assert {r._pos for r in shown} <= {r._pos for r in tables.replay_samples(table, batch, n=50)[rows is many[1]].collect()}


def test_empty_and_optional_tables(spark, bronze, tmp_path):
    tables.create_table(spark, str(tmp_path / "e"), BRONZE)
    assert tables.read_table(spark, str(tmp_path / "e"), BRONZE).count() == 0
    rows = bronze(("a", T0, WM, "End"))
    assert tables.write_if_any(rows, str(tmp_path / "n"))
    assert not tables.write_if_any(rows.limit(0), str(tmp_path / "n"))
    assert tables.read_table(spark, str(tmp_path / "n"), BRONZE).count() == 0


def test_csv_keeps_awkward_text(spark, bronze, tmp_path):
    texts = ['{"a": "x, \\"y\\""}', "line\nbreak", 'say "hi"', "back\\slash", "comma,", None]
    rows = bronze(*[(f"d{i}", T0, WM, "End", t) for i, t in enumerate(texts)])
    write_csv(rows, str(tmp_path / "csv"))
    back = read_csv(spark, str(tmp_path / "csv"), BRONZE).orderBy("DeviceId").collect()
    assert [r.Attributes for r in back] == texts
    assert back[0]._pos == "0"


def test_csv_checks_the_header(spark, bronze, tmp_path):
    write_csv(bronze(("a", T0, WM, "End")).select("Status", "DeviceId"), str(tmp_path / "csv"))
    with pytest.raises(Exception):
        read_csv(spark, str(tmp_path / "csv"), BRONZE.__class__([BRONZE["DeviceId"], BRONZE["Status"]])).collect()


def test_order_sample_and_split(bronze):
    rows = bronze(("syn_b", T0, WM, "End"), ("a", "2024-01-02T00:00:00Z", WM, "End"), ("a", T0, WM, "End"))
    assert [(r.DeviceId, r.TimestampUTC[8:10]) for r in silver_order(rows).collect()] == [
        ("a", "01"), ("a", "02"), ("syn_b", "01")
    ]
    many = bronze(*[(f"d{i}", T0, WM, "End") for i in range(50)])
    first = {r.DeviceId for r in sample_rows(many, 5, seed=1).collect()}
    assert first == {r.DeviceId for r in sample_rows(many.repartition(7), 5, seed=1).collect()} and len(first) == 5
    assert first != {r.DeviceId for r in sample_rows(many, 5, seed=2).collect()}
    assert with_id_prefix(rows).count() == 1 and without_id_prefix(rows).count() == 2
    assert concatenated([rows, many, rows]).count() == 56


def test_compaction_and_catalog(spark, bronze, tmp_path):
    rows = bronze(*[(f"d{i % 7}", f"2024-01-01T00:00:{i:02d}Z", WM, "Failure") for i in range(50)])
    path = str(tmp_path / "c")
    compact(rows.repartition(20), path, files=3)
    assert len(list((tmp_path / "c").glob("*.parquet"))) <= 3
    assert sorted(tables.read_table(spark, path).collect()) == sorted(rows.collect())
    assert clustered(rows).count() == 50
    spark.sql("drop table if exists events_by_name")
    register(spark, "events_by_name", path)
    register(spark, "events_by_name", path)
    assert spark.table("events_by_name").count() == 50
    register_failure_view(device_summary(rows))
    assert spark.sql("select count(*) as n from devices_with_failures").first().n == 7
    spark.sql("drop table events_by_name")


@pytest.fixture
def message_file(tmp_path, sample):
    folder = tmp_path / "in"
    folder.mkdir()

    def write(rows, name="a.json"):
        (folder / name).write_text(json.dumps(as_messages(rows)), encoding="utf-8")
        return str(folder)

    return write


def test_layers_end_to_end(spark, message_file, sample, tmp_path):
    out = str(tmp_path / "out")
    folder = message_file(sample)
    for _ in range(2):
        result = run_layers(spark, folder, out, batch_id=0)
        assert (result.bronze.rows_written, result.bronze.dead_letter_count) == (8, 0)
        assert (result.silver.rows_in, result.silver.rows_out, result.alerts) == (8, 8, [])
        assert result.gold.rows_by_table == {
            "gold_washing_machine": 7, "gold_coffee_machine": 2, "gold_dishwasher": 1, "gold_unknown_devices": 0,
            "gold_summary": 6,
        }
        assert result.gold.unknown_types == 0
    assert spark.read.parquet(f"{out}/quality_log").count() == 4
    assert read_silver(spark, out).columns == [f.name for f in SILVER.fields]


def test_layers_with_rejects_duplicates_and_a_second_batch(spark, message_file, sample, tmp_path):
    out = str(tmp_path / "out")
    message_file([*sample, sample[0], ("x", "nope", WM, "End", {}), ("y", T0, "Fridge", "End", {})])
    (tmp_path / "in" / "b.json").write_text("{", encoding="utf-8")
    first = run_layers(spark, str(tmp_path / "in"), out, 0, on_bad_file="dead_letter", gold_format="csv")
    assert (first.bronze.rows_written, first.bronze.dead_letter_count) == (11, 1)
    assert (first.silver.rows_out, first.silver.dropped_invalid, first.silver.dropped_duplicate) == (9, 1, 1)
    types = spark.read.parquet(first.gold.unknown_types_path).collect()
    assert [tuple(r) for r in types] == [("Fridge", 1)] and first.gold.rows_by_table["gold_unknown_devices"] == 1
    assert len(first.alerts) == 1
    assert [r.DeviceId for r in read_silver_dead_letters(spark, out).collect()] == ["x"]
    second = run_layers(spark, str(tmp_path / "in" / "a.json"), out, batch_id=1)
    assert (second.silver.rows_in, second.silver.rows_out) == (22, 9)
    with pytest.raises(QualityBreach):
        run_layers(spark, str(tmp_path / "in" / "a.json"), out, batch_id=1, on_breach="fail")


def test_layers_on_an_empty_array(spark, message_file, tmp_path):
    result = run_layers(spark, message_file([]), str(tmp_path / "out"), 0)
    assert (result.bronze.rows_written, result.silver.rows_out) == (0, 0)
    assert set(result.gold.rows_by_table.values()) == {0}


def test_layers_refuse_a_bad_file(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"not": "an array"}')
    with pytest.raises(ValueError, match="no JSON array"):
        run_layers(spark, str(tmp_path / "x.json"), str(tmp_path / "out"), 0)
    assert not list((tmp_path / "out").rglob("*.parquet"))


def test_streaming_bronze_equals_batch(spark, message_file, sample, tmp_path):
    out, checkpoint = str(tmp_path / "bronze"), str(tmp_path / "cp")
    folder = message_file(sample[:5], "a.json")
    (tmp_path / "in" / "bad.json").write_text("[1] x")
    run = lambda: stream_to_bronze(message_stream(spark, folder, T0, max_files=1), out, checkpoint, first_batch=100).awaitTermination()
    run()
    message_file(sample[5:], "b.json")
    run()
    run()
    got = read_bronze(spark, out)
    assert sorted((r.DeviceId, r.TimestampUTC, r.Status) for r in got.collect()) == sorted(
        (s[0], s[1], s[3]) for s in sample
    )
    assert got.select("_batch_id").distinct().count() == 2
    assert read_bronze_dead_letters(spark, out).count() == 1


def test_streaming_silver_drops_copies(spark, bronze, tmp_path):
    rows = [(f"d{i}", f"2024-01-01T00:00:{i:02d}", WM, "End") for i in range(20)]
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in (rows[:12], rows[8:], [("z", "nope", WM, "End")]):
        tables.append_rows(bronze(*part), path)
    stream = silver_stream(spark.readStream.schema(BRONZE).option("maxFilesPerTrigger", 1).parquet(path), "now")
    stream.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", str(tmp_path / "cp")
    ).trigger(availableNow=True).start().awaitTermination()
    got = tables.read_table(spark, out).collect()
    assert sorted(r.DeviceId for r in got) == sorted(r[0] for r in rows)
    assert got[0]._silver_processed_at == "now" and got[0].TimestampUTC.endswith("Z")


def test_stream_to_silver_keeps_late_and_rejected_rows(spark, bronze, tmp_path):
    """Three arrivals, one after another: copies of earlier events, an old event, a rejected row."""
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    late = ("d0", "2019-01-01T00:00:00", WM, "End")
    rows = [(f"d{i}", f"2024-01-01T00:00:{i:02d}", WM, "End") for i in range(20)]
    run = lambda: stream_to_silver(
        spark.readStream.schema(BRONZE).parquet(path), out, str(tmp_path / "cp"), "now", first_batch=7
    ).awaitTermination()
    for part in (rows[:12], [*rows[8:], rows[19]], [late, ("z", "nope", WM, "End"), rows[0]]):
        tables.append_rows(bronze(*part), path)
        run()
    got = read_stream_silver(spark, out).collect()
    assert sorted(r.TimestampUTC for r in got) == sorted(r[1] + "Z" for r in [*rows, late])
    assert sorted({r._batch_id for r in got}) == [7, 8, 9]
    (dead,) = read_stream_dead_letters(spark, out).collect()
    assert (dead.DeviceId, dead._rejection_reason) == ("z", "unparseable_timestamp")


def test_lines_stream_like_a_batch(spark, tmp_path, sample):
    (tmp_path / "in").mkdir()
    lines = [json.dumps(m) for m in as_messages(sample)] + ["", "{"]
    (tmp_path / "in" / "a.json").write_text("\n".join(lines))
    out = str(tmp_path / "bronze")
    stream = message_stream(spark, str(tmp_path / "in"), T0, layout="lines")
    stream_to_bronze(stream, out, str(tmp_path / "cp"), first_batch=5).awaitTermination()
    assert sorted((r.DeviceId, r._pos) for r in read_bronze(spark, out).collect()) == sorted((s[0], i) for i, s in enumerate(sample))
    assert read_bronze_dead_letters(spark, out).count() == 1


def test_two_daily_loads_keep_both_days(spark, message_file, sample, tmp_path):
    out = str(tmp_path / "out")
    run_layers(spark, message_file(sample[:4], "a.json") + "/a.json", out, batch_id=20240501)
    second = run_layers(spark, message_file(sample[4:], "b.json") + "/b.json", out, batch_id=20240502)
    assert second.silver.rows_out == 8
    with pytest.raises(TypeError):
        run_layers(spark, message_file(sample), out)


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
