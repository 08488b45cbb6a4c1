import os

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hearthline.operators.devices import FAMILIES
from hearthline.operators.summary import device_summary, summary_by_batch, summary_partials
from hearthline.plans.gold import build_gold
from hearthline.plans.incremental import DAY, load_gold, load_silver, read_days, read_summary
from hearthline.plans.layers import read_routed_silver, run_layers
from hearthline.plans.silver import SilverOptions, build_silver
from hearthline.schemas import IDENTITY, SILVER
from hearthline.session import staged
from tests.conftest import as_messages

AT = "2024-06-01T00:00:00Z"
WM, CM = "Washing machine", "Coffee Machine"


def day(d, n, kind=WM, status="Program Start", hour=10):
    return [(f"d{i}", f"2024-05-{d:02d}T{hour:02d}:00:{i:02d}", kind, status) for i in range(n)]


LOADS = [
    day(1, 5) + day(2, 4, CM) + [("x", "nope", WM, "End")],
    day(2, 6, CM) + day(3, 3) + [("d0", "2024-05-02T10:00:00", CM, "program start")],
    day(3, 3, status="Program Starts") + day(4, 2, "Fridge"),
    day(1, 2) + [("late", "2024-05-01T23:00:00", WM, "Program Failure")],
]


def bronze_loads(bronze, loads=LOADS):
    return [bronze(*rows, ingested_at=f"2024-05-{10 + i}T00:00:00Z") for i, rows in enumerate(loads)]


def keys(rows):
    return sorted(tuple(r) for r in rows.select(*IDENTITY, "_ingested_at", "_pos").collect())


def whole(parts):
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return build_silver(rows, AT).events


def test_loads_in_any_order_equal_one_run(spark, bronze, tmp_path):
    parts, out = bronze_loads(bronze), str(tmp_path)
    for i in (3, 1, 0, 2):
        load_gold(spark, out, load_silver(spark, parts[i], out, i, AT))
    silver = read_days(spark, out)
    assert keys(silver) == keys(whole(parts))
    assert sorted(silver.drop(DAY, FAMILIES).columns) == sorted(SILVER.names)
    gold = build_gold(whole(parts))
    for name in ("gold_washing_machine", "gold_unknown_devices", "gold_dishwasher"):
        stored = spark.read.parquet(f"{out}/gold/{name}") if gold[name].count() else gold[name]
        assert sorted(map(repr, stored.select(gold[name].columns).collect())) == sorted(map(repr, gold[name].collect()))
    assert sorted(map(repr, read_summary(spark, out).collect())) == sorted(map(repr, gold["gold_summary"].collect()))


def files(folder):
    return {os.path.join(p, f): os.stat(os.path.join(p, f)).st_mtime_ns for p, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_untouched_partitions_keep_their_files(spark, bronze, tmp_path):
    parts, out = bronze_loads(bronze), str(tmp_path)
    for i in (0, 1):
        load_gold(spark, out, load_silver(spark, parts[i], out, i, AT))
    before = files(tmp_path / "silver") | files(tmp_path / "gold")
    days = load_silver(spark, parts[3], out, 3, AT)
    load_gold(spark, out, days)
    after = files(tmp_path / "silver") | files(tmp_path / "gold")
    assert days == ["2024-05-01"]
    other = {f: t for f, t in before.items() if "_day=2024-05-01" not in f}
    assert len(other) > 3 and all(after.get(f) == t for f, t in other.items())
    assert not any(f in after for f in before if "_day=2024-05-01" in f)


def test_replaced_loads_leave_nothing_behind(spark, bronze, tmp_path):
    """The second attempt has other days and no washing machines: stale partitions become empty."""
    parts, out = bronze_loads(bronze), str(tmp_path)
    for i in range(3):
        load_gold(spark, out, load_silver(spark, parts[i], out, i, AT))
    again = bronze(*day(2, 3, CM, hour=7), *day(9, 1, CM), ingested_at="2024-05-10T00:00:00Z")
    days = load_silver(spark, again, out, 0, AT)
    load_gold(spark, out, days)
    assert days == ["2024-05-01", "2024-05-02", "2024-05-09"]
    expected = whole([again, *parts[1:3]])
    assert keys(read_days(spark, out)) == keys(expected)
    assert sorted(map(repr, read_summary(spark, out).collect())) == sorted(map(repr, device_summary(expected).collect()))
    washing = spark.read.parquet(f"{out}/gold/gold_washing_machine")
    assert washing.count() == build_gold(expected)["gold_washing_machine"].count()


def test_a_load_that_broke_off_is_run_again(spark, bronze, tmp_path, monkeypatch):
    from hearthline.plans import incremental

    parts, out = bronze_loads(bronze), str(tmp_path)
    load_silver(spark, parts[0], out, 0, AT)
    with monkeypatch.context() as m:
        m.setattr(incremental, "rewrite_silver", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load_silver(spark, parts[2], out, 0, AT)
    # Day 1 is in neither the stored attempt nor the new one, but was noted.
    days = load_silver(spark, parts[2], out, 0, AT)
    assert days == ["2024-05-01", "2024-05-02", "2024-05-03", "2024-05-04"]
    assert keys(read_days(spark, out)) == keys(whole([parts[2]]))


def test_duplicates_without_time_are_refused(spark, bronze, tmp_path):
    with pytest.raises(ValueError):
        load_silver(spark, bronze(*day(1, 1)), str(tmp_path), 0, AT, SilverOptions(match_timestamp=False))


def test_empty_load(spark, bronze, tmp_path):
    assert load_silver(spark, bronze(*day(1, 1)).limit(0), str(tmp_path), 0, AT) == []


def test_families_prune_partitions(spark, tmp_path, sample):
    import json

    rows = [*sample, ("both", "2024-03-08T20:20:20", "Coffee washing set", "Program End", {}), ("f", "2024-03-08T20:20:20", "Fridge", "End", {})]
    (tmp_path / "in.json").write_text(json.dumps(as_messages(rows)))
    result = run_layers(spark, str(tmp_path / "in.json"), str(tmp_path / "out"), 0)
    assert result.gold.rows_by_table["gold_washing_machine"] == 8 and result.gold.rows_by_table["gold_coffee_machine"] == 3
    silver = read_routed_silver(spark, str(tmp_path / "out"))
    assert {r[0] for r in silver.select(FAMILIES).distinct().collect()} == {"washing", "coffee", "dishwasher", "washing+coffee", "unknown"}
    for table in list(build_gold(silver, [("Heat", "Heat")]).values())[:4]:
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(_families" in plan and "Filter contains(lower" not in plan


def test_summary_after_every_batch(spark, bronze):
    parts = bronze_loads(bronze)
    events = staged(whole(parts).withColumn("load", F.dense_rank().over(Window.orderBy("_ingested_at"))), "events")
    running = summary_by_batch(summary_partials(events, ["load"]), "load").collect()
    for n in range(1, 5):
        expected = {r.DeviceId + r.DeviceType: r for r in device_summary(events.where(F.col("load") <= n)).collect()}
        latest = {}
        for r in sorted((r for r in running if r.load <= n), key=lambda r: r.load):
            latest[r.DeviceId + r.DeviceType] = r
        assert {k: tuple(r) for k, r in expected.items()} == {k: tuple(v for c, v in r.asDict().items() if c != "load") for k, r in latest.items()}
