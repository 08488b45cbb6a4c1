import json

import pytest
from pyspark.sql import functions as F

from hearthline.operators.coffee import (
    attribute_rows,
    coffee_machine_table,
    columns_for,
    discover_columns,
    new_attribute_ids,
)
from hearthline.operators.devices import (
    dishwasher_table,
    unknown_device_table,
    unknown_types,
    washing_machine_table,
)
from hearthline.operators.quality import QualityBreach, enforce, quality_alerts, rule_violations, unrouted_events
from hearthline.operators.summary import device_summary, device_summary_by_join, devices_with_failures, ordered_summary
from hearthline.plans.gold import DEVICE_TABLES, build_gold
from hearthline.plans.silver import build_silver

T0 = "2024-01-01T00:00:00Z"
WM, CM, DW = "Washing machine", "Coffee Machine", "Dishwasher"


def washing(bronze, *attributes, **options):
    rows = bronze(*[(f"d{i}", T0, WM, "Running", a) for i, a in enumerate(attributes)])
    return washing_machine_table(rows, **options).orderBy("DeviceId").collect()


def test_sample_gold_tables(bronze, sample):
    gold = build_gold(build_silver(bronze(*sample), "now").events)
    wm = gold["gold_washing_machine"].orderBy("TimestampUTC", "FailureId").collect()
    assert [(r.Temperature_C, r.SpinningSpeed, r.TwinDos_Colour, r.TwinDos_White, r.FailureId) for r in wm] == [
        (45.0, 750, 80, 64, None),
        (45.0, 750, 80, 60, None),
        (50.0, 1250, None, None, None),
        (None, None, None, None, 3),
        (None, None, None, None, 8),
        (None, None, None, None, 21),
        (None, None, None, None, 8),
    ]
    cm = gold["gold_coffee_machine"].orderBy("DeviceId").collect()
    assert gold["gold_coffee_machine"].columns[4:8] == [
        "Heat_Value", "Heat_Unit", "Strength_Value", "Strength_Unit"
    ]
    assert [tuple(r)[4:8] for r in cm] == [(91.0, "Celsius", 70.0, "Percentage"), (91.0, "Celsius", None, None)]
    (dw,) = gold["gold_dishwasher"].collect()
    assert (dw.Temperature_C, dw.QuickPowerWashActive, dw.FailureId) == (55.0, True, None)
    assert gold["gold_unknown_devices"].count() == 0
    summary = {r.DeviceId: (r.total_events, r.failure_events, r.failure_rate_pct, r.days_active)
               for r in gold["gold_summary"].collect()}
    assert summary == {
        "wash-c": (1, 1, 100.0, 0),
        "wash-a": (2, 0, 0.0, 0),
        "wash-b": (2, 1, 50.0, 0),
        "dish-a": (1, 0, 0.0, 0),
        "brew-b": (1, 0, 0.0, 0),
        "brew-a": (1, 0, 0.0, 0),
    }


@pytest.mark.parametrize(
    "temperature, unit, expected",
    [(140, "f", 60.0), (104, "FAHRENHEIT", 40.0), (50, None, 50.0), (50.126, "Celsius", 50.126), (100, "Fahrenheit", 37.78),
     ("60", "Celsius", 60.0), ("abc", "Celsius", None), (50, "Kelvin", 50.0)],
)
def test_temperatures(bronze, temperature, unit, expected):
    attributes = {"Temperature": temperature} | ({"Temperature_Unit": unit} if unit else {})
    (row,) = washing(bronze, attributes, with_temperature_unit=True)
    assert row.Temperature_C == expected
    assert row.Temperature_Unit == (None if expected is None else "Celsius")


def test_dishwasher_rounds_every_temperature(bronze):
    rows = bronze(("a", T0, DW, "End", {"Temperature": 50.126, "Temperature_Unit": "Celsius"}))
    assert dishwasher_table(rows).first().Temperature_C == 50.13


def test_odd_washing_attributes(bronze):
    rows = washing(
        bronze, {"TwinDos": [90]}, {"TwinDos": "no list"}, "{bad", None, [1, 2], {"SpinningSpeed": "900.0"}, {"TwinDos": []}
    )
    assert len(rows) == 7
    assert (rows[0].TwinDos_Colour, rows[0].TwinDos_White) == (90, None)
    assert [r.TwinDos_Colour for r in rows[1:]] == [None] * 6
    assert rows[5].SpinningSpeed == 900


def test_failure_ids(bronze):
    rows = washing(bronze, {"FailureIds": [1, "x", "7"]}, {"FailureIds": []}, {}, {"FailureIds": 5})
    assert [(r.DeviceId, r.FailureId) for r in rows] == [
        ("d0", 1), ("d0", None), ("d0", 7), ("d1", None), ("d2", None), ("d3", None)
    ]


def test_wash_bit(bronze):
    bits = [{"QuickPowerWashActive": 1}, {"QuickPowerWashActive": 0}, {}, {"QuickPowerWashActive": "1"}, {"QuickPowerWashActive": "?"}]
    rows = dishwasher_table(bronze(*[(f"d{i}", T0, DW, "End", b) for i, b in enumerate(bits)])).orderBy("DeviceId")
    assert [r.QuickPowerWashActive for r in rows.collect()] == [True, False, None, True, None]


def coffee(bronze, *attributes, **options):
    rows = bronze(*[(f"d{i}", T0, CM, "End", a) for i, a in enumerate(attributes)])
    return coffee_machine_table(rows, **options).orderBy("DeviceId").collect()


def attribute(name, value=1, unit="u"):
    return {"Id": name, "Value": value, "Unit": unit}


def test_coffee_entries_are_found_by_id(bronze):
    rows = coffee(bronze, [attribute("B", 2), attribute("A", 1)], [attribute(" A ", "3.5")], [attribute("B", "bad")])
    assert [(r.A_Value, r.B_Value) for r in rows] == [(1.0, 2.0), (3.5, None), (None, None)]


def test_coffee_shapes(bronze):
    rows = coffee(bronze, attribute("Temperature", 86), [attribute("Temperature", 80), 7, "x", None], "{bad", None, [])
    assert [r.Temperature_Value for r in rows] == [86.0, 80.0, None, None, None]


def test_coffee_repeated_id(bronze):
    twice = [attribute("A", 1), attribute("A", 2)]
    assert coffee(bronze, twice)[0].A_Value == 1.0
    assert coffee(bronze, twice, on_duplicate="last")[0].A_Value == 2.0


def test_coffee_column_names():
    assert columns_for(["Cup-Size", "DeviceId", "A_B", "A-B", "a b"]) == [("A-B", "A_B"), ("Cup-Size", "Cup_Size")]


def test_coffee_without_rows_and_fixed_columns(bronze):
    assert coffee_machine_table(bronze(("a", T0, WM, "End"))).columns[:5] == [
        "DeviceId", "TimestampUTC", "DeviceType", "Status", "_ingested_at"
    ]
    table = coffee_machine_table(bronze(("a", T0, CM, "End", [attribute("B")])), [("A", "A")])
    assert "A_Value" in table.columns and table.first().A_Value is None


def test_every_id_becomes_a_column(bronze):
    rows = bronze(("a", T0, CM, "End", [attribute(f"i{i}") for i in range(4)]))
    assert len(discover_columns(rows)) == 4


def test_quotes_in_an_id(bronze):
    assert tuple(coffee(bronze, [attribute("O'Brien \\ x", 4)])[0])[4] == 4.0


def test_attribute_rows_and_drift(spark, bronze):
    rows = bronze(("a", T0, CM, "End", [attribute("A"), attribute("B", None, None)]), ("b", T0, CM, "End", []))
    long = attribute_rows(rows).orderBy("DeviceId", "Id").collect()
    assert [(r.DeviceId, r.Id, r.Value) for r in long] == [("a", "A", 1.0), ("a", "B", None), ("b", None, None)]
    known = spark.createDataFrame([("A",)], "Id string")
    assert [r.Id for r in new_attribute_ids(rows, known).collect()] == ["B"]


def test_unknown_types_keep_everything(bronze):
    rows = bronze(("a", T0, "Refrigerator", "End", {"x": 1}), ("b", T0, "DISHWASHER pro", "End"), ("c", T0, "my washing thing", "End"))
    (row,) = unknown_device_table(rows).collect()
    assert json.loads(row.Attributes) == {"x": 1}
    assert [r.DeviceType for r in unknown_types(rows).collect()] == ["Refrigerator"]
    assert device_summary(rows).count() == 3
    assert dishwasher_table(rows).count() == washing_machine_table(rows).count() == 1


def test_a_type_with_two_families_goes_to_both(bronze):
    rows = bronze(("a", T0, "Dishwasher with coffee", "End", [attribute("A")]))
    assert dishwasher_table(rows).count() == coffee_machine_table(rows).count() == 1


def test_summary(bronze):
    rows = bronze(
        ("a", "2024-01-01T23:00:00Z", WM, "Program FAILURE"),
        ("a", "2024-01-02T01:00:00Z", WM, "End"),
        ("a", "2024-01-02T02:00:00Z", WM, "End"),
        ("b", T0, CM, "End"),
        *[("c", T0, CM, "failure" if i == 0 else "End") for i in range(32)],
    )
    table = {r.DeviceId: r for r in device_summary(rows).collect()}
    assert (table["a"].failure_rate_pct, table["a"].days_active) == (33.33, 1)
    assert table["c"].failure_rate_pct == 3.13
    assert device_summary(rows, elapsed=True).where("DeviceId = 'a'").first().days_active == 0
    assert sorted(device_summary_by_join(rows).collect()) == sorted(device_summary(rows).collect())
    assert [r.DeviceId for r in ordered_summary(device_summary(rows)).collect()] == ["c", "b", "a"]
    assert {r.DeviceId for r in devices_with_failures(device_summary(rows)).collect()} == {"a", "c"}


def test_routing_is_lossless(bronze, sample):
    silver = build_silver(bronze(*sample, ("x", T0, "Refrigerator", "End")), "now").events
    gold = build_gold(silver)
    tables = {name: gold[name] for name in DEVICE_TABLES}
    assert unrouted_events(silver, tables).count() == 0
    del tables["gold_unknown_devices"]
    assert [r.DeviceId for r in unrouted_events(silver, tables).collect()] == ["x"]


def test_alerts_need_more_than_the_threshold(spark):
    def metrics(invalid, dropped):
        return spark.createDataFrame([(invalid, dropped)], "invalid_pct double, post_dedup_pct double")

    assert enforce(quality_alerts(metrics(5.0, 20.0)), "fail") == []
    assert enforce(quality_alerts(metrics(5.1, 20.0))) == ["share of rejected rows 5.1% exceeds threshold 5.0%"]
    with pytest.raises(QualityBreach, match="share of dropped copies 20.5%"):
        enforce(quality_alerts(metrics(0.0, 20.5)), "fail")


def test_rules(spark):
    rows = spark.createDataFrame([(1,), (5,), (None,)], "x int")
    got = rule_violations(rows, {"small": F.col("x") < 3, "any": F.col("x") > 0}).collect()
    assert [tuple(r) for r in got] == [("small", 2, 1), ("any", 2, 0)]
