import pytest
from pyspark.sql import functions as F

from hearthline.functions.timestamps import canonical_utc
from hearthline.operators.dedup import duplicate_keys, exact_dedup, restrict_to_keys, upsert
from hearthline.operators.validate import valid_events, with_rejection_reason
from hearthline.plans.silver import SilverOptions, build_silver
from hearthline.schemas import IDENTITY

WM = "Washing machine"
T0 = "2023-06-15T08:30:00"


def reasons(rows, **options):
    return [r._rejection_reason for r in with_rejection_reason(rows, **options).orderBy("_pos").collect()]


def test_required_fields(bronze):
    rows = bronze(
        ("d", T0, WM, "Start"),
        ("   ", T0, WM, "Start"),
        ("\t", T0, WM, "Start"),
        ("d", T0, WM, None),
        ("d", None, WM, "Start"),
        ("d", T0, " ", "Start"),
        ("NA", T0, WM, "null"),
    )
    assert reasons(rows) == [None] + ["missing_required_field"] * 5 + [None]


def test_missing_column_rejects_everything(bronze):
    rows = bronze(("d", T0, WM, "Start"), ("e", T0, WM, "End")).drop("DeviceType")
    assert reasons(rows) == ["missing_required_field"] * 2


def test_bad_time_goes_to_the_dead_letters(bronze):
    silver = build_silver(bronze(("d", "not-a-date", WM, "Start"), ("e", T0, WM, "End")), "now")
    (dead,) = silver.dead_letters.collect()
    assert (dead.DeviceId, dead.TimestampUTC, dead._rejection_reason) == ("d", "not-a-date", "unparseable_timestamp")
    assert dead._silver_processed_at == "now"
    assert silver.metrics.first().dropped_invalid == 1


@pytest.mark.parametrize(
    "text, lenient, strict",
    [
        (T0, T0 + "Z", T0 + "Z"),
        (T0 + "Z", T0 + "Z", T0 + "Z"),
        ("2023-06-15T08:30:00+02:00", "2023-06-15T06:30:00Z", None),
        ("2023-06-15T08:30:00-0130", "2023-06-15T10:00:00Z", None),
        ("2023-06-15T00:30:00+02", "2023-06-14T22:30:00Z", None),
        ("2023-06-15T08:30:00.75Z", "2023-06-15T08:30:00Z", None),
        ("2023-06-15T08:30Z", "2023-06-15T08:30:00Z", None),
        ("2023-06-15 08:30:00", "2023-06-15T08:30:00Z", None),
        ("2023-06-15", "2023-06-15T00:00:00Z", None),
        ("2023-13-15", None, None),
        ("2023-02-30T00:00:00", None, None),
        ("2023-06-15T24:00:00", None, None),
        ("2023", None, None),
        ("not-a-date", None, None),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times(spark, text, lenient, strict, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = spark.createDataFrame([(text,)], "t string").select(
            canonical_utc(F.col("t")).alias("lenient"), canonical_utc(F.col("t"), False).alias("strict")
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert (row.lenient, row.strict) == (lenient, strict)


def test_a_time_in_a_clock_change_stays(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = spark.sql("select '2023-03-12T02:30:00' as t").select(canonical_utc(F.col("t")).alias("c")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert row.c == "2023-03-12T02:30:00Z"


def test_first_arrival_stays(bronze):
    later = bronze(("d", T0, WM, "Start", {"n": 2}), ingested_at="2024-01-02T00:00:00Z")
    first = bronze(("d", T0 + "Z", WM, "Start", {"n": 1}), ("d", T0, WM, "Start", {"n": 3}))
    valid = valid_events(with_rejection_reason(later.unionByName(first)))
    (row,) = exact_dedup(valid).collect()
    assert row.Attributes == '{"n": 1}'
    assert duplicate_keys(valid).first().copies == 3


def test_doubling_changes_nothing(bronze):
    rows = [(f"d{i}", T0, WM, s) for i in range(10) for s in ("Start", "Failure")]
    once, twice = build_silver(bronze(*rows), "now"), build_silver(bronze(*rows, *rows), "now")
    assert sorted(once.events.collect()) == sorted(twice.events.collect())
    row = twice.metrics.first()
    assert (row.rows_in, row.rows_out, row.dropped_duplicate, row.dropped_fuzzy) == (40, 20, 20, 0)
    assert row.post_dedup_pct == 50.0


def test_silver_of_silver_is_silver(bronze):
    rows = [("d", T0, WM, s) for s in ("Start", "start", "Starts", "Failure", "End")]
    silver = build_silver(bronze(*rows), "now").events
    again = build_silver(silver.drop("_silver_processed_at"), "now").events
    assert sorted(again.collect()) == sorted(silver.collect()) and silver.count() < len(rows)


def test_counters_add_up(bronze):
    rows = bronze(
        ("d", T0, WM, "Program Start"),
        ("d", T0 + "Z", WM, "Program Start"),
        ("d", T0, WM, "program start"),
        ("d", "nope", WM, "Program Start"),
        (None, T0, WM, "Program Start"),
        ("d", T0, WM, "Program End"),
    )
    row = build_silver(rows, "now").metrics.first()
    assert row.asDict() == {
        "rows_in": 6, "rows_out": 2, "dropped_invalid": 2, "dropped_duplicate": 1, "dropped_fuzzy": 1,
        "invalid_pct": pytest.approx(100 / 3), "post_dedup_pct": pytest.approx(100 / 3),
    }
    exact_only = build_silver(rows, "now", SilverOptions(near_duplicates=False)).metrics.first()
    assert (exact_only.rows_out, exact_only.dropped_fuzzy) == (3, 0)


def test_device_type_case(bronze):
    rows = bronze(("d", T0, "washing MACHINE", "Start"), ("d", T0, WM, "Start"))
    silver = build_silver(rows, "now", SilverOptions(device_type_mode="initcap"))
    assert [r.DeviceType for r in silver.events.collect()] == ["Washing Machine"]
    assert silver.metrics.first().dropped_duplicate == 1


def test_empty_input(bronze):
    silver = build_silver(bronze(("d", T0, WM, "Start")).limit(0), "now")
    assert silver.events.count() == silver.dead_letters.count() == 0
    row = silver.metrics.first()
    assert (row.rows_in, row.rows_out, row.invalid_pct, row.post_dedup_pct) == (0, 0, 0.0, 0.0)


def test_restrict_and_upsert(bronze):
    table = bronze(("a", T0, WM, "Start", {"v": 1}), ("b", T0, WM, "Start", {"v": 1}))
    updates = bronze(("b", T0, WM, "Start", {"v": 2}), ("b", T0, WM, "Start", {"v": 3}), ("c", T0, WM, "End", {"v": 2}))
    assert [r.DeviceId for r in restrict_to_keys(table, updates).collect()] == ["b"]
    merged = {r.DeviceId: r.Attributes for r in upsert(table, updates).collect()}
    assert merged == {"a": '{"v": 1}', "b": '{"v": 2}', "c": '{"v": 2}'}


def test_key_columns_come_first(bronze):
    assert build_silver(bronze(("a", T0, WM, "Start")), "now").events.columns[:4] == IDENTITY
