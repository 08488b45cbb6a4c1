import pytest
from pyspark.sql import functions as F

from hearthline.operators.drift import family_schemas, paths, schema_drift
from hearthline.plans.layout import compact_z, cut_points, read_skipping, z_key

AT = "2024-01-01T00:00:00Z"


def test_bits_are_interleaved(spark):
    rows = spark.range(256).select((F.col("id") % 16).alias("x"), F.floor(F.col("id") / 16).alias("y"))
    for r in rows.withColumn("z", z_key([F.col("x"), F.col("y")], 4)).collect():
        expected = int("".join(a + b for a, b in zip(f"{r.x:04b}", f"{r.y:04b}")), 2)
        assert r.z == expected


def test_filters_on_either_column_skip_files(spark, bronze, tmp_path):
    rows = bronze(*[(f"d{i % 60:02d}", f"2024-01-{1 + i // 60:02d}T00:00:00Z", "Fridge", "End") for i in range(1500)], (None, AT, "Fridge", "End"))
    path = str(tmp_path / "z")
    compact_z(rows.repartition(5), path, files=16)
    files = spark.read.parquet(f"{path}/files")
    assert files.agg(F.sum("rows")).first()[0] == 1501 and files.count() > 8
    everything = read_skipping(spark, path, rows.schema, {})
    assert sorted(map(repr, everything.collect())) == sorted(map(repr, rows.collect()))
    for ranges, expected in [
        ({"DeviceId": ("d07", "d07")}, F.col("DeviceId") == "d07"),
        ({"TimestampUTC": (None, "2024-01-03T00:00:00Z")}, F.col("TimestampUTC") <= "2024-01-03T00:00:00Z"),
        ({"DeviceId": ("d50", None), "TimestampUTC": ("2024-01-20", None)}, (F.col("DeviceId") >= "d50") & (F.col("TimestampUTC") >= "2024-01-20")),
    ]:
        found = read_skipping(spark, path, rows.schema, ranges)
        assert sorted(map(repr, found.collect())) == sorted(map(repr, rows.where(expected).collect()))
        assert len(found.inputFiles()) < files.count() * 0.75
    assert read_skipping(spark, path, rows.schema, {"DeviceId": ("x", None)}).collect() == []


def test_cut_points_of_few_values(spark, bronze):
    assert cut_points(bronze(("a", AT, "x", "y"), ("a", AT, "x", "y")), "DeviceId", 7) == ["a"]
    assert cut_points(bronze((None, AT, "x", "y")), "DeviceId", 7) == []


@pytest.mark.parametrize(
    "schema, expected",
    [
        ("BIGINT", [("$", "BIGINT")]),
        ("OBJECT<a: BIGINT, b: ARRAY<OBJECT<c: STRING>>>", [("$.a", "BIGINT"), ("$.b", "ARRAY"), ("$.b[*]", "OBJECT"), ("$.b[*].c", "STRING")]),
        ("ARRAY<ARRAY<VOID>>", [("$[*]", "ARRAY"), ("$[*][*]", "VOID")]),
        ("OBJECT<`a, b``<`: DECIMAL(3,1), x: BOOLEAN>", [("$.a, b`<", "DECIMAL(3,1)"), ("$.x", "BOOLEAN")]),
        ("OBJECT<>", []),
    ],
)
def test_paths_of_a_schema(schema, expected):
    assert list(paths(schema)) == expected


def test_drift(spark, bronze):
    known = family_schemas(bronze(("d", AT, "Washing machine", "s", {"a": 1.5, "b": {"c": "x"}, "odd, key": 1}), ("d", AT, "Washing machine", "s", "{broken")))
    rows = [
        ("d", AT, "Washing machine", "s", {"a": 2, "b": {"c": 7, "new": [{"deep": True}]}, "odd, key": 2, "nothing": None}),
        ("d", AT, "Coffee Washing", "s", [{"Id": "x"}]),
    ]
    found = schema_drift(known, family_schemas(bronze(rows[0])))
    assert {(r.path, r.old_type, r.new_type) for r in found.collect()} == {
        ("$.b.c", "STRING", "BIGINT"), ("$.b.new", None, "ARRAY"), ("$.b.new[*]", None, "OBJECT"), ("$.b.new[*].deep", None, "BOOLEAN")
    }
    both = family_schemas(bronze(rows[1]))
    assert {(r.family, r.path) for r in both.collect()} == {(f, p) for f in ("washing", "coffee") for p in ("$[*]", "$[*].Id")}
