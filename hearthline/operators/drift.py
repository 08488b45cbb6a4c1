"""Schema drift of attributes: paths that are new or whose type has changed, at any depth, per device family."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthline.operators.devices import FAMILIES, with_families

SCHEMAS = "family string, path string, type string"


def _fields(text: str) -> Iterator[tuple[str, str]]:
    """(name, type) of the fields of `name: type, ...`; names may be quoted by backticks, with doubled ones inside."""
    at = 0
    while at < len(text):
        if text[at] == "`":
            end = at + 1
            while text[end] != "`" or text[end : end + 2] == "``":
                end += 2 if text[end] == "`" else 1
            name, at = text[at + 1 : end].replace("``", "`"), end + 1
        else:
            end = text.index(":", at)
            name, at = text[at:end], end
        begin = at = at + len(": ")
        depth, quoted = 0, False
        while at < len(text) and (depth or quoted or text[at] != ","):
            quoted ^= text[at] == "`"
            depth += 0 if quoted else (text[at] in "<(") - (text[at] in ">)")
            at += 1
        yield name, text[begin:at]
        at += len(", ")


def paths(schema: str, at: str = "$") -> Iterator[tuple[str, str]]:
    """(path, type) of everything in a variant's schema text; objects and arrays are followed inwards."""
    kind, _, inner = schema.partition("<")
    if at != "$" or kind not in ("OBJECT", "ARRAY"):
        yield at, kind
    if kind == "OBJECT":
        for name, of in _fields(inner[:-1]):
            yield from paths(of, f"{at}.{name}")
    elif kind == "ARRAY":
        yield from paths(inner[:-1], f"{at}[*]")


def family_schemas(events: DataFrame) -> DataFrame:
    """(family, path, type) of all attributes seen: one merged schema per family, combined on the map side.

    A type that differs between events is VARIANT. Texts that are no JSON are left out. The schemas, as many as
    there are families, pass through the driver as text.
    """
    routed = with_families(events).select(F.explode(F.split(FAMILIES, r"\+")).alias("family"), F.try_parse_json("Attributes").alias("v"))
    merged = routed.where(F.col("v").isNotNull()).groupBy("family").agg(F.schema_of_variant_agg("v").alias("schema"))
    rows = [(r.family, path, kind) for r in merged.collect() for path, kind in paths(r.schema)]
    return events.sparkSession.createDataFrame(rows, SCHEMAS)


def schema_drift(known: DataFrame, found: DataFrame) -> DataFrame:
    """Paths found with a type that the stored table of known ones doesn't list: family, path, old and new type.

    A path without values (VOID) tells nothing, and an integer where decimals are known is no drift.
    """
    old = known.select("family", "path", F.col("type").alias("old_type"))
    joined = found.where("type <> 'VOID'").select("family", "path", F.col("type").alias("new_type")).join(old, ["family", "path"], "left")
    wider = (F.col("new_type") == "BIGINT") & F.col("old_type").rlike("^(DECIMAL|DOUBLE)")
    same = (F.col("old_type") == F.col("new_type")) | wider | (F.col("old_type") == "VARIANT")
    return joined.where(~F.coalesce(same, F.lit(False)))


def stored_schemas(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMAS).parquet(path)
