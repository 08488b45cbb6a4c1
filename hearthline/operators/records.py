"""From raw JSON text to bronze rows, with dead letters for text that does not parse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.schemas import BRONZE, IDENTITY, MESSAGE

NOT_AN_ARRAY = "the file holds no JSON array at its root"
NOT_JSON_FILE = "file is not valid JSON"
NOT_JSON_RECORD = "record is not valid JSON"


def _wrapped(text: Column) -> Column:
    """The text as the only element of an array, so text after the first document is noticed."""
    return F.concat(F.lit("["), text, F.lit("]"))


def _sole_element(array: Column) -> Column:
    return F.when(F.size(array) == 1, F.get(array, 0))


def array_elements(text: Column) -> Column:
    """JSON texts of the elements of a root array; NULL when the text is no JSON array.

    The texts are cut out as they stand, so key order and the digits of numbers stay. The variant parser
    only tells which elements are strings. It refuses objects with a repeated key; in such a file an element
    that doesn't read as JSON by itself is taken for a string, and the last of the repeated values wins when
    the element is read.
    """
    variants = F.try_variant_get(
        _sole_element(F.try_variant_get(F.try_parse_json(_wrapped(text)), "$", "array<variant>")),
        "$",
        "array<variant>",
    )
    pieces = _sole_element(F.from_json(_wrapped(text), "array<array<string>>"))
    strings = F.transform(variants, lambda v: F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False)))

    def text_of(p: Column, string: Column) -> Column:
        plain = p.rlike(r"^\s*[\[{]") | F.try_parse_json(p).isNotNull()
        is_string = F.coalesce(string, ~plain)
        quoted = F.regexp_replace(F.to_json(F.array(p)), r"(?s)^\[(.*)\]$", "$1")
        return F.when(p.isNull(), F.lit("null")).when(is_string, quoted).otherwise(p)

    unknown = F.transform(pieces, lambda p: F.lit(None).cast("boolean"))
    return F.coalesce(F.zip_with(pieces, F.coalesce(strings, unknown), text_of), F.transform(variants, lambda v: F.to_json(v)))


def explode_elements(files: DataFrame) -> DataFrame:
    """One record per array element of `value`, numbered by `_pos`; a bad file stays one record.

    Adds `_file_error`: NULL for elements, the reason for a file that is no JSON array.
    """
    elements = array_elements(F.col("value"))
    reason = F.when(
        F.try_parse_json(_wrapped(F.col("value"))).isNotNull(), F.lit(NOT_AN_ARRAY)
    ).otherwise(F.lit(NOT_JSON_FILE))
    good = F.transform("_elements", lambda e: F.struct(e.alias("value"), F.lit(None).cast("string").alias("error")))
    bad = F.array(F.struct(F.col("value"), reason.alias("error")))
    others = [c for c in files.columns if c not in ("value", "_pos")]
    return (
        files.withColumn("_elements", elements)
        .select(*others, F.posexplode(F.coalesce(good, bad)).alias("_pos", "_record"))
        .select(
            F.col("_record.value").alias("value"),
            *others,
            F.col("_pos").cast("bigint").alias("_pos"),
            F.col("_record.error").alias("_file_error"),
        )
    )


def parse_records(records: DataFrame) -> DataFrame:
    """Bronze columns from record text, plus `_raw_error`, NULL for every row that parsed.

    Objects give the identity fields and Attributes as JSON text. Other valid JSON values are kept as
    rows with a null identity and the value in Attributes. Everything else carries an error document.
    Columns other than `value` pass through.
    """
    text = F.col("value")
    others = [F.col(c) for c in records.columns if c not in ("value", "_file_error")]
    file_error = F.col("_file_error") if "_file_error" in records.columns else F.lit(None).cast("string")
    messages = F.from_json(_wrapped(text), f"array<{MESSAGE.simpleString()}>")
    # Exploding a one-element array keeps later filters and columns from repeating the parse.
    parsed = records.select(
        *others, text, file_error.alias("_file_error"), F.explode(F.array(messages)).alias("_messages")
    ).select(*others, text, "_file_error", _sole_element(F.col("_messages")).alias("_m"))
    # Only rows without a message object pay for the second parse.
    scalar = F.when(F.col("_m").isNull(), F.try_parse_json(_wrapped(text)))
    is_value = F.col("_m").isNotNull() | (F.size(F.try_variant_get(scalar, "$", "array<variant>")) == 1)
    failed = F.col("_file_error").isNotNull() | ~F.coalesce(is_value, F.lit(False))
    error = F.to_json(
        F.struct(
            F.coalesce("_file_error", F.lit(NOT_JSON_RECORD)).alias("_error"),
            F.coalesce(text, F.lit("")).alias("_raw"),
        )
    )
    attributes = F.when(F.col("_m").isNotNull(), F.col("_m.Attributes")).when(F.trim(text) != "null", F.trim(text))
    ok = ~failed
    return parsed.select(
        *[F.when(ok, F.col(f"_m.{c}")).alias(c) for c in IDENTITY],
        F.when(ok, attributes).alias("Attributes"),
        *others,
        F.when(failed, error).alias("_raw_error"),
    )


def good_records(parsed: DataFrame) -> DataFrame:
    """Rows that parsed, in the bronze column order; extra columns follow."""
    names = [f.name for f in BRONZE.fields if f.name in parsed.columns]
    extra = [c for c in parsed.columns if c not in names and c != "_raw_error"]
    return parsed.where(F.col("_raw_error").isNull()).select(*names, *extra)


def dead_records(parsed: DataFrame) -> DataFrame:
    """Error documents of the rows that did not parse, with their load time and file."""
    return parsed.where(F.col("_raw_error").isNotNull()).select("_raw_error", "_ingested_at", "_source_file")
