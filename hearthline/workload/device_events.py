"""Device events derived from the `events` table.

The column rules below are plain SQL that Spark and DuckDB read alike; only the date formatting differs.
They turn every event into one device event, some of them into an exact copy and some into a near copy
as well, and break the time, the status or the text of a few, so that every operator finds work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPARK_TIME = "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\")"
DUCKDB_TIME = "strftime(ts, '%Y-%m-%dT%H:%M:%S')"

# kind 0 is the event itself, 1 an exact copy (without the Z), 2 a near copy
KINDS = "kind = 0 or (kind = 1 and event_id % 20 = 0) or (kind = 2 and event_id % 50 in (1, 26))"

_STATUS = """case when event_id % 89 = 0 then '   '
 when event_type = 'error' then 'Program Failure'
 when event_type in ('click', 'view') then 'Program Start'
 else 'Program End' end"""

_V = "cast(floor(value) as bigint)"
_UNIT = "case when event_id % 2 = 0 then 'Celsius' else 'Fahrenheit' end"

_WASHING = f"""case
 when event_type = 'error' and event_id % 4 = 0 then '{{"FailureIds": []}}'
 when event_type = 'error' then concat('{{"FailureIds": [', {_V}, ', 17]}}')
 else concat('{{"Temperature": ', {_V}, ', "Temperature_Unit": "', {_UNIT},
 '", "SpinningSpeed": ', 600 + 100 * (event_id % 9), ', "SpinningSpeed_Unit": "Rotations per Minute"',
 case when event_id % 5 = 0 then '' else concat(', "TwinDos": [', {_V}, ', 90], "TwinDos_Unit": "Percentage"') end,
 '}}') end"""

_COFFEE = f"""concat('[{{"Id": "Temperature", "Value": ', {_V}, ', "Unit": "Celsius"}}',
 case when event_id % 2 = 0 then ', {{"Id": "Cup-Size", "Value": 30, "Unit": "ml"}}' else '' end,
 case when event_id % 7 = 0 then ', {{"Id": " Grinding ", "Value": "55.5", "Unit": "Percentage"}}, 7' else '' end,
 ']')"""

_DISHWASHER = f"""case
 when event_type = 'error' then concat('{{"FailureIds": [5, "', {_V} % 40, '", "x"]}}')
 else concat('{{"Temperature": ', {_V}, ', "Temperature_Unit": "', {_UNIT}, '"',
 case when event_id % 11 = 0 then '' else concat(', "QuickPowerWashActive": ', event_id % 2) end, '}}') end"""

# Per event. Later steps may use the columns of earlier ones.
PER_EVENT = {
    "event_id": "event_id",
    "_batch_id": "cast(floor(event_id / 1000) as bigint)",
    "DeviceId": "concat(case when user_id % 4 = 3 then 'syn_' else 'dev_' end, user_id)",
    "DeviceType": """case when user_id % 10 < 5 then 'Washing machine' when user_id % 10 < 8 then 'Coffee Machine'
 when user_id % 10 = 8 then 'Dishwasher' else 'Refrigerator' end""",
    "plain_time": "case when event_id % 97 = 0 then 'not-a-date' else {time} end",
    "zone": "case when event_id % 3 = 0 and event_id % 97 <> 0 then 'Z' else '' end",
    "plain_status": _STATUS,
    "near_status": f"""case when event_id % 50 = 1 then replace({_STATUS}, 'Program S', 'Program s')
 when event_id % 89 = 0 then {_STATUS} else concat({_STATUS}, 's') end""",
    "Attributes": f"""case when user_id % 10 < 5 then {_WASHING} when user_id % 10 < 8 then {_COFFEE}
 when user_id % 10 = 8 then {_DISHWASHER} else concat('{{"QuickPowerWashActive": ', event_id % 2, '}}') end""",
}

# Per event and kind of copy.
PER_COPY = {
    "DeviceId": "DeviceId",
    "TimestampUTC": "case when kind = 1 then plain_time else concat(plain_time, zone) end",
    "DeviceType": "DeviceType",
    "Status": "case when kind = 2 then near_status else plain_status end",
    "Attributes": "Attributes",
    "_ingested_at": "'2024-02-01T00:00:00Z'",
    "_source_file": "'events'",
    "_pos": "event_id * 3 + kind",
    "_batch_id": "_batch_id",
    "event_id": "event_id",
}

_MESSAGE = """concat('{"DeviceId": "', DeviceId, '", "TimestampUTC": "', TimestampUTC, '", "DeviceType": "', DeviceType,
 '", "Status": "', Status, '", "Attributes": ', Attributes, '}')"""

# Texts: mostly the message; some are cut off, some are bare values.
TEXTS = {
    "message": _MESSAGE,
    "record": f"""case when event_id % 101 = 0 then substr({_MESSAGE}, 1, length({_MESSAGE}) - 1)
 when event_id % 103 = 0 then concat('', event_id)
 when event_id % 107 = 0 then 'null'
 else {_MESSAGE} end""",
    "element": f"""case when event_id % 103 = 0 then concat('', event_id) when event_id % 107 = 0 then 'null'
 when event_id % 109 = 0 then '"{{text}}"' else {_MESSAGE} end""",
}


def _columns(rules: dict[str, str], time_sql: str = "", quote: str = "`") -> list[str]:
    return [f"{sql.replace('{time}', time_sql)} as {quote}{name}{quote}" for name, sql in rules.items()]


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def device_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze columns plus `_batch_id`, one row per device event."""
    return _copies(spark, sf_dir).drop("event_id")


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device events with their message texts."""
    return _copies(spark, sf_dir).selectExpr("*", *_columns(TEXTS))


def _copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load(spark, sf_dir, "events").selectExpr(*_columns(PER_EVENT, SPARK_TIME))
    kinds = events.withColumn("kind", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).where(KINDS)
    return kinds.selectExpr(*_columns(PER_COPY))


def duckdb_device_events() -> str:
    """The same rows as a DuckDB query."""
    per_event, per_copy, texts = (
        ",\n".join(_columns(rules, DUCKDB_TIME, '"')) for rules in (PER_EVENT, PER_COPY, TEXTS)
    )
    return f"""select *, {texts} from (
 select {per_copy} from (select {per_event} from events), (values (0), (1), (2)) as kinds(kind) where {KINDS})"""
