"""Stage counts, drop rates, threshold alerts, value rules and the routing check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthline.operators.devices import of_unknown_type
from hearthline.schemas import (
    ALERT_INVALID_PCT,
    ALERT_POST_DEDUP_PCT,
    BAD_TIMESTAMP,
    IDENTITY,
    MISSING_FIELD,
)

STAGES = ["bronze", "missing", "bad_time", "valid", "exact", "silver"]


class QualityBreach(RuntimeError):
    """A data-quality threshold was exceeded."""


def bronze_counts(judged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counters of rows with a rejection reason, in one pass; of all, or per load for example."""
    reason = F.col("_rejection_reason")
    return judged.groupBy(*by).agg(
        F.count("*").alias("bronze_rows"),
        F.count_if(reason == MISSING_FIELD).alias("missing_rows"),
        F.count_if(reason == BAD_TIMESTAMP).alias("bad_time_rows"),
        F.count_if(reason.isNull()).alias("valid_rows"),
    )


def stage_counters(judged: DataFrame, exact: DataFrame, silver: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Wide counters of every stage; of all, or per load for example.

    `exact` holds the first arrival per identity and `silver` what near duplicates leave of it. All counts
    add up, over loads as over tasks: a row counts in the load that it came with, so the counters of a range of
    loads are sums, and nothing is counted as distinct.
    """
    zero = F.lit(0).cast("long")

    def alone(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy(*by).agg(F.count("*").alias(name))

    parts = [bronze_counts(judged, by), alone(exact, "exact_rows"), alone(silver, "silver_rows")]
    names = [f"{s}_rows" for s in STAGES]
    padded = [p.select(*by, *[F.col(n) if n in p.columns else zero.alias(n) for n in names]) for p in parts]
    rows = padded[0].unionAll(padded[1]).unionAll(padded[2])
    return rows.groupBy(*by).agg(*[F.sum(n).alias(n) for n in names])


def long_form(counters: DataFrame) -> DataFrame:
    """Summed wide counters as rows: stage, rows."""
    total = counters.agg(*[F.coalesce(F.sum(f"{s}_rows"), F.lit(0).cast("long")).alias(s) for s in STAGES])
    return total.select(F.inline(F.array(*[F.struct(F.lit(s).alias("stage"), F.col(s).alias("rows")) for s in STAGES])))


def stage_counts(judged: DataFrame, exact: DataFrame, silver: DataFrame) -> DataFrame:
    """Rows per stage in long form: stage, rows."""
    return long_form(stage_counters(judged, exact, silver))


def _pct(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole) * F.lit(100.0), F.lit(0.0))


def quality_metrics(stages: DataFrame) -> DataFrame:
    """One row: rows in and out, rows dropped for each cause, and the two drop rates in percent."""

    def rows(stage: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("stage") == stage, F.col("rows"))), F.lit(0).cast("bigint"))

    c = {n: F.col(n) for n in STAGES}
    invalid = c["missing"] + c["bad_time"]
    return stages.agg(*[rows(n).alias(n) for n in STAGES]).select(
        c["bronze"].alias("rows_in"),
        c["silver"].alias("rows_out"),
        invalid.alias("dropped_invalid"),
        (c["valid"] - c["exact"]).alias("dropped_duplicate"),
        (c["exact"] - c["silver"]).alias("dropped_fuzzy"),
        _pct(invalid, c["bronze"]).alias("invalid_pct"),
        _pct(c["valid"] - c["silver"], c["bronze"]).alias("post_dedup_pct"),
    )


def quality_alerts(
    metrics: DataFrame,
    invalid_threshold: float = ALERT_INVALID_PCT,
    post_dedup_threshold: float = ALERT_POST_DEDUP_PCT,
) -> DataFrame:
    """One row per check: value, threshold, whether it is exceeded, and a message if so."""

    def check(name: str, threshold: float, text: str) -> Column:
        value, limit = F.col(name), F.lit(float(threshold))
        message = F.format_string(f"{text} %.1f%% exceeds threshold %.1f%%", value, limit)
        return F.struct(
            F.lit(name).alias("check"),
            value.alias("value"),
            limit.alias("threshold"),
            (value > limit).alias("breached"),
            F.when(value > limit, message).alias("message"),
        )

    checks = F.array(
        check("invalid_pct", invalid_threshold, "share of rejected rows"),
        check("post_dedup_pct", post_dedup_threshold, "share of dropped copies"),
    )
    return metrics.select(F.inline(checks))


def enforce(alerts: DataFrame, on_breach: str = "warn") -> list[str]:
    """Messages of the exceeded checks; `on_breach='fail'` raises them."""
    messages = [r.message for r in alerts.where("breached").select("message").collect()]
    if messages and on_breach == "fail":
        raise QualityBreach("; ".join(messages))
    return messages


def rule_violations(rows: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows checked and rows violating each named condition, in one pass: rule, checked, violations.

    A row violates a rule when its condition is false; NULL counts as not applicable.
    """
    counted = rows.agg(
        *[F.count(condition).alias(f"checked_{i}") for i, condition in enumerate(rules.values())],
        *[F.count_if(~condition).alias(f"failed_{i}") for i, condition in enumerate(rules.values())],
    )
    entries = [
        F.struct(
            F.lit(name).alias("rule"),
            F.col(f"checked_{i}").alias("checked"),
            F.col(f"failed_{i}").alias("violations"),
        )
        for i, name in enumerate(rules)
    ]
    return counted.select(F.inline(F.array(*entries)))


def unrouted_events(silver: DataFrame, gold_tables: Mapping[str, DataFrame]) -> DataFrame:
    """Silver keys that reached no device table; lossless routing leaves this empty."""
    routed = None
    for table in gold_tables.values():
        keys = table.select(*IDENTITY)
        routed = keys if routed is None else routed.unionByName(keys)
    return silver.select(*IDENTITY).join(routed.distinct(), IDENTITY, "left_anti")


def routing_counts(silver: DataFrame, gold_tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per gold table, of silver, of unknown types and of unrouted events: table, rows."""

    def counted(name: str, rows: DataFrame) -> DataFrame:
        return rows.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")

    result = counted("silver", silver)
    for name, table in gold_tables.items():
        result = result.unionByName(counted(name, table))
    return result.unionByName(counted("unknown_types", of_unknown_type(silver))).unionByName(
        counted("unrouted", unrouted_events(silver, gold_tables))
    )
