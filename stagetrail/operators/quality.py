"""Data-quality checks as rows ``check_name, value, threshold, status``."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagetrail.constants import (
    DQ_FRESHNESS_HOURS,
    DQ_NULL_RATE_LIMIT,
    DQ_WINDOW_DAYS,
    EVENT_TYPES,
    HEARTBEAT_SECONDS,
)
from stagetrail.functions.times import parse_ts, whole_hours

NULL_RATE_COLUMNS = ("event_id", "job_id", "event_type", "ts", "exported_at")


def _check(name: str, value: Column, threshold: float) -> Column:
    failed = F.coalesce(value > threshold, F.lit(False))
    return _row(name, value, F.lit(float(threshold)), F.when(failed, F.lit("fail")).otherwise(F.lit("ok")))


def _row(name: str, value: Column, threshold: Column, status: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        value.cast("double").alias("value"),
        threshold.cast("double").alias("threshold"),
        status.alias("status"),
    )


def _instant(now: datetime) -> Column:
    return F.lit(now).cast("timestamp_ntz")


def _naive(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz")


def quality_report(events: DataFrame, now: datetime, unbounded_nulls: bool = False) -> DataFrame:
    """All checks the table's columns allow, from a single scan.

    One aggregate computes every number; only the distinct counts of ids and jobs
    shuffle, combined before. A table without event types gets a ``schema_legacy`` warning instead of the type
    check. ``unbounded_nulls`` adds null rates without the date bound, the only way
    a missing ``ts`` can show up.
    """
    have = set(events.columns)
    one = F.count(F.lit(1))
    aggs = {"total": one, "ids": F.countDistinct("event_id")}
    if "event_type" in have:
        aggs["unknown"] = F.count_if(~F.col("event_type").isin(*EVENT_TYPES))
    if {"ts", "exported_at"} <= have:
        bound = _instant(now) - F.expr(f"INTERVAL {DQ_WINDOW_DAYS} DAYS")
        recent = _naive("ts") >= bound
        aggs["newest"] = F.max(_naive("exported_at"))
        aggs["recent"] = F.count_if(recent)
        for name in NULL_RATE_COLUMNS:
            if name in have:
                aggs[f"recent_null_{name}"] = F.count_if(recent & F.col(name).isNull())
                aggs[f"null_{name}"] = F.count_if(F.col(name).isNull())
    if "job_id" in have:
        aggs["jobs"] = F.countDistinct("job_id")
    summary = events.agg(*[c.alias(n) for n, c in aggs.items()])

    rows = [_check("duplicate_event_id", F.col("total") - F.col("ids"), 0)]
    if "unknown" in aggs:
        rows.append(_check("unknown_event_type_count", F.col("unknown"), 0))
    else:
        nothing = F.lit(None).cast("double")
        rows.append(_row("schema_legacy", nothing, nothing, F.lit("warn")))
    if "recent" in aggs:
        for name in NULL_RATE_COLUMNS:
            if name in have:
                share = F.try_divide(F.col(f"recent_null_{name}").cast("double"), F.col("recent"))
                rows.append(_check(f"null_rate_{name}", share, DQ_NULL_RATE_LIMIT))
                if unbounded_nulls:
                    share = F.try_divide(F.col(f"null_{name}").cast("double"), F.col("total"))
                    rows.append(_check(f"null_rate_{name}_all", share, DQ_NULL_RATE_LIMIT))
        age = whole_hours(F.col("newest"), _instant(now))
        rows.append(_check("freshness_hours_since_export", age, DQ_FRESHNESS_HOURS))
    rows.append(_row("row_count", F.col("total"), F.lit(None).cast("double"), F.lit("info")))
    if "job_id" in have:
        rows.append(_row("distinct_jobs", F.col("jobs"), F.lit(None).cast("double"), F.lit("info")))
    return summary.select(F.inline(F.array(*rows)))


def null_rates(events: DataFrame, now: datetime, columns: Sequence[str] = NULL_RATE_COLUMNS) -> DataFrame:
    """Null share per column over the recent window; the date bound reaches the scan."""
    bound = _instant(now) - F.expr(f"INTERVAL {DQ_WINDOW_DAYS} DAYS")
    recent = events.filter(F.col("ts") >= bound.cast(events.schema["ts"].dataType))
    counts = recent.agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(c).isNull()).alias(f"n_{c}") for c in columns]
    )
    share = lambda c: F.try_divide(F.col(f"n_{c}").cast("double"), F.col("total"))
    return counts.select(F.inline(F.array(*[_check(f"null_rate_{c}", share(c), DQ_NULL_RATE_LIMIT) for c in columns])))


def freshness(events: DataFrame, now: datetime) -> DataFrame:
    newest = events.agg(F.max(_naive("exported_at")).alias("newest"))
    age = whole_hours(F.col("newest"), _instant(now))
    return newest.select(F.inline(F.array(_check("freshness_hours_since_export", age, DQ_FRESHNESS_HOURS))))


def unknown_types(events: DataFrame, event_type: str = "event_type", known: Sequence[str] = EVENT_TYPES) -> DataFrame:
    bad = events.agg(F.count_if(~F.col(event_type).isin(*known)).alias("bad"))
    return bad.select(F.inline(F.array(_check("unknown_event_type_count", F.col("bad"), 0))))


def duplicate_ids(events: DataFrame, key: str = "event_id") -> DataFrame:
    counts = events.agg((F.count(F.lit(1)) - F.countDistinct(key)).alias("extra"))
    return counts.select(F.inline(F.array(_check("duplicate_event_id", F.col("extra"), 0))))


def heartbeat_health(
    beats: DataFrame, now: datetime, component: str = "component", utc: str = "utc", max_age: int = HEARTBEAT_SECONDS
) -> DataFrame:
    """Age of the newest heartbeat per component; none that parses means unhealthy."""
    newest = beats.groupBy(component).agg(F.max(parse_ts(F.col(utc))).alias("newest"))
    age = F.unix_seconds(F.lit(now).cast("timestamp")) - F.unix_seconds("newest")
    healthy = F.coalesce(age <= max_age, F.lit(False))
    return newest.select(
        component,
        age.alias("age_seconds"),
        F.when(healthy, F.lit("ok")).otherwise(F.lit("fail")).alias("status"),
    )
