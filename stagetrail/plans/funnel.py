"""Dashboard figures over the views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagetrail.operators.percentiles import median


def of_families(latest: DataFrame, families: list[str] | None = None) -> DataFrame:
    """The dashboard's title-family control."""
    return latest if not families else latest.filter(F.col("title_family").isin(*families))


def scorecards(latest: DataFrame) -> DataFrame:
    """jobs_latest holds one row per job, so its non-null ids are the distinct jobs."""
    return latest.agg(
        F.count("job_id").alias("jobs"),
        F.count("applied_ts").alias("applied"),
        F.count("reply_ts").alias("replied"),
    )


def by_last_event(latest: DataFrame) -> DataFrame:
    return latest.groupBy("last_event_type").agg(F.count(F.lit(1)).alias("n"))


def weekly_found(latest: DataFrame) -> DataFrame:
    """Jobs per week (Monday) of their first found event."""
    week = F.to_date(F.date_trunc("week", "first_found_ts")).alias("week")
    return latest.groupBy(week).agg(F.count(F.lit(1)).alias("n"))


def day_bucket(days: Column) -> Column:
    return F.when(days <= 3, "0-3").when(days <= 7, "4-7").when(days <= 14, "8-14").otherwise("15+")


def reply_buckets(days: DataFrame) -> DataFrame:
    return days.groupBy(day_bucket(F.col("days_to_reply")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def reply_median(days: DataFrame) -> DataFrame:
    return median(days, "days_to_reply", out="median_days")
