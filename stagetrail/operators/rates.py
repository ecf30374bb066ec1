"""Response rate by group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetrail.functions.stats import rate, sample_flag, wilson


def response_rate(
    events: DataFrame,
    group: str,
    job: str = "job_id",
    event_type: str = "event_type",
    start: str = "applied",
    response: str = "reply",
) -> DataFrame:
    """Share of jobs with ``start`` that also have ``response``, per group, with a 95 % interval.

    Both sides are made distinct before the join. The distinct combines on the map
    side, so a job with very many events meets the join with one row per group, and
    each group's final count then needs no second distinct.
    """
    started = events.filter(F.col(event_type) == start).select(group, job).distinct()
    responded = events.filter((F.col(event_type) == response) & F.col(job).isNotNull()).select(job).distinct()
    flagged = started.join(responded.withColumn("_responded", F.lit(1)), job, "left")
    counts = flagged.groupBy(group).agg(
        F.count(job).alias("n_applied"),
        F.count("_responded").alias("n_replied"),
    )
    low, high = wilson(F.col("n_replied"), F.col("n_applied"))
    return counts.select(
        group,
        "n_applied",
        "n_replied",
        rate(F.col("n_replied"), F.col("n_applied")).alias("rate"),
        low.alias("wilson_low"),
        high.alias("wilson_high"),
        sample_flag(F.col("n_applied")).alias("flag"),
    )
