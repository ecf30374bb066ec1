"""Ledger insights by current status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetrail.constants import APPLIED_STATUSES, TITLE_RULES
from stagetrail.functions.stats import rate_or_zero
from stagetrail.functions.text import non_empty
from stagetrail.functions.titles import title_family


def _status():
    return F.lower(F.coalesce(non_empty(F.col("status")), F.lit("unknown")))


def ledger_rates(jobs: DataFrame) -> DataFrame:
    """Totals and rates; replies are counted over all jobs, so the second rate may exceed 1."""
    totals = jobs.agg(
        F.count(F.lit(1)).alias("jobs_total"),
        F.count_if(_status().isin(*APPLIED_STATUSES)).alias("applied_count"),
        F.count_if(F.coalesce("reply_seen_at_utc", F.lit("")) != "").alias("reply_count"),
    )
    return totals.select(
        "*",
        rate_or_zero(F.col("applied_count"), F.col("jobs_total")).alias("apply_rate"),
        rate_or_zero(F.col("reply_count"), F.col("applied_count")).alias("reply_rate_of_applied"),
    )


def ledger_histograms(jobs: DataFrame, title_rules: Sequence[tuple[str, str]] = TITLE_RULES) -> DataFrame:
    """Counts by status, title family and origin as ``(dimension, value, n)`` from one scan."""
    pair = lambda d, v: F.struct(F.lit(d).alias("dimension"), v.alias("value"))
    pairs = F.array(
        pair("status", _status()),
        pair("title_family", title_family(F.col("title"), title_rules)),
        pair("origin", F.coalesce(non_empty(F.col("origin")), F.lit("unknown"))),
    )
    return jobs.select(F.inline(pairs)).groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("n"))
