"""Keep-latest, duplicate groups and table counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stagetrail.functions.identity import is_variant

# Columns an id made by ``functions.identity.event_id`` already fixes.
CANONICAL_ID_COVERS = ("job_id", "event_type", "ts")


# Content columns that cost far more to read than the rest.
WIDE_COLUMNS = ("keywords", "payload")


def _tie_breakers(df: DataFrame, key: str, order: str) -> list:
    """Remaining columns, wide ones last, so that a view without them settles ties the same way."""
    names = sorted((n for n in df.columns if n not in (key, order)), key=lambda n: n in WIDE_COLUMNS)
    return [(F.to_json(n) if is_variant(df, n) else F.col(n)).desc() for n in names]


def keep_latest(
    events: DataFrame,
    key: str = "event_id",
    order: str = "exported_at",
    tie_breakers: Sequence[str] | None = None,
    covers: Sequence[str] = (),
) -> DataFrame:
    """One row per key: the one exported last.

    Equal stamps are settled by ``tie_breakers`` (default: the remaining columns),
    so the result does not depend on row order. ``covers`` names columns that are
    a function of the key; as extra partition columns they change nothing in the
    result, but let filters on them move below the window into the scan.

    Rank-one windows are limited per task before the exchange, so a key holding a
    large share of the rows ships one row per task.
    """
    ties = _tie_breakers(events, key, order) if tie_breakers is None else [F.col(c).desc() for c in tie_breakers]
    newest_first = Window.partitionBy(key, *covers).orderBy(F.col(order).desc_nulls_last(), *ties)
    return events.withColumn("_rank", F.row_number().over(newest_first)).filter("_rank = 1").drop("_rank")


def duplicate_groups(df: DataFrame, key: str = "event_id") -> DataFrame:
    """Keys that occur more than once, most frequent first."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").orderBy(F.col("n").desc(), key)


def table_counts(events: DataFrame, key: str = "event_id", job: str = "job_id") -> DataFrame:
    """Rows, distinct ids, duplicates (rows without an id count as such) and distinct jobs."""
    counts = events.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.countDistinct(key).alias("distinct_ids"),
        F.countDistinct(job).alias("distinct_jobs"),
    )
    return counts.withColumn("duplicates", F.col("total_rows") - F.col("distinct_ids"))
