"""Views over the event table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagetrail.functions.identity import json_field
from stagetrail.functions.times import whole_days
from stagetrail.operators.dedup import WIDE_COLUMNS, keep_latest
from stagetrail.operators.rates import response_rate


def events_dedup(events: DataFrame, covers: Sequence[str] = ()) -> DataFrame:
    return keep_latest(events, covers=covers)


def response_rate_view(events: DataFrame, group: str, covers: Sequence[str] = ()) -> DataFrame:
    """Response rates straight from the event table; payloads and keywords are not even read."""
    narrow = events.drop(*WIDE_COLUMNS)
    return response_rate(keep_latest(narrow, covers=covers), group)


def jobs_latest(dedup: DataFrame) -> DataFrame:
    """One row per job: first times by type, last time, and the fields of the latest event.

    Only the two payload fields in use are read out before the aggregate, so its
    buffers do not carry whole payloads. Equal times are settled by event id.
    """
    rows = dedup.select(
        "job_id",
        "event_id",
        "event_type",
        "ts",
        "title_family",
        "cv_version",
        json_field(dedup, "payload", "company").alias("company"),
        json_field(dedup, "payload", "title").alias("title"),
    )
    first = lambda kind: F.min(F.when(F.col("event_type") == kind, F.col("ts")))
    latest = F.struct("event_type", "title_family", "cv_version", "company", "title")
    per_job = rows.groupBy("job_id").agg(
        first("found").alias("first_found_ts"),
        first("applied").alias("applied_ts"),
        first("reply").alias("reply_ts"),
        F.max("ts").alias("last_event_ts"),
        F.max_by(latest, F.struct("ts", "event_id")).alias("latest"),
    )
    return per_job.select(
        "job_id",
        "first_found_ts",
        "applied_ts",
        "reply_ts",
        "last_event_ts",
        F.col("latest.event_type").alias("last_event_type"),
        F.col("latest.title_family").alias("title_family"),
        F.col("latest.cv_version").alias("cv_version"),
        F.col("latest.company").alias("company"),
        F.col("latest.title").alias("title"),
    )


def days_to_reply(latest: DataFrame) -> DataFrame:
    both = latest.filter(F.col("applied_ts").isNotNull() & F.col("reply_ts").isNotNull())
    return both.select(
        "job_id",
        "first_found_ts",
        "applied_ts",
        "reply_ts",
        whole_days(F.col("applied_ts"), F.col("reply_ts")).alias("days_to_reply"),
    )


def register_views(
    spark: SparkSession, events: DataFrame, covers: Sequence[str] = (), prefix: str = ""
) -> None:
    """Temp views in dependency order, under the names reports use.

    A caller whose ids are all made by ``functions.identity.event_id`` may pass
    ``dedup.CANONICAL_ID_COVERS``; with foreign or missing ids that would keep too many rows.
    """
    dedup = events_dedup(events, covers)
    latest = jobs_latest(dedup)
    named = {"events": events, "events_dedup": dedup, "jobs_latest": latest, "days_to_reply": days_to_reply(latest)}
    for group in ("title_family", "cv_version"):
        named[f"response_rate_by_{group}"] = response_rate_view(events, group, covers)
    for name, view in named.items():
        view.createOrReplaceTempView(prefix + name)
