"""Queue items to records, review queue and found events."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagetrail.constants import IMAGE_JOB_PREFIX
from stagetrail.functions.text import computed_once
from stagetrail.operators.hooks import Extractor, run_extractor
from stagetrail.operators.records import (
    image_found_events,
    normalize_records,
    review_reasons,
    safe_file_ref,
    with_reply_object,
)
from stagetrail.operators.safety import record_hits
from stagetrail.operators.sync import decide, to_append
from stagetrail.plans.funnel import scorecards
from stagetrail.plans.views import events_dedup, jobs_latest
from stagetrail.sources.event_table import append_events, read_events, table_rows

ATTEMPTS = 3


@dataclass(frozen=True)
class QueueResult:
    records: DataFrame
    errors: DataFrame

    @property
    def review(self) -> DataFrame:
        return self.records.filter("needs_review")

    @property
    def events(self) -> DataFrame:
        return image_found_events(self.records)


def structure_replies(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """Add ``record, invalid, hits, reasons, needs_review`` for a column of free-text replies."""
    docs = with_reply_object(replies, reply)
    records = normalize_records(docs)
    fields = [f"_{n}" for n in ("title", "company", "location", "contact")]
    flat = records.withColumns({f: F.col(f"record.{f[1:]}") for f in fields})
    flat = flat.withColumn("_requirements", F.col("record.requirements"))
    # The text the extractor read counts too: an attack in it must not pass because the record left it out.
    read = ["source_text"] if "source_text" in replies.columns else []
    scanned = record_hits(flat, [*fields, *read], ["_requirements"]).drop(*fields, "_requirements", "doc")
    reasons = review_reasons(F.col("record"), F.col("hits"))
    return computed_once(scanned.withColumn("reasons", reasons), "reasons").withColumn("needs_review", F.size("reasons") > 0)


def drain_queue(items: DataFrame, files: DataFrame, extract: Extractor, path_name: str) -> QueueResult:
    """Run the extractor over queue items joined with their file content.

    ``files`` has ``file_id, content``. Unsafe references and missing files become
    errors; an extractor that fails gives a record that needs review.
    """
    checked = items.withColumn("mime", F.coalesce("mime", F.lit("image/png"))).withColumn(
        "_safe", safe_file_ref(F.col("file_id"))
    )
    safe = checked.filter("_safe").drop("_safe")
    # An inner join lets Spark send a short queue to the files; contents then stay where they are read.
    found = files.select("file_id", "content").join(safe, "file_id")
    missing = safe.join(files.select("file_id"), "file_id", "left_anti")
    unsafe = checked.filter("NOT _safe").drop("_safe").withColumn("error", F.lit("invalid file_id path"))
    errors = unsafe.unionByName(missing.withColumn("error", F.lit("missing image")))
    results = run_extractor(found, extract, ATTEMPTS)
    records = structure_replies(results).withColumn("path", F.lit(path_name))
    return QueueResult(records, errors)


def write_queue_result(result: QueueResult, root: str, batch: str) -> QueueResult:
    """All records and the ones to review, each under its batch; repeating a batch replaces it.

    The extractor runs here, once. The result that is returned reads the written records, so review copy, events and
    whatever else is made of it agree and cost nothing more.
    """
    spark = result.records.sparkSession
    ads = f"{root}/ads/batch={batch}"
    result.records.write.mode("overwrite").parquet(ads)
    written = QueueResult(spark.read.parquet(ads), result.errors)
    written.review.write.mode("overwrite").parquet(f"{root}/review_queue/batch={batch}")
    return written


def read_records(spark: SparkSession, root: str, name: str = "ads") -> DataFrame:
    """Records of all batches, or of the ``review_queue``: one per content hash, the one of the last batch."""
    rows = spark.read.parquet(f"{root}/{name}")
    rest = [c for c in rows.columns if c not in ("sha256", "batch")]
    newest = rows.groupBy("sha256").agg(F.max_by(F.struct(*rest), F.struct(F.col("batch").cast("string"), "task_id")).alias("r"))
    return newest.select("sha256", "r.*")


def run_queue(
    items: DataFrame, files: DataFrame, extract: Extractor, path_name: str, root: str, batch: str, table_path: str, run_ts: datetime
) -> dict[str, object]:
    """Drain the queue, keep records and reviews by content hash, and append the found events the table lacks.

    Returns counts and the refreshed ``funnel`` figures of the table. The id of a found event comes from content hash
    and queue time, so a repeated batch appends nothing.
    """
    spark = items.sparkSession
    result = write_queue_result(drain_queue(items, files, extract, path_name), root, batch)
    rows = table_rows(result.events, F.lit(None).cast("timestamp"))
    # Records the review holds back are not events yet.
    ready = result.records.filter("NOT needs_review").select(F.concat(F.lit(IMAGE_JOB_PREFIX), F.left("sha256", F.lit(12))).alias("job_id"))
    decided = decide(rows.join(ready.distinct(), "job_id", "left_semi"), read_events(spark, table_path))
    export = append_events(to_append(decided), table_path, run_ts, dry_run=False)
    counts = result.records.agg(F.count(F.lit(1)).alias("records"), F.count_if("needs_review").alias("review")).first().asDict()
    latest = jobs_latest(events_dedup(read_events(spark, table_path)))
    return {**counts, "errors": result.errors.count(), "appended": export["rows"], "funnel": scorecards(latest).first().asDict()}
