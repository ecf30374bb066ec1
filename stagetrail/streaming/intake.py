"""Task intake: validate, handle each identity once, retry, dead-letter."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone

import pandas as pd

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stagetrail.constants import FILE_TASKS, MAX_ATTEMPTS, RETENTION_DAYS, RETRY_SECONDS
from stagetrail.operators.contracts import check_messages, delivery_outcome, queue_items
from stagetrail.schemas import TASK_SCHEMA_TYPE
from stagetrail.sources.state import FOLD_EVERY, VersionedState
from stagetrail.streaming.listener import heartbeat_rows

# A handler gets the tasks of its type, one row per identity, and returns (dedupe_key, status)
# or (dedupe_key, status, detail) with status done, rejected or transient.
Handler = Callable[[DataFrame], DataFrame]

SETTLED = ("done", "rejected")
# Marks rows of the source that only drives batches.
TICK = "_tick"
_STATE = T.StructType(
    [
        T.StructField("dedupe_key", T.StringType()),
        T.StructField("task_id", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("detail", T.StringType()),
        T.StructField("attempts", T.LongType()),
        T.StructField("deliveries", T.LongType()),
        T.StructField("handled_at", T.TimestampType()),
        T.StructField("due_at", T.TimestampType()),
        T.StructField("task", TASK_SCHEMA_TYPE),
    ]
)
_OUTCOME = "dedupe_key string, status string, detail string"
_COUNTS = T.StructType([T.StructField(n, T.LongType()) for n in ("pulled", "acked", "nacked", "rejected")])
_RECEIVED = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("task", TASK_SCHEMA_TYPE),
    ]
)


def accept(tasks: DataFrame) -> DataFrame:
    """Intake of files: valid is enough, the queue item is written by the intake itself."""
    return tasks.select("dedupe_key", F.lit("done").alias("status"))


def by_response(responses: DataFrame) -> Handler:
    """Deliver links against a table of responses ``(dedupe_key, status_code, ok, error_type)``."""

    def handle(tasks: DataFrame) -> DataFrame:
        status = delivery_outcome(F.col("status_code"), F.col("ok"), F.col("error_type"))
        return tasks.join(responses, "dedupe_key", "left").select("dedupe_key", status.alias("status"))

    return handle


def by_call(deliver: Callable[[dict], str]) -> Handler:
    """Hand each task as a dict to a callable that returns a status; its exception is a failed attempt of that task."""

    @F.pandas_udf("status string, detail string")
    def call(tasks: pd.Series) -> pd.DataFrame:
        rows = []
        for task in tasks:
            try:
                rows.append((deliver(json.loads(task)), None))
            except Exception as exc:  # noqa: BLE001 - a failed task is an attempt, not the end of the batch
                rows.append(("transient", str(exc)))
        return pd.DataFrame(rows, columns=["status", "detail"])

    def handle(tasks: DataFrame) -> DataFrame:
        called = tasks.withColumn("_called", call(F.to_json(F.struct(*tasks.columns))))
        return called.select("dedupe_key", "_called.status", "_called.detail")

    return handle


def file_handlers() -> dict[str, Handler]:
    return {t: accept for t in FILE_TASKS}


def write_outcome(handlers: Mapping[str, Handler], tasks: DataFrame, kind: str, path: str) -> None:
    """Write what the type's handler says about its tasks; if it fails, that they are to be tried again."""
    keys = tasks.select("dedupe_key")
    said = lambda status, detail: keys.withColumns({"status": F.lit(status), "detail": F.lit(detail).cast("string")})
    if kind not in handlers:
        said("rejected", "unknown_type").write.mode("overwrite").parquet(path)
        return
    try:
        done = handlers[kind](tasks.select(*TASK_SCHEMA_TYPE.names))
        if "detail" not in done.columns:
            done = done.withColumn("detail", F.lit(None).cast("string"))
        done = done.groupBy("dedupe_key").agg(F.min("status").alias("status"), F.min("detail").alias("detail"))
        done.write.mode("overwrite").parquet(path)
    except Exception as exc:  # noqa: BLE001 - any failure of a handler is an attempt
        said("transient", f"{type(exc).__name__}: {exc}".splitlines()[0]).write.mode("overwrite").parquet(path)


@dataclass
class Intake:
    """Micro-batch body over one state folder.

    A batch takes the tasks that arrived and those whose retry is due. Per batch number N it writes, each replaced when N
    is retried: ``received``, ``open`` (what is to be handled), ``outcome`` (what the handlers said), ``queue``, ``state``
    and last ``counters``. Handlers run once, when the outcome is written; queue and state are made from it. A handler that fails
    counts as an attempt of its tasks and stops neither the batch nor other types. Only done and rejected identities are
    skipped; a failed one is handled again when it is delivered again. State older than the retention is forgotten.
    """

    root: str
    handlers: Mapping[str, Handler]
    max_attempts: int = MAX_ATTEMPTS
    state: VersionedState = field(init=False)

    def __post_init__(self):
        self.state = VersionedState(f"{self.root}/state", _STATE, ("dedupe_key",))

    def _read(self, spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
        full = T.StructType([*schema.fields, T.StructField("version", T.LongType())])
        try:
            return spark.read.schema(full).parquet(f"{self.root}/{name}")
        except AnalysisException as exc:
            if exc.getCondition() == "PATH_NOT_FOUND":
                return spark.createDataFrame([], full)
            raise

    def received(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "received", _RECEIVED)

    def quarantine(self, spark: SparkSession) -> DataFrame:
        return self.received(spark).filter("reason IS NOT NULL").select("value", "reason", "version")

    def queue(self, spark: SparkSession) -> DataFrame:
        """Queue items, the newest per content hash."""
        items = spark.read.parquet(f"{self.root}/queue")
        rest = [c for c in items.columns if c not in ("sha256", "version")]
        newest = items.groupBy("sha256").agg(F.max_by(F.struct(*rest), "version").alias("i"))
        return newest.select("sha256", "i.*")

    def dead_letters(self, spark: SparkSession) -> DataFrame:
        return self.state.read(spark).filter("status = 'failed'")

    def process(self, messages: DataFrame, batch_id: int, now: datetime | None = None) -> None:
        spark = messages.sparkSession
        clock = F.lit(now or datetime.now(timezone.utc)).cast("timestamp")
        if TICK in messages.columns:
            messages = messages.filter(~F.col(TICK))
        if batch_id and batch_id % FOLD_EVERY == 0:
            self.state.fold(spark, batch_id, F.col("handled_at") >= clock - F.expr(f"INTERVAL {RETENTION_DAYS} DAYS"))
        folder = lambda name: f"{self.root}/{name}/version={batch_id}"
        checked = check_messages(messages.select("value")).select("value", "reason", "task")
        checked.write.mode("overwrite").parquet(folder("received"))
        fresh = spark.read.schema(_RECEIVED).parquet(folder("received")).filter("reason IS NULL").select("task.*")
        waiting = self.state.read(spark, batch_id).filter((F.col("status") == "retry") & (F.col("due_at") <= clock))

        names = TASK_SCHEMA_TYPE.names
        first = F.min_by(F.struct(*names), F.struct("created_at", "task_id"))
        once = fresh.unionByName(waiting.select("task.*")).groupBy("dedupe_key")
        once = once.agg(first.alias("t"), F.count(F.lit(1)).alias("deliveries")).select("t.*", "deliveries")
        prior = self.state.read(spark, batch_id, only=once).select(
            "dedupe_key", F.col("status").alias("_known"), F.coalesce("attempts", F.lit(0)).alias("_before")
        )
        unsettled = once.join(prior, "dedupe_key", "left").filter(~F.coalesce(F.col("_known").isin(*SETTLED), F.lit(False)))
        unsettled.drop("_known").write.mode("overwrite").parquet(folder("open"))
        open_tasks = spark.read.parquet(folder("open"))
        for (kind,) in open_tasks.select("type").distinct().collect():  # the contract knows a handful
            write_outcome(self.handlers, open_tasks.filter(F.col("type") == kind), kind, f"{folder('outcome')}/kind={kind}")

        try:
            outcome = spark.read.schema(_OUTCOME).parquet(folder("outcome"))
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            outcome = spark.createDataFrame([], _OUTCOME)
        rows = open_tasks.join(outcome.select("dedupe_key", "status", "detail"), "dedupe_key", "left")
        settled = F.coalesce(F.col("status").isin(*SETTLED), F.lit(False))
        before = F.coalesce("_before", F.lit(0))
        rows = rows.withColumns({"attempts": F.when(settled, before).otherwise(before + F.col("deliveries")), "_settled": settled})
        exhausted = ~F.col("_settled") & (F.col("attempts") >= self.max_attempts)
        shortest, longest = RETRY_SECONDS
        delay = F.least(F.lit(longest), F.lit(shortest) * F.pow(F.lit(2), F.col("attempts") - 1)).cast("long")
        status = F.when(F.col("_settled"), F.col("status")).when(exhausted, F.lit("failed")).otherwise(F.lit("retry"))
        rows = rows.withColumns(
            {
                "status": status,
                "detail": F.when(exhausted, F.lit("max_attempts")).otherwise(F.col("detail")),
                "handled_at": clock,
                "due_at": F.when(~F.col("_settled") & ~exhausted, F.timestamp_seconds(F.unix_timestamp(clock) + delay)),
                "task": F.struct(*names),
            }
        )
        # Queue items are stamped with the task's own time, so a retry writes the same rows.
        queued = queue_items(rows.filter("status = 'done'"), F.col("created_at").try_cast("timestamp"))
        queued.write.mode("overwrite").parquet(folder("queue"))
        self.state.write(rows, batch_id, replace=True)
        self._count(spark, batch_id).write.mode("overwrite").parquet(folder("counters"))

    def _count(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """What became of the messages of one batch, from the batch's own files."""
        arrived = self.received(spark).where(F.col("version") == batch_id).select("reason", "task.dedupe_key")
        results = self.state._all(spark).where(F.col("version") == batch_id).select("dedupe_key", "status")
        rows = arrived.join(results, "dedupe_key", "left")
        returned = F.coalesce(F.col("status").isin("retry", "failed"), F.lit(False))
        refused = F.col("reason").isNotNull() | F.coalesce(F.col("status") == "rejected", F.lit(False))
        return rows.agg(
            F.count(F.lit(1)).alias("pulled"),
            F.count_if(~returned).alias("acked"),
            F.count_if(returned).alias("nacked"),
            F.count_if(refused).alias("rejected"),
        )

    def counters(self, spark: SparkSession) -> DataFrame:
        """Per batch: messages pulled, acknowledged, returned for retry, and rejected, one row as each batch left it."""
        return self._read(spark, "counters", _COUNTS)


def start_intake(
    messages: DataFrame, intake: Intake, checkpoint: str, available_now: bool = True, heartbeats: str | None = None
) -> StreamingQuery:
    """Offsets move on only after a batch is completely written; then its heartbeat is, if there is a folder for them.

    A query that keeps running is also driven by ticks, so that retries come due when no message arrives.
    """
    if not available_now:
        ticks = messages.sparkSession.readStream.format("rate").load().select(F.lit(None).cast("string").alias("value"), F.lit(True).alias(TICK))
        messages = messages.select("value", F.lit(False).alias(TICK)).unionByName(ticks)

    def process(batch: DataFrame, batch_id: int) -> None:
        now = datetime.now(timezone.utc)
        intake.process(batch, batch_id, now)
        if heartbeats:
            beat = heartbeat_rows("intake", batch, now)
            beat.write.mode("overwrite").json(f"{heartbeats}/component=intake/batch={batch_id}")

    writer = messages.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")).start()


def first_deliveries(tasks: DataFrame, event_time: str, days: int = RETENTION_DAYS) -> DataFrame:
    """First delivery of each identity within the retention window of the queue.

    For sources that never deliver a task again after a failure; with retries use
    ``Intake``, which looks at what became of the task.
    """
    marked = tasks.withWatermark(event_time, f"{days} days")
    return marked.dropDuplicatesWithinWatermark(["dedupe_key"])
