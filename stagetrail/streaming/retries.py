"""Task intake with keyed state: retries are timers, what is settled expires by itself.

The state store keeps one entry for an identity and its timer. A batch opens the entries of keys that arrived or came due,
so its cost does not grow with the identities that wait or are settled. ``Intake`` answers the same questions from tables.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from stagetrail.constants import MAX_ATTEMPTS, RETENTION_DAYS, RETRY_SECONDS
from stagetrail.operators.contracts import check_messages
from stagetrail.schemas import TASK_SCHEMA_TYPE
from stagetrail.streaming.intake import SETTLED, Handler, write_outcome

OUTCOME = "dedupe_key string, status string, detail string, attempt long"
ACTION = "dedupe_key string, action string, attempt long, attempts long, task string, detail string"
_ACTION = Row(*[c.split()[0] for c in ACTION.split(", ")])
_ENTRY = "status string, attempt bigint, attempts bigint, deliveries bigint, task string"
_DAY_MS = 24 * 3600 * 1000
#: Entry and timers are column families of their own, which only this state store has.
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Retries(StatefulProcessor):
    """What became of one identity, and when it is to be tried again.

    Rows come and go one by one, not as a frame an identity, and each answer of the state store is asked for once: with
    few rows an identity, both would cost far more than what is decided here.
    """

    def __init__(self, max_attempts: int, delays: tuple[float, float], retention_ms: int):
        self.max_attempts, self.delays, self.retention_ms = max_attempts, delays, retention_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entry = handle.getValueState("entry", _ENTRY, self.retention_ms)

    def _hand_out(self, key: str, attempt: int, attempts: int, deliveries: int, task: str) -> Row:
        self.entry.update(("open", attempt + 1, attempts, deliveries, task))
        return _ACTION(key, "handle", attempt + 1, attempts, task, None)

    def _said(self, key: str, entry: tuple, status: str, detail: str | None, now: int) -> tuple[tuple, Row | None]:
        """The entry after an outcome, and what is to be said about it."""
        _, attempt, attempts, deliveries, task = entry
        if status in SETTLED:
            return (status, attempt, attempts, 0, None), _ACTION(key, status, attempt, attempts, task, detail)
        attempts += deliveries
        if attempts >= self.max_attempts:
            return ("failed", attempt, attempts, 0, None), _ACTION(key, "failed", attempt, attempts, task, "max_attempts")
        shortest, longest = self.delays
        self.handle.registerTimer(now + int(1000 * min(longest, shortest * 2 ** (attempts - 1))))
        return ("retry", attempt, attempts, 1, task), None

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        outcomes, deliveries, first, entry = [], 0, None, None
        for row in rows:
            if row["kind"] == "invalid":
                yield _ACTION(key[0], "quarantined", 0, 0, row["task"], row["detail"])
            elif row["kind"] == "outcome":
                outcomes.append((row["attempt"], row["status"], row["detail"]))
            else:
                # The first issue of a task, as in a batch of deliveries.
                issue = [(v is None, v or "") for v in (row["created_at"], row["task_id"])]
                first = (issue, row["task"]) if not deliveries or issue < first[0] else first
                deliveries += 1
        if outcomes or deliveries:
            entry = self.entry.get()
        for attempt, status, detail in outcomes:
            # An outcome counts once: that of an attempt which is not open is a repeat of a batch.
            if entry is not None and entry[0] == "open" and entry[1] == attempt:
                entry, said = self._said(key[0], entry, status, detail, timerValues.getCurrentProcessingTimeInMs())
                self.entry.update(entry)
                if said is not None:
                    yield said
        if deliveries:
            status, attempt, attempts, open_ones, task = entry if entry is not None else (None, 0, 0, 0, None)
            if status in SETTLED:
                yield _ACTION(key[0], "known", attempt, attempts, None, status)
            elif status == "open":
                self.entry.update((status, attempt, attempts, open_ones + deliveries, task))
            else:
                if status == "retry":  # it does not wait any longer
                    for at in list(self.handle.listTimers()):
                        self.handle.deleteTimer(at)
                yield self._hand_out(key[0], attempt, attempts, deliveries, first[1])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        entry = self.entry.get()
        if entry is not None and entry[0] == "retry":
            _, attempt, attempts, deliveries, task = entry
            yield self._hand_out(key[0], attempt, attempts, deliveries, task)

    def close(self) -> None:
        pass


@dataclass
class TimedIntake:
    """Intake below ``root``: ``actions`` of each batch, and ``outcomes``, which the query reads again as a stream.

    Every delivery of an identity that fails counts as an attempt; after ``max_attempts`` it is failed, and handled again
    only if it is delivered again. In between it waits ``delays[0]`` seconds, twice as long each time, ``delays[1]`` at
    most. A settled identity is remembered for the retention from its last change.
    """

    root: str
    handlers: Mapping[str, Handler]
    max_attempts: int = MAX_ATTEMPTS
    delays: tuple[float, float] = RETRY_SECONDS
    retention_days: float = RETENTION_DAYS

    def rows(self, messages: DataFrame) -> DataFrame:
        """Keyed input of the state: valid tasks, invalid messages under their own hash, and outcomes so far."""
        nothing = {n: F.lit(None).cast(t) for n, t in (("status", "string"), ("detail", "string"), ("attempt", "long"))}
        checked = check_messages(messages.select("value")).withColumns(nothing)
        keyed = checked.select(
            F.coalesce("task.dedupe_key", F.sha2(F.coalesce(F.col("value").cast("string"), F.lit("")), 256)).alias("dedupe_key"),
            F.when(F.col("reason").isNull(), "task").otherwise("invalid").alias("kind"),
            F.coalesce(F.to_json("task"), F.col("value").cast("string")).alias("task"),
            F.col("task.created_at").alias("created_at"),
            F.col("task.task_id").alias("task_id"),
            "status",
            F.col("reason").alias("detail"),
            "attempt",
        )
        spark = messages.sparkSession
        # The folder is there before the first outcome, so that the stream can be planned.
        spark.createDataFrame([], OUTCOME).write.mode("append").parquet(f"{self.root}/outcomes/none")
        source = spark.readStream.schema(OUTCOME).option("recursiveFileLookup", "true").parquet(f"{self.root}/outcomes")
        missing = {n: F.lit(None).cast("string") for n in ("task", "created_at", "task_id")}
        said = source.withColumns({"kind": F.lit("outcome"), **missing}).select(*keyed.columns)
        return keyed.unionByName(said)

    def start(self, messages: DataFrame, checkpoint: str, seconds: float = 10) -> StreamingQuery:
        processor = _Retries(self.max_attempts, self.delays, int(self.retention_days * _DAY_MS))
        acted = self.rows(messages).groupBy("dedupe_key").transformWithState(
            statefulProcessor=processor, outputStructType=ACTION, outputMode="Update", timeMode="ProcessingTime"
        )
        writer = acted.writeStream.outputMode("update").foreachBatch(self._act).option("checkpointLocation", checkpoint)
        conf = messages.sparkSession.conf
        before = conf.get(_PROVIDER, None)
        # The query takes the session's settings over as it starts; other queries keep their own store.
        conf.set(_PROVIDER, _ROCKSDB)
        try:
            return writer.trigger(processingTime=f"{int(seconds * 1000)} milliseconds").start()
        finally:
            if before is None:
                conf.unset(_PROVIDER)
            else:
                conf.set(_PROVIDER, before)

    def _act(self, actions: DataFrame, batch_id: int) -> None:
        """Write the batch's actions, and what the handlers say about tasks handed out; a repeated batch replaces both."""
        spark, folder = actions.sparkSession, f"{self.root}/actions/batch={batch_id}"
        actions.write.mode("overwrite").parquet(folder)
        asked = spark.read.schema(ACTION).parquet(folder).where("action = 'handle'")
        tasks = asked.select(F.from_json("task", TASK_SCHEMA_TYPE).alias("t"), "attempt").select("t.*", "attempt")
        for (kind,) in tasks.select("type").distinct().collect():  # the contract knows a handful
            raw = f"{self.root}/said/batch={batch_id}/kind={kind}"
            own = tasks.where(F.col("type") == kind)
            write_outcome(self.handlers, own.select(*TASK_SCHEMA_TYPE.names), kind, raw)
            said = spark.read.schema("dedupe_key string, status string, detail string").parquet(raw)
            # A task about which the handler said nothing is tried again.
            rows = own.select("dedupe_key", "attempt").join(said, "dedupe_key", "left")
            rows = rows.withColumn("status", F.coalesce("status", F.lit("transient"))).select("dedupe_key", "status", "detail", "attempt")
            rows.write.mode("overwrite").parquet(f"{self.root}/outcomes/batch={batch_id}/kind={kind}")

    def actions(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"{ACTION}, batch long").parquet(f"{self.root}/actions")

    def results(self, spark: SparkSession) -> DataFrame:
        """(dedupe_key, action, attempts, detail): identities that are settled or given up, by their last batch."""
        ended = self.actions(spark).where(F.col("action").isin(*SETTLED, "failed"))
        last = ended.groupBy("dedupe_key").agg(F.max_by(F.struct("action", "attempts", "detail"), "batch").alias("l"))
        return last.select("dedupe_key", "l.*")

    def drain(self, spark: SparkSession, query: StreamingQuery, seconds: float) -> bool:
        """Wait until nothing that was handed out is open or waits for a retry; false if the time is over before."""
        until, quiet = time.time() + seconds, None
        while query.isActive and time.time() < until:
            # The batch that a stop cut short is repeated first, so two batches without input must follow one another.
            last = query.lastProgress
            if last is None or last.numInputRows:
                quiet = None
            elif quiet is None:
                quiet = last.batchId
            elif last.batchId > quiet + 1:
                handed, ended = self.actions(spark).where("action = 'handle'"), self.results(spark)
                if handed.select("dedupe_key").distinct().join(ended, "dedupe_key", "left_anti").isEmpty():
                    return True
            time.sleep(0.5)
        if query.exception() is not None:
            raise query.exception()
        return False
