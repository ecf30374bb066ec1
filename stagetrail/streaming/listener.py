"""Chat updates to link tasks, as a stream."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stagetrail.constants import LINK_TASK, TASK_MAX_LENGTHS
from stagetrail.operators.contracts import build_tasks, check_messages
from stagetrail.operators.safety import intake_links
from stagetrail.sources.messages import encode_tasks


def link_messages(updates: DataFrame, allowed_chats: DataFrame | Sequence[int], created_at: datetime) -> DataFrame:
    """Encoded link tasks of the acceptable updates; what the contract refuses is left out."""
    links = intake_links(updates, allowed_chats, TASK_MAX_LENGTHS["text"]).drop("truncated")
    tasks = build_tasks(links, LINK_TASK, "telegram", created_at)
    return check_messages(encode_tasks(tasks)).filter("reason IS NULL").select("value")


def start_listener(
    updates: DataFrame,
    allowed_chats: Sequence[int],
    out: str,
    checkpoint: str,
    available_now: bool = True,
    heartbeats: str | None = None,
) -> StreamingQuery:
    """Publish tasks as line files, one folder per batch, and a heartbeat per batch if there is a folder for them.

    The checkpoint moves past an update only after its task is written; a failed
    write stops the batch and it is repeated whole.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        now = datetime.now(timezone.utc)
        link_messages(batch, allowed_chats, now).write.mode("overwrite").text(f"{out}/batch={batch_id}")
        if heartbeats:
            heartbeat_rows("listener", batch, now).write.mode("overwrite").json(f"{heartbeats}/component=listener/batch={batch_id}")

    writer = updates.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="5 seconds")).start()


def heartbeat_rows(component: str, batch: DataFrame, now: datetime) -> DataFrame:
    """Heartbeat of a component with the size of its batch."""
    counted = batch.agg(F.count(F.lit(1)).alias("updates"))
    return counted.select(F.lit(component).alias("component"), F.lit(now.strftime("%Y-%m-%dT%H:%M:%SZ")).alias("utc"), "updates")
