"""Task messages: build, decode, validate, quarantine."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagetrail import constants as C
from stagetrail.functions.identity import dedupe_key, normalize_url, strict_json
from stagetrail.functions.text import computed_once
from stagetrail.functions.times import iso_utc
from stagetrail.operators.json_contract import Contract
from stagetrail.schemas import TASK_PAYLOAD_SCHEMA, TASK_SCHEMA_TYPE
from stagetrail.sources.messages import encode_tasks, message_text


@dataclass(frozen=True)
class Split:
    valid: DataFrame
    quarantine: DataFrame


def build_tasks(rows: DataFrame, task_type: str | Column, source: str | Column, created_at: datetime) -> DataFrame:
    """Rows with any of the payload columns to unvalidated task rows.

    ``task_id`` is random, so write the result once and read it back; only
    ``dedupe_key`` is stable and nothing should be keyed on the id.
    """
    kind = F.lit(task_type) if isinstance(task_type, str) else task_type
    origin = F.lit(source) if isinstance(source, str) else source
    cell = lambda n: F.col(n) if n in rows.columns else F.lit(None).cast("string")
    fields = {n: cell(n) for n in C.TASK_PAYLOAD_KEYS}
    fields["url"] = F.when(fields["url"] != "", normalize_url(fields["url"])).otherwise(fields["url"])
    payload = F.struct(*[c.alias(n) for n, c in fields.items()])
    return rows.select(
        F.lit(C.TASK_SCHEMA).alias("schema"),
        F.uuid().alias("task_id"),
        kind.alias("type"),
        origin.alias("source"),
        payload.alias("payload"),
        dedupe_key(kind, origin, fields["url"], fields["sha256"]).alias("dedupe_key"),
        F.lit(iso_text(created_at)).alias("created_at"),
    )


def iso_text(instant: datetime) -> str:
    return instant.strftime("%Y-%m-%dT%H:%M:%SZ")


def task_contract() -> dict:
    """The schema of task messages, for those who do not read a document of their own."""
    text = {"type": "string"}
    optional = {"type": ["string", "null"]}
    hashed = {"pattern": C.SHA256_PATTERN}
    sized = {n: optional | {"maxLength": most} for n, most in C.TASK_MAX_LENGTHS.items()}
    payload = sized | {
        "url": sized["url"] | {"pattern": C.TASK_URL_PATTERN},
        "sha256": optional | hashed,
        "mime": optional | {"enum": [None, *C.TASK_MIMES]},
    }
    link = {"source": {"const": C.LINK_SOURCE}, "payload": {"properties": {"url": text}}}
    file = {"payload": {"properties": {"file_id": text, "sha256": text}, "required": ["sha256"]}}
    return {
        "type": "object",
        "additionalProperties": False,
        "required": list(C.TASK_KEYS),
        "properties": {
            "schema": {"const": C.TASK_SCHEMA},
            "task_id": text | {"pattern": C.TASK_ID_PATTERN},
            "type": {"enum": list(C.TASK_TYPES)},
            "source": {"enum": list(C.TASK_SOURCES)},
            "payload": {"type": "object", "additionalProperties": False, "required": list(C.TASK_PAYLOAD_REQUIRED), "properties": payload},
            "dedupe_key": text | hashed,
            "created_at": text | {"format": "date-time", "maxLength": C.CREATED_AT_MAX},
        },
        "allOf": [
            {"if": {"properties": {"type": {"const": C.LINK_TASK}}}, "then": {"properties": link}},
            {"if": {"properties": {"type": {"enum": list(C.FILE_TASKS)}}}, "then": {"properties": file}},
        ],
    }


def check_messages(messages: DataFrame, value: str = "value", schema: Mapping | None = None) -> DataFrame:
    """Add ``task`` (typed, NULL when invalid) and ``reason`` (first broken rule, NULL when valid).

    The rules are compiled from ``schema``, a JSON Schema document as ``load_contract`` reads it; a message that keeps all
    of them must also carry the key of its own payload.
    """
    contract = Contract(schema or task_contract())
    texts = messages.withColumn("_message", message_text(messages[value]))
    parsed = contract.read_members(texts.withColumn("doc", strict_json(F.col("_message"))))
    own_key = dedupe_key(*[contract.text(*path) for path in (("type",), ("source",), ("payload", "url"), ("payload", "sha256"))])
    foreign = F.when(contract.text("dedupe_key") != own_key, F.lit("dedupe_key: does not match payload identity"))
    first = F.coalesce(F.when(F.col("doc").isNull(), F.lit("not json")), contract.first_error(), foreign)
    reasoned = parsed.withColumn("reason", first)
    payload = F.struct(*[contract.text("payload", n).alias(n) for n in TASK_PAYLOAD_SCHEMA.names]).alias("payload")
    members = [payload if n == "payload" else contract.text(n).alias(n) for n in TASK_SCHEMA_TYPE.names]
    task = F.when(F.col("reason").isNull(), F.struct(*members)).alias("task")
    return computed_once(reasoned.select(*messages.columns, "reason", task), "reason", "task")


def split_messages(messages: DataFrame, value: str = "value", schema: Mapping | None = None) -> Split:
    """Valid tasks, and the raw rest with the reason."""
    checked = check_messages(messages, value, schema)
    valid = checked.filter("reason IS NULL").select("task.*", *[c for c in messages.columns if c != value])
    return Split(valid, checked.filter("reason IS NOT NULL").drop("task"))


def validate_tasks(tasks: DataFrame) -> Split:
    """The same check for rows that are tasks already."""
    return split_messages(encode_tasks(tasks))


def queue_items(tasks: DataFrame, queued_at: Column) -> DataFrame:
    """File tasks as extraction queue items, one per content hash."""
    return tasks.filter(F.col("type").isin(*C.FILE_TASKS)).select(
        "task_id",
        F.col("payload.file_id").alias("file_id"),
        F.coalesce("payload.sha256", F.lit("")).alias("sha256"),
        F.col("payload.mime").alias("mime"),
        iso_utc(queued_at).alias("queued_at"),
    )


def delivery_outcome(status_code: Column, ok: Column, error_type: Column) -> Column:
    """Response of a link delivery to ``done``, ``rejected`` or ``transient``.

    No status code means no connection; a missing ``ok`` means the body was not readable.
    """
    transient = (
        status_code.isNull()
        | (status_code >= 500)
        | status_code.isin(*C.TRANSIENT_CODES)
        | ok.isNull()
        | (~ok & (F.coalesce(error_type, F.lit("")) == C.TRANSIENT_ERROR))
    )
    return F.when(transient, F.lit("transient")).when(ok, F.lit("done")).otherwise(F.lit("rejected"))
