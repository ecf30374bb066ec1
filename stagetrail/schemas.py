"""Declared schemas."""

from __future__ import annotations

from pyspark.sql import types as T

_S = T.StringType()

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", _S, False),
        T.StructField("job_id", _S),
        T.StructField("event_type", _S),
        T.StructField("ts", T.TimestampType()),
        T.StructField("cv_version", _S),
        T.StructField("title_family", _S),
        T.StructField("keywords", T.ArrayType(_S)),
        T.StructField("source_type", _S),
        T.StructField("payload", T.VariantType()),
        T.StructField("exported_at", T.TimestampType()),
    ]
)
EVENT_COLUMNS = tuple(EVENT_SCHEMA.fieldNames())
EVENT_TABLE_SCHEMA = T.StructType([*EVENT_SCHEMA.fields, T.StructField("event_date", T.DateType())])

FIRST_SEEN_SCHEMA = T.StructType(
    [T.StructField("job_id", _S), T.StructField("bucket", _S), T.StructField("ts", T.TimestampType())]
)
FINGERPRINT_SCHEMA = T.StructType([T.StructField("event_id", _S), T.StructField("fingerprint", _S)])
OUTCOME_SCHEMA = T.StructType(
    [T.StructField("job_id", _S), T.StructField("event_type", _S), T.StructField("ts", _S)]
)

# Text columns a job row may carry; anything else in a snapshot is never read.
JOB_TEXT_COLUMNS = (
    "job_id",
    "id",
    "title",
    "company",
    "location",
    "status",
    "created_at_utc",
    "found_at_utc",
    "added_at_utc",
    "sent_at_utc",
    "form_submitted_at_utc",
    "email_sent_at_utc",
    "draft_created_at_utc",
    "reply_seen_at_utc",
    "cv_basename",
    "cv_pdf",
    "cv_docx",
    "cv_path",
    "source_url",
    "url",
    "source_type",
    "mime",
    "origin",
    "application_type",
)

TASK_PAYLOAD_SCHEMA = T.StructType(
    [T.StructField(n, _S) for n in ("url", "file_id", "version", "text", "sha256", "mime")]
)
TASK_SCHEMA_TYPE = T.StructType(
    [
        T.StructField("schema", _S),
        T.StructField("task_id", _S),
        T.StructField("type", _S),
        T.StructField("source", _S),
        T.StructField("payload", TASK_PAYLOAD_SCHEMA),
        T.StructField("dedupe_key", _S),
        T.StructField("created_at", _S),
    ]
)

_ENTITY = T.ArrayType(
    T.StructType(
        [
            T.StructField("type", _S),
            T.StructField("offset", T.IntegerType()),
            T.StructField("length", T.IntegerType()),
            T.StructField("url", _S),
        ]
    )
)
CHAT_MESSAGE = T.StructType(
    [
        T.StructField("chat", T.StructType([T.StructField("id", T.LongType())])),
        T.StructField("text", _S),
        T.StructField("caption", _S),
        T.StructField("entities", _ENTITY),
        T.StructField("caption_entities", _ENTITY),
        T.StructField("photo", T.VariantType()),
        T.StructField("document", T.VariantType()),
    ]
)
CHAT_UPDATE_SCHEMA = T.StructType(
    [
        T.StructField("update_id", T.LongType()),
        T.StructField("message", CHAT_MESSAGE),
        T.StructField("edited_message", CHAT_MESSAGE),
    ]
)

LABELLED_COLUMNS = (
    "ad_id",
    "image_file",
    "title",
    "company",
    "requirements",
    "location",
    "contact",
    "language",
    "notes",
)
