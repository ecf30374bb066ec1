"""Deterministic ids, fingerprints and JSON access."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagetrail.constants import LINK_TASK
from stagetrail.functions.text import strip
from stagetrail.functions.times import iso_utc

FINGERPRINT_COLUMNS = (
    "cv_version",
    "event_id",
    "event_type",
    "job_id",
    "keywords",
    "payload",
    "source_type",
    "title_family",
    "ts",
)


def event_id(job_id: Column, event_type: Column, ts: Column) -> Column:
    """sha256 of ``job|type|instant``; NULL when a part is NULL."""
    return F.sha2(F.concat(job_id, F.lit("|"), event_type, F.lit("|"), iso_utc(ts)), 256)


def strict_json(text: Column) -> Column:
    """Variant of a text that is one JSON value and nothing else, else NULL.

    The parser stops after the first value. Inside brackets whatever follows it is
    an error, unless it starts with a bracket itself, which braces then show.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    alone = F.try_variant_get(listed, "$[1]", "variant").isNull()
    braced = F.try_parse_json(F.concat(F.lit('{"x":'), text, F.lit("}")))
    return F.when(alone & (~F.contains(text, F.lit("]")) | braced.isNotNull()), F.try_variant_get(listed, "$[0]", "variant"))


def is_variant(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.VariantType)


def json_text(df: DataFrame, name: str) -> Column:
    """Canonical (key-sorted) JSON text of a variant or JSON-string column."""
    col = df[name]
    return F.to_json(col if is_variant(df, name) else F.try_parse_json(col))


def json_field(df: DataFrame, name: str, key: str) -> Column:
    """Top-level scalar of a JSON column as text."""
    if is_variant(df, name):
        return F.try_variant_get(df[name], f"$.{key}", "string")
    return F.get_json_object(df[name], f"$.{key}")


def fingerprint(df: DataFrame, payload_json: Column | None = None) -> Column:
    """sha256 over the nine content columns; the export stamp is not part of it.

    ``payload_json`` is the payload's ``json_text``, if rows share it and it was made once for them.
    """
    parts = []
    for name in FINGERPRINT_COLUMNS:
        col = df[name]
        if name == "payload":
            col = F.coalesce(json_text(df, name) if payload_json is None else payload_json, F.lit("{}"))
        elif name == "keywords":
            col = F.coalesce(col, F.array().cast("array<string>"))
        elif name == "ts" and not isinstance(df.schema[name].dataType, T.StringType):
            col = iso_utc(col)
        parts.append(col.alias(name))
    return F.sha2(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}), 256)


def normalize_url(url: Column) -> Column:
    return F.rtrim(strip(url), F.lit("/"))


def dedupe_key(task_type: Column, source: Column, url: Column, sha256: Column) -> Column:
    """Identity of a task: its URL for links, its content hash for files."""
    text = F.when(task_type == LINK_TASK, F.concat(F.lit("url|"), normalize_url(F.coalesce(url, F.lit(""))))).otherwise(
        F.concat(F.lit("sha256|"), F.coalesce(sha256, F.lit("")))
    )
    return F.sha2(F.concat(source, F.lit("|"), text), 256)
