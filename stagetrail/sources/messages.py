"""Task messages, chat updates, labelled rows, reports."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagetrail.constants import FILE_VERSION_CHARS, MIME_BY_SUFFIX, SKIP_FOLDERS
from stagetrail.schemas import CHAT_UPDATE_SCHEMA, LABELLED_COLUMNS

_TEXT_LINE = T.StructType([T.StructField("value", T.StringType())])


def message_text(data: Column) -> Column:
    """Message bytes as text, NULL when they are not UTF-8."""
    return F.try_validate_utf8(data.cast("string"))


def encode_tasks(tasks: DataFrame) -> DataFrame:
    """One compact JSON message per task, every key kept."""
    columns = ("schema", "task_id", "type", "source", "payload", "dedupe_key", "created_at")
    return tasks.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value"))


def read_messages(spark: SparkSession, path: str, streaming: bool = False, files_per_trigger: int = 1000) -> DataFrame:
    """Line-delimited task messages, as a batch or as a stream."""
    if streaming:
        return spark.readStream.schema(_TEXT_LINE).option("maxFilesPerTrigger", files_per_trigger).text(path)
    return spark.read.schema(_TEXT_LINE).text(path)


def read_chat_updates(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return reader.schema(CHAT_UPDATE_SCHEMA).json(path)


def read_labelled(spark: SparkSession, path: str) -> DataFrame:
    """Labelled rows; a byte-order mark before the first header is tolerated."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    named = raw.toDF(*[c.lstrip("﻿") for c in raw.columns])
    cells = [(F.col(n) if n in named.columns else F.lit(None).cast("string")).alias(n) for n in LABELLED_COLUMNS]
    return named.select(*cells).filter(F.coalesce(F.col("image_file"), F.lit("")) != "")


def write_report(report: DataFrame, path: str) -> None:
    """A report as one JSON file; only its rows meet in one task, not the work behind them."""
    report.repartition(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def suffix_mime(path: Column) -> Column:
    suffix = F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))
    pairs = [F.lit(x) for kv in MIME_BY_SUFFIX.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), suffix)


def wanted_file(relative_path: Column) -> Column:
    """Allowed suffix, not a temporary name, not below a skip folder."""
    parts = F.split(relative_path, "/")
    name = F.element_at(parts, -1)
    lowered = F.lower(name)
    temporary = (
        (lowered == "desktop.ini")
        | F.startswith(name, F.lit("~$"))
        | F.endswith(lowered, F.lit(".tmp"))
        | F.endswith(lowered, F.lit(".partial"))
    )
    skipped = F.arrays_overlap(parts, F.array(*[F.lit(d) for d in SKIP_FOLDERS]))
    return suffix_mime(relative_path).isNotNull() & ~temporary & ~skipped


def _files(spark: SparkSession, root: str, suffixes: Sequence[str]) -> DataFrame:
    """Files below a folder; the suffix filter is given to the file source, so others are never opened."""
    letters = ["".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in s) for s in suffixes]
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*{" + ",".join(letters) + "}")
        .load(root)
    )
    below = F.substr(_plain_path(), F.lit(len(root.rstrip("/")) + 2))
    return files.filter(wanted_file(below))


def _plain_path() -> Column:
    return F.regexp_replace("path", r"^[a-z0-9+.-]+:/+", "/")


def read_listing(spark: SparkSession, root: str, suffixes: Sequence[str] = tuple(MIME_BY_SUFFIX)) -> DataFrame:
    """Inbox files as ``(path, size, mtime)``; no file is opened."""
    return _files(spark, root, suffixes).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("mtime"))


def read_inbox(
    spark: SparkSession,
    root: str,
    bus_root: str,
    suffixes: Sequence[str] = tuple(MIME_BY_SUFFIX),
    since: datetime | None = None,
) -> DataFrame:
    """Inbox files as ``(path, file_id, sha256, version, mime, length, modificationTime)``.

    ``since`` bounds the modification time, in the file source as well.
    """
    files = _files(spark, root, suffixes)
    if since is not None:
        files = files.filter(F.col("modificationTime") >= F.lit(since).cast("timestamp"))
    path = _plain_path()
    below = lambda base: F.substr(path, F.lit(len(base.rstrip("/")) + 2))
    digest = F.sha2("content", 256)
    return files.select(
        "path",
        below(bus_root).alias("file_id"),
        digest.alias("sha256"),
        F.left(digest, F.lit(FILE_VERSION_CHARS)).alias("version"),
        suffix_mime(path).alias("mime"),
        "length",
        "modificationTime",
    )
