"""Folder watch: files that stopped changing become file tasks."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagetrail.operators.contracts import build_tasks, check_messages
from stagetrail.session import small_files
from stagetrail.sources.messages import encode_tasks, read_inbox, read_listing

_PENDING = "path string, size long, mtime timestamp"


def _pending(spark: SparkSession, state: str, scan: int) -> DataFrame:
    try:
        return spark.read.schema(_PENDING).parquet(f"{state}/pending/scan={scan}")
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _PENDING)


def watch_folder(spark: SparkSession, inbox: str, bus_root: str, state: str, out: str, scan: int, now: datetime) -> DataFrame:
    """``scan_folder`` with many small files a task."""
    with small_files(spark):
        return scan_folder(spark, inbox, bus_root, state, out, scan, now)


def scan_folder(spark: SparkSession, inbox: str, bus_root: str, state: str, out: str, scan: int, now: datetime) -> DataFrame:
    """One scan of ``inbox``: tasks of the files that are as they were in the scan before, written to ``out/scan=N``.

    Listing, comparison, content hash and task are one job. What is seen for the first time, or has changed, is pending
    for the next scan; a file that is handed out is forgotten, and one that was away starts over. A scan that is repeated
    replaces its own output. Only files as young as the oldest stable one are opened, and none if none is stable.
    Returns the messages written.

    The file source does not show names that start with ``_`` or ``.``, so such files are never handed out.
    """
    listing = f"{state}/listing/scan={scan}"
    read_listing(spark, inbox).write.mode("overwrite").parquet(listing)
    seen = spark.read.schema(_PENDING).parquet(listing)
    before = _pending(spark, state, scan - 1).select("path", F.struct("size", "mtime").alias("_before"))
    compared = seen.join(before, "path", "left")
    same = F.coalesce(F.struct("size", "mtime").eqNullSafe(F.col("_before")), F.lit(False)) & F.col("_before").isNotNull()
    compared.filter(~same).drop("_before").write.mode("overwrite").parquet(f"{state}/pending/scan={scan}")
    stable = compared.filter(same).select("path")
    youngest_since = compared.filter(same).agg(F.min("mtime")).first()[0]
    if youngest_since is None:
        valid = spark.createDataFrame([], "value string")
    else:
        files = read_inbox(spark, inbox, bus_root, since=youngest_since).join(stable, "path", "left_semi")
        tasks = build_tasks(files.select("file_id", "sha256", "version", "mime"), "drive_file", "drive", now)
        valid = check_messages(encode_tasks(tasks)).filter("reason IS NULL").select("value")
    valid.write.mode("overwrite").text(f"{out}/scan={scan}")
    return spark.read.schema("value string").text(f"{out}/scan={scan}")
