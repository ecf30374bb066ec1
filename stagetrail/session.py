"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RUNTIME_SETTINGS = {
    # Naive input is UTC and event ids contain UTC text, so one zone everywhere.
    "spark.sql.session.timeZone": "UTC",
    # A repeated key in a message means its last value, as JSON readers usually take it.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Lookups keep a unique right side; AQE splits hot keys of the left side.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on; cluster sizing is left alone."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and the benchmark on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("stagetrail")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


#: Whether shuffle files go as soon as the execution that wrote them ends, not when the driver's memory is next collected.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Executions inside leave no shuffle files; for steps that write their results and never run one DataFrame twice."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


#: What opening a file counts for, in bytes, when files are dealt to tasks.
OPEN_COST = "spark.sql.files.openCostInBytes"


@contextmanager
def small_files(spark: SparkSession) -> Iterator[None]:
    """Executions inside read thousands of small files a task; by Spark's own figure of 4 MB a file it would be a few dozen."""
    before = spark.conf.get(OPEN_COST, None)
    spark.conf.set(OPEN_COST, "16k")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(OPEN_COST)
        else:
            spark.conf.set(OPEN_COST, before)


def spread(rows: DataFrame) -> DataFrame:
    """The rows dealt evenly to several tasks a core: a table of few bytes is read by few, whatever each row then costs."""
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism))


def nothing(spark: SparkSession, schema: StructType | str) -> DataFrame:
    """No rows, which the planner knows: a join with them moves no rows of the other side."""
    return spark.createDataFrame([], schema).where(F.lit(False))


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local master may fall back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="stagetrail-")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate files."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one run below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
