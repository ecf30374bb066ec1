"""Files that stopped changing: equal size and time in two scans in a row."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

LISTING = "path string, size bigint, mtime timestamp, scan bigint"


def stable_files(listings: DataFrame, block: int = 1000) -> DataFrame:
    """Batch form over numbered scans, one row per ``(path, size, mtime, scan)``.

    A file is handed out on the second of two equal sightings in consecutive scans
    and then forgotten, so within a run of equal sightings it is every second one.
    A scan without the file breaks the run.

    A path listed in very many scans must not become one task's work: neighbours
    meet in a join on path and scan, and the start of a run is looked for within a
    block of scans first, then among the blocks' last starts.
    """
    before = listings.select(
        "path", (F.col("scan") + 1).alias("scan"), F.struct("size", "mtime").alias("_before")
    )
    seen = listings.join(before, ["path", "scan"], "left")
    same = F.col("_before").isNotNull() & F.struct("size", "mtime").eqNullSafe(F.col("_before"))
    marked = seen.withColumns(
        {"_start": F.when(~same, F.col("scan")), "_block": F.floor(F.col("scan") / block)}
    ).drop("_before")
    in_block = Window.partitionBy("path", "_block").orderBy("scan")
    last_starts = marked.groupBy("path", "_block").agg(F.max("_start").alias("_last"))
    earlier = Window.partitionBy("path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last_starts.select("path", "_block", F.max("_last").over(earlier).alias("_carried"))
    placed = marked.withColumn("_own", F.max("_start").over(in_block)).join(carried, ["path", "_block"])
    nth = F.col("scan") - F.coalesce("_own", "_carried") + 1
    return placed.filter(nth % 2 == 0).select(*listings.columns)


class _Stability(StatefulProcessor):
    """Remembers one signature per path."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.pending = handle.getValueState("pending", "size bigint, mtime timestamp, scan bigint", None)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        scans = pd.concat(list(rows)).sort_values("scan")
        known = self.pending.get() if self.pending.exists() else None
        out = []
        for row in scans.itertuples(index=False):
            if known is not None and (row.size_, row.mtime, row.scan - 1) == known:
                out.append((key[0], row.size_, row.mtime, row.scan))
                known = None
            else:
                known = (row.size_, row.mtime, row.scan)
        if known is None:
            self.pending.clear()
        else:
            self.pending.update(known)
        yield pd.DataFrame(out, columns=["path", "size", "mtime", "scan"])

    def close(self) -> None:
        pass


def stable_files_stream(listings: DataFrame) -> DataFrame:
    """Streaming form of ``stable_files``; needs the RocksDB state store.

    Scan numbers are part of the remembered signature, so a file that was missing
    from a scan starts over without being tracked while it is away.
    """
    renamed = listings.withColumnRenamed("size", "size_")
    return renamed.groupBy("path").transformWithStateInPandas(
        statefulProcessor=_Stability(), outputStructType=LISTING, outputMode="Append", timeMode="None"
    )
