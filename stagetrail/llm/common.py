"""Helpers the operators share: scratch tables, words, connected components, cells of candidates."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagetrail.session import prepare, run_folder

#: Words of a text: runs without the six ASCII white-space characters.
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


#: Rows that go to a Python worker at once; texts may be long, and several workers share an executor's memory.
ROWS_PER_BATCH = 1000


def texts_of(docs: DataFrame) -> DataFrame:
    """(doc_id long, text string) for a Python worker, in batches of bounded memory."""
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the folder all executors share and read back, so that lost executors cost no recomputation."""
    spark = df.sparkSession
    path = run_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a `stored` table that no later step reads."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def own_exchange(column: str) -> F.Column:
    """The same long, as an expression Spark does not match with an existing partitioning.

    A join whose sides both have an exchange of their own lets AQE split a hot key's partition.
    """
    return F.bitwise_not(F.bitwise_not(F.col(column)))


def own_text(column: str) -> F.Column:
    """`own_exchange` for a string."""
    return F.concat(F.col(column), F.lit(""))


def text_key(column: str) -> F.Column:
    """32 bytes that stand for a text; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(F.col(column).cast("string"), F.lit("")), 256))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable over undirected edges between longs.

    Alternating large-star and small-star steps; every step is a partial aggregate and a join that AQE can split, and
    each round is written out. Nodes without an edge to another node do not appear. Nulls are ignored.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    now = stored(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _to_smallest(both, F.least(F.min("b"), F.first("a"))).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.where("a <> b").distinct(), "edges")
        small = _to_smallest(large, F.min("b"))
        small = small.select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("e"))
        small = small.select(F.col("e.b").alias("a"), F.col("e.m").alias("b")).where("a <> b").distinct()
        after = stored(small, "edges")
        discard(now)
        discard(large)
        now, before, mark = after, mark, _mark(after)
        if mark == before:
            break
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _to_smallest(edges: DataFrame, smallest: F.Column) -> DataFrame:
    least = edges.groupBy("a").agg(smallest.alias("m")).select(own_exchange("a").alias("k"), "m")
    return edges.join(least, F.col("a") == F.col("k")).select("a", "b", "m")


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("long"))).first())


def in_cells(rows: DataFrame, key: str, member: str, chunk: int) -> DataFrame:
    """Rows of buckets with two rows or more, dealt to cells (key, lo, hi) of at most about two chunks.

    A bucket of n rows is cut into g = n / chunk parts by the member's hash; each row goes to the g cells in which its
    part meets another one (or itself), so every pair of the bucket meets in exactly one cell and no cell grows with
    the data.
    """
    sizes = rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    sizes = sizes.select(own_exchange(key).alias("k"), F.ceil(F.col("n") / chunk).cast("int").alias("g"))
    part = F.pmod(F.xxhash64(member, F.lit(7)), F.col("g")).cast("int")
    met = rows.join(sizes, F.col(key) == F.col("k")).drop("k").withColumn("part", part)
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("g") - 1)))
    return met.withColumns({"lo": F.least("part", "other"), "hi": F.greatest("part", "other")}).drop("g", "other", "part")


def per_cell(cells: DataFrame, key: str, compare: Callable[[pd.DataFrame], list[tuple]], schema: str) -> DataFrame:
    """`compare` on each cell; a task holds one Arrow batch and one cell at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in schema.split(",")]
        held: list[pd.DataFrame] = []

        def done(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
            ids = pdf[[key, "lo", "hi"]].to_numpy()
            cuts = np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1
            found = []
            for a, b in zip([0, *cuts], [*cuts, len(pdf)], strict=True):
                if b - a > 1:
                    found += compare(pdf.iloc[a:b])
            if found:
                yield pd.DataFrame(found, columns=names)

        for pdf in batches:
            if not len(pdf):
                continue
            ids = pdf[[key, "lo", "hi"]].to_numpy()
            same = (ids == ids[-1]).all(axis=1)
            start = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if start:
                yield from done(pd.concat([*held, pdf.iloc[:start]], ignore_index=True))
                held = []
            elif held and not (held[-1][[key, "lo", "hi"]].to_numpy()[-1] == ids[0]).all():
                yield from done(pd.concat(held, ignore_index=True))
                held = []
            held.append(pdf.iloc[start:])
        if held:
            yield from done(pd.concat(held, ignore_index=True))

    return cells.repartition(key, "lo", "hi").sortWithinPartitions(key, "lo", "hi").mapInPandas(run, schema)


def forest(labels: np.ndarray, ids: np.ndarray) -> list[tuple]:
    """Edges (id, smallest id of its class) of the classes with two members or more."""
    found = []
    order = np.argsort(labels, kind="stable")
    cuts = np.flatnonzero(np.diff(labels[order])) + 1
    for group in np.split(order, cuts):
        if len(group) > 1:
            members = np.unique(ids[group])
            found += [(int(m), int(members[0])) for m in members[1:]]
    return found
