"""Centroid clustering in exact integers; a table of distances to fixed pivots spares most distances to centroids."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagetrail.llm.common import discard, stored

#: Vectors from which the pivots are chosen.
SAMPLE = 1000
#: Larger integer components are refused, because a squared distance of 64 of them would leave 64 bits.
LARGEST = 1 << 27
#: Vectors compared with all centroids at once.
BLOCK = 4096
RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def integer_vectors(vectors: DataFrame, dims: int, scale: int, seed: str) -> DataFrame:
    """(vec_id, rank, v): kept vectors as integers floor(scale * x); rank is the hash that orders the first centroids."""
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = F.transform("e", lambda x: F.floor(F.lit(float(scale)) * x))
    fits = F.forall("v", lambda x: F.abs(x) <= LARGEST)
    too_large = F.raise_error(F.lit(f"a component is not within {LARGEST / scale}")).cast("array<int>")
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
        .where((F.size("e") == dims) & finite)
        .select("vec_id", F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256).alias("rank"), v.alias("v"))
        .withColumn("v", F.when(fits, F.col("v").cast("array<int>")).otherwise(too_large))
    )


def squared(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    return ((rows - point) ** 2).sum(axis=1)


def choose_pivots(sample: np.ndarray, pivots: int) -> np.ndarray:
    """Vectors far from those chosen before; the first is farthest from the first of the sample."""
    chosen: list[int] = []
    least = squared(sample, sample[0])
    while len(chosen) < min(pivots, len(sample)):
        chosen.append(int(least.argmax()))
        own = squared(sample, sample[chosen[-1]])
        least = np.minimum(least, own) if len(chosen) > 1 else own
        if not least.any():
            break
    return sample[chosen]


def assign(v: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, centroid_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance, exact distances computed): the nearest centroid of each vector, ties to the smaller number.

    |d(v, p) - d(c, p)| <= d(v, c) for every pivot p. The centroid with the smallest bound is measured first; others are
    measured only while their bound does not exceed the best distance so far.
    """
    bound = np.zeros((len(v), len(centroids)))
    for p in range(to_pivots.shape[1]):
        own, their = to_pivots[:, p : p + 1], centroid_pivots[None, :, p]
        # Less what rounding may add, so that a bound is never too large.
        np.maximum(bound, np.abs(own - their) - 1e-12 * (own + their), out=bound)
    bound *= bound
    cluster = bound.argmin(axis=1)
    best = squared(v, centroids[cluster])
    measured = len(v)
    first = cluster.copy()
    for k in range(len(centroids)):
        rows = np.flatnonzero((bound[:, k] <= best) & (first != k))
        if len(rows):
            found = squared(v[rows], centroids[k])
            measured += len(rows)
            nearer = (found < best[rows]) | ((found == best[rows]) & (k < cluster[rows]))
            cluster[rows[nearer]] = k
            best[rows[nearer]] = found[nearer]
    return cluster, best, measured


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(kind)


def _with_pivots(kept: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(vec_id, v, p): p are the distances to the pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = _matrix(batch.column("v"), np.int64)
                p = np.stack([np.sqrt(squared(v, x)) for x in pivots], axis=1)
                own = pa.array(list(p), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), own], ["vec_id", "v", "p"])

    return kept.select("vec_id", "v").mapInArrow(run, "vec_id long, v array<int>, p array<double>")


def _blocks(batch: pa.RecordBatch, centroids: np.ndarray, pivots: np.ndarray) -> Iterator[tuple]:
    between = np.sqrt(((centroids[:, None, :] - pivots[None]) ** 2).sum(axis=2))
    for first in range(0, batch.num_rows, BLOCK):
        part = batch.slice(first, BLOCK)
        v = _matrix(part.column("v"), np.int64)
        yield part, v, *assign(v, _matrix(part.column("p"), np.float64), centroids, between)


def _moved(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The centroids after one round: a task sends one row of sums per cluster, the driver gets one per cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for batch in batches:
            for _, v, cluster, _, _ in _blocks(batch, centroids, pivots):
                np.add.at(sums, cluster, v)
                counts += np.bincount(cluster, minlength=len(centroids))
        held = np.flatnonzero(counts)
        columns = [pa.array(held, pa.int32()), pa.array(counts[held]), pa.array(list(sums[held]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "sums"])

    sums = [F.sum(F.col("sums")[j]).alias(f"s{j}") for j in range(centroids.shape[1])]
    parts = table.mapInArrow(run, "cluster int, n long, sums array<long>")
    moved = centroids.copy()
    for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *sums).collect():
        moved[r["cluster"]] = [r[f"s{j}"] // r["n"] for j in range(centroids.shape[1])]
    return moved


def cluster_vectors(
    vectors: DataFrame, clusters: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: str = "2:", pivots: int = 16
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256): one row per kept vector.

    Vectors (vec_id, embedding) with exactly `dims` components, none null or non-finite, become integers
    floor(scale * x). The first centroids are the vectors with the smallest sha256 of seed and vec_id; each round assigns
    all vectors to the nearest centroid (squared distance, ties to the smaller number) and moves every centroid that has
    some to floor(sum / count) of each component; then vectors are assigned once more. All of it is exact.

    Null, short, long and non-finite vectors are left out; a null vec_id is kept, but has no hash and is the last choice
    for a first centroid; rows that repeat a vec_id count each, equal hashes are ordered by the components; with fewer vectors than
    clusters there are as many clusters as vectors; an empty table gives no rows; other columns are ignored. Components
    beyond LARGEST / scale are refused with an error.
    """
    spark = vectors.sparkSession
    kept = integer_vectors(vectors, dims, scale, seed)
    sample = np.array([r["v"] for r in kept.orderBy(F.col("rank").asc_nulls_last(), "v").limit(max(SAMPLE, clusters)).collect()], np.int64)
    if not len(sample):
        return spark.createDataFrame([], RESULT)
    centroids, fixed = sample[:clusters], choose_pivots(sample, pivots)
    table = stored(_with_pivots(kept, fixed), "pivot-table")
    for _ in range(rounds):
        centroids = _moved(table, centroids, fixed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, cluster, distance, _ in _blocks(batch, centroids, fixed):
                columns = [part.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    last = stored(table.mapInArrow(run, "vec_id long, cluster int, distance long"), "clusters")
    discard(table)
    sums = {r["cluster"]: r["s"] for r in last.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(k, s, sum(sums.values()), marks[k]) for k, s in sums.items()]
    named = spark.createDataFrame(rows, "k int, cluster_inertia long, inertia long, centroid_sha256 string")
    # As many rows as clusters at most.
    return last.join(F.broadcast(named), F.col("cluster") == F.col("k")).select(*(c.split()[0] for c in RESULT.split(", ")))
