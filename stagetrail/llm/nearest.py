"""Approximate nearest neighbours by inner product: probed lists, scanned with adaptive dimension sampling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from stagetrail.llm.common import own_exchange, stored

#: The sample the rotation's centre and the lists are fitted on, the number of lists, and how many a query probes.
SAMPLE, LISTS, PROBES = 20_000, 32, 21
#: Vectors, and queries, of one cell; longer lists are cut into cells, so none grows with the data.
CELL = 4096
#: Ends of the column blocks; after each the hypothesis test drops candidates.
COLUMNS = (24, 32, 40, 48, 56)
#: Queries measured against the first block at once.
TOGETHER = 64
#: Slack of the test: larger drops fewer candidates wrongly.
EPSILON = 2.1
#: Candidates measured whole at first, so that the test has a bound.
START = 256


def usable(embedding: F.Column) -> F.Column:
    """Neither null, zero nor empty, and without null, infinite or undefined components."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(embedding.isNotNull() & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


class Lists:
    """A random rotation, the largest norm, and centroids of the rotated vectors, fitted on a bounded sample.

    The largest inner product is the smallest distance once every vector is lengthened to one norm by a component of
    its own, sqrt(norm^2 - |x|^2), which a query does not have.
    """

    def __init__(self, sample: np.ndarray, norm: float, lists: int, seed: int = 3):
        rng = np.random.default_rng(seed)
        width = sample.shape[1] + 1
        self.norm = norm
        self.rotation = np.linalg.qr(rng.normal(size=(width, width)))[0].astype(np.float32)
        points = self.turned(sample)
        centres = points[rng.choice(len(points), min(lists, len(points)), replace=False)]
        for _ in range(12):
            near = self._near(points, centres)[:, 0]
            sums, counts = np.zeros_like(centres), np.bincount(near, minlength=len(centres))
            np.add.at(sums, near, points)
            centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres).astype(np.float32)
        self.centres = centres

    def turned(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        vectors = vectors.astype(np.float64)
        own = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(self.norm**2 - (vectors**2).sum(axis=1), 0))
        return (np.concatenate([vectors, own[:, None]], axis=1) @ self.rotation).astype(np.float32)

    @staticmethod
    def _near(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
        return np.argsort((centres**2).sum(axis=1) - 2 * points @ centres.T, axis=1, kind="stable")

    def nearest(self, points: np.ndarray, n: int) -> np.ndarray:
        return self._near(points, self.centres)[:, :n]


def _distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    return (queries**2).sum(axis=1)[:, None] - 2 * (queries @ points.T) + (points**2).sum(axis=1)


def scan(queries: np.ndarray, own: np.ndarray, vectors: np.ndarray, ids: np.ndarray, fitted: Lists, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query the k best (ids, exact double products) of a cell.

    The squared distance from the first d of D rotated columns, times D / d, estimates the whole one with a relative
    error of about EPSILON / sqrt(d); a candidate whose estimate is beyond the k-th best of the first ones by more than
    that is abandoned. What is left after the last block is measured on the original vectors.
    """
    turned, asked = fitted.turned(vectors), fitted.turned(queries, query=True)
    total, room = turned.shape[1], np.float32(1e-5 * max(1.0, fitted.norm**2))
    ends = [c for c in COLUMNS if c < total] + [total]
    for a in range(0, len(queries), TOGETHER):
        part = asked[a : a + TOGETHER]
        first = np.where(ids[None, :START] == own[a : a + TOGETHER, None], np.inf, _distances(part, turned[:START]))
        bound = np.partition(first, k - 1, axis=1)[:, k - 1] if first.shape[1] >= k else np.full(len(part), np.inf)
        begun = _distances(part[:, : ends[0]], turned[:, : ends[0]])
        for i, mine in enumerate(part):
            partial, done = begun[i], 0
            alive = np.flatnonzero(ids != own[a + i])
            partial = partial[alive]
            for end in ends:
                if done:
                    partial = partial + ((turned[alive, done:end] - mine[done:end]) ** 2).sum(axis=1)
                slack = (1 + EPSILON / np.sqrt(end)) ** 2 if end < total else 1.0
                stay = partial <= bound[i] * (end / total) * slack + room
                alive, partial, done = alive[stay], partial[stay], end
            # Row sums, unlike matrix products, do not depend on a row's neighbours, so equal vectors get equal scores.
            score = (vectors[alive].astype(np.float64) * queries[a + i].astype(np.float64)).sum(axis=1)
            best = np.lexsort((ids[alive], -score))[:k]
            yield ids[alive][best], score[best]


def nearest_neighbours(
    base: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    lists: int = LISTS,
    probes: int = PROBES,
    sample: int = SAMPLE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): up to k rows of base for each row of queries, never the row with its own id.

    Largest inner product first, equal ones by smaller id; score is computed in double precision on the vectors as
    given. Every usable row of base is put in the list of its nearest centroid, lists are cut into cells, and each query
    is sent to all cells of the lists it probes; cells return their k best and the query keeps the k best of those.

    Vectors that are null, zero, of another width than the most common one, or that hold null or non-finite components
    take no part on either side, as do null ids. Of several rows with one id the largest vector (as arrays order)
    counts. Fewer candidates than k give fewer rows; empty tables give none; other columns are ignored.
    """
    spark = base.sparkSession

    def clean(rows: DataFrame) -> DataFrame:
        rows = rows.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<float>").alias("v"))
        return rows.where(F.col("id").isNotNull() & usable(F.col("v"))).groupBy("id").agg(F.max("v").alias("v"))

    points = stored(clean(base), "vectors")
    widths = points.groupBy(F.size("v").alias("w")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if widths is None:
        return spark.createDataFrame([], schema)
    points = points.where(F.size("v") == widths["w"])
    norm = points.select(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x))).first()[0] ** 0.5
    chosen = points.withColumn("place", F.xxhash64("id", F.lit(5))).orderBy("place", "id").limit(sample).select("v").collect()
    fitted = spark.sparkContext.broadcast(Lists(np.array([r["v"] for r in chosen], np.float32), norm, lists))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                turned = fitted.value.turned(np.stack(pdf["v"].to_numpy()))
                yield pdf.assign(list=fitted.value.nearest(turned, 1)[:, 0].astype(np.int32))

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                turned = fitted.value.turned(np.stack(pdf["v"].to_numpy()), query=True)
                near = fitted.value.nearest(turned, probes)
                yield pd.DataFrame({"id": np.repeat(pdf["id"].to_numpy(), near.shape[1]), "list": near.reshape(-1).astype(np.int32)})

    indexed = stored(points.mapInPandas(assign, "id long, v array<float>, list int"), "vector-lists")
    sizes = indexed.groupBy("list").agg(F.ceil(F.count("*") / CELL).cast("int").alias("cells"))
    cells = F.broadcast(sizes)  # at most `lists` rows
    asked = stored(clean(queries).where(F.size("v") == widths["w"]), "vector-queries")
    parts = max(1, -(-asked.count() // CELL))
    located = indexed.join(cells, "list").withColumn("cell", F.pmod(F.xxhash64("id"), F.col("cells")).cast("int"))
    located = located.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    sent = asked.mapInPandas(probe, "id long, list int").join(cells, "list")
    sent = sent.withColumn("cell", F.explode(F.sequence(F.lit(0), F.col("cells") - 1))).select(own_exchange("id").alias("q"), "list", "cell")
    sent = sent.join(asked, F.col("q") == F.col("id")).select("list", "cell", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part"), "id", "v")

    def search(asked_rows: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(asked_rows) or not len(rows):
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        own, ids = asked_rows["id"].to_numpy(np.int64), rows["id"].to_numpy(np.int64)
        found = list(scan(np.stack(asked_rows["v"].to_numpy()), own, np.stack(rows["v"].to_numpy()), ids, fitted.value, k))
        near, scores = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        return pd.DataFrame({"query_id": np.repeat(own, [len(f[0]) for f in found]), "vec_id": near, "score": scores})

    cell = ["list", "cell", "part"]
    found = sent.groupBy(cell).cogroup(located.groupBy(cell)).applyInPandas(search, "query_id long, vec_id long, score double")
    order = W.Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
