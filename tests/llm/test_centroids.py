"""Centroid clustering against plain Python, with odd rows."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stagetrail.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, clusters, rounds, dims, scale=256, seed="2:"):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    at = [v for _, v in first[:clusters]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(at))

    for _ in range(rounds):
        held = {}
        for _, v in kept:
            held.setdefault(nearest(v)[1], []).append(v)
        at = [[sum(col) // len(held[k]) for col in zip(*held[k], strict=True)] if k in held else c for k, c in enumerate(at)]
    last = [(i, *nearest(v)[::-1]) for i, v in kept]
    own = {}
    for _, k, d in last:
        own[k] = own.get(k, 0) + d
    marks = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in at]
    return sorted([(i, k, d, own[k], sum(own.values()), marks[k]) for i, k, d in last], key=str)


def run(spark, rows, extra=False, **options):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    if extra:
        df = df.withColumns({c: F.lit("x") for c in ("cluster", "distance", "rank", "v", "p", "k", "e", "n", "inertia")})
    return sorted((tuple(r) for r in centroids.cluster_vectors(df, **options).collect()), key=str)


@pytest.mark.parametrize("clusters,rounds,pivots", [(7, 4, 3), (1, 1, 1), (5, 0, 16)])
def test_against_brute_force(spark, clusters, rounds, pivots):
    rng = random.Random(clusters)
    centres = [[rng.gauss(0, 2) for _ in range(6)] for _ in range(9)]
    rows = [(i, [float(np.float32(x + rng.gauss(0, 0.4))) for x in rng.choice(centres)]) for i in range(300)]
    assert run(spark, rows, extra=True, clusters=clusters, rounds=rounds, dims=6, pivots=pivots) == brute(rows, clusters, rounds, 6)


def test_copies_ties_and_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [0.5, -0.25]) for i in range(40)] + [(i, [float(i % 3), float(i % 2)]) for i in range(40, 60)]
    rows += [(7, [0.5, -0.25]), (7, [3.0, 1.0]), (None, [9.0, 9.0]), (None, None), (61, None), (62, []), (63, [1.0]), (64, [1.0, 2.0, 3.0])]
    rows += [(65, [nan, 1.0]), (66, [1.0, None]), (67, [inf, 0.0]), (68, [-inf, 0.0])]
    assert run(spark, rows, clusters=6, rounds=3, dims=2) == brute(rows, 6, 3, 2)
    few = rows[-14:]
    assert run(spark, few, clusters=40, rounds=5, dims=2) == brute(few, 40, 5, 2)
    assert run(spark, [], clusters=4) == [] == run(spark, [(1, None)], clusters=4)


def test_components_that_are_too_large_are_refused(spark):
    with pytest.raises(Exception, match="is not within"):
        run(spark, [(1, [1e30, 0.0])], dims=2)


def test_bounds_spare_distances_and_lose_nothing():
    rng = np.random.default_rng(3)
    centres = rng.integers(-400, 400, (30, 64))
    v = centres[rng.integers(0, 30, 3000)] + rng.integers(-40, 40, (3000, 64))
    pivots = centroids.choose_pivots(v[:200], 16)

    def to(rows):
        return np.stack([np.sqrt(centroids.squared(rows, p)) for p in pivots], axis=1)

    cluster, distance, measured = centroids.assign(v, to(v), centres, to(centres))
    full = ((v[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (cluster == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()
    assert measured < 0.2 * full.size
