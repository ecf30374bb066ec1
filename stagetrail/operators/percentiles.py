"""Exact order statistics per group without gathering a group in one place."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagetrail.session import run_folder

# Output name -> ranks as functions of the group's size; the output is their mean.
Targets = dict[str, list[Callable[[Column], Column]]]


def _ranges(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """``(groups, value, _n, _part)``: each value with its number of rows, dealt to parts by group and value.

    The source is read once. A group's parts follow each other in value order, and a group with many values has many
    parts. Parts depend on Spark's sample of the values, so they are written out before anything looks at them.
    """
    copies = df.select(*groups, value).filter(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_n"))
    path = run_folder(df.sparkSession, "ranges")
    copies.repartitionByRange(*groups, value).withColumn("_part", F.spark_partition_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _values_at(df: DataFrame, groups: Sequence[str], value: str, targets: Targets) -> DataFrame:
    """One row per group; each output column is the mean of the values at its 1-based ranks.

    Sums per part say which part holds a wanted rank; only those parts are ordered, each by itself.
    """
    ranges = _ranges(df, groups, value)
    sizes = ranges.groupBy(*groups, "_part").agg(F.sum("_n").alias("_size"))
    in_order = Window.partitionBy(*groups).orderBy("_part")
    whole = Window.partitionBy(*groups)
    sizes = sizes.withColumns({"_total": F.sum("_size").over(whole), "_start": F.sum("_size").over(in_order) - F.col("_size")})
    within = lambda r, before, n: (before < r) & (r <= before + n)
    ranks = [r(F.col("_total")) for rs in targets.values() for r in rs]
    wanted = sizes.filter(reduce(lambda a, b: a | b, [within(r, F.col("_start"), F.col("_size")) for r in ranks]))
    keys = [ranges[c].eqNullSafe(F.col(f"_{c}")) for c in (*groups, "_part")]
    wanted = wanted.select(*[F.col(c).alias(f"_{c}") for c in (*groups, "_part")], "_total", "_start")
    near = ranges.join(wanted, reduce(lambda a, b: a & b, keys)).select(*groups, "_part", value, "_n", "_total", "_start")
    upto = F.sum("_n").over(Window.partitionBy(*groups, "_part").orderBy(value))
    placed = near.withColumn("_before", F.col("_start") + upto - F.col("_n"))

    def pick(rank: Callable[[Column], Column]) -> Column:
        return F.max(F.when(within(rank(F.col("_total")), F.col("_before"), F.col("_n")), F.col(value)))

    out = []
    for name, wanted_ranks in targets.items():
        picked = [pick(r) for r in wanted_ranks]
        mean = picked[0] if len(picked) == 1 else reduce(lambda a, b: a + b, picked) / F.lit(float(len(picked)))
        out.append(mean.alias(name))
    result = placed.groupBy(*groups).agg(*out)
    return result if groups else result.filter(F.col(next(iter(targets))).isNotNull())


def nearest_rank(df: DataFrame, groups: Sequence[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """Nearest-rank percentiles: the value at position ceil(q * n)."""
    rank = lambda q: lambda n: F.greatest(F.lit(1), F.ceil(F.lit(q) * n))
    return _values_at(df, groups, value, {name: [rank(q)] for name, q in quantiles.items()})


def median(df: DataFrame, value: str, groups: Sequence[str] = (), out: str = "median") -> DataFrame:
    """Middle value, or the mean of the two middle values."""
    middle = [lambda n: F.floor((n + 1) / 2), lambda n: F.floor(n / 2) + 1]
    return _values_at(df, groups, value, {out: middle})
