"""Scoring extraction results against labelled rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagetrail import constants as C
from stagetrail.functions.stats import wilson
from stagetrail.functions.text import java_regex, nfkc_casefold, strip
from stagetrail.operators.percentiles import nearest_rank

FIELDS = C.RECORD_FIELDS
SCALAR_FIELDS = tuple(f for f in FIELDS if f != "requirements")


def plain_text(col: Column) -> Column:
    """Form in which two spellings of a value compare equal."""
    folded = F.translate(nfkc_casefold(F.coalesce(col, F.lit(""))), *C.FINAL_LETTERS)
    spaced = F.regexp_replace(folded, java_regex(C.SCORE_PUNCTUATION), " ")
    return F.btrim(F.regexp_replace(spaced, java_regex(r"\s+"), " "), F.lit(" ."))


def token_set(plain: Column) -> Column:
    return F.array_distinct(F.filter(F.split(plain, " "), lambda t: t != ""))


def token_f1(predicted: Column, gold: Column) -> Column:
    """F1 of two token sets; two empty sets agree fully, one empty set not at all."""
    p, g = F.size(predicted), F.size(gold)
    common = F.size(F.array_intersect(predicted, gold)).cast("double")
    precision, recall = common / p, common / g
    f1 = F.lit(2.0) * precision * recall / (precision + recall)
    return (
        F.when((p == 0) & (g == 0), F.lit(1.0)).when((p == 0) | (g == 0) | (common == 0), F.lit(0.0)).otherwise(f1)
    )


def gold_requirements(col: Column) -> Column:
    listed = F.filter(F.split(F.coalesce(col, F.lit("")), r"\|"), lambda r: strip(r) != "")
    return F.array_join(listed, " ")


def field_matches(pairs: DataFrame, prefix: str = "pred_") -> DataFrame:
    """Add ``ok_<field>`` for rows with gold fields and prefixed predicted ones."""
    plain = {}
    for f in SCALAR_FIELDS:
        plain[f"_g_{f}"] = plain_text(F.col(f))
        plain[f"_p_{f}"] = plain_text(F.col(prefix + f))
    plain["_g_requirements"] = plain_text(gold_requirements(F.col("requirements")))
    predicted = F.array_join(F.coalesce(F.col(f"{prefix}requirements"), F.array().cast("array<string>")), " ")
    plain["_p_requirements"] = plain_text(predicted)
    rows = pairs.withColumns(plain)
    f1 = token_f1(token_set(F.col("_p_requirements")), token_set(F.col("_g_requirements")))
    rows = rows.withColumns(
        {
            **{f"ok_{f}": F.col(f"_p_{f}") == F.col(f"_g_{f}") for f in SCALAR_FIELDS},
            "ok_requirements": f1 >= C.REQUIREMENTS_F1,
        }
    )
    return rows.drop(*plain)


def score_paths(gold: DataFrame, predictions: DataFrame, paths: Sequence[str], key: str = "ad_id") -> DataFrame:
    """One row per extraction path: field hits, accuracy with interval, cost, latency, failures.

    Every gold row counts for every path; a missing prediction scores as empty.
    """
    named = predictions.select(
        "path", key, *[F.col(f).alias(f"pred_{f}") for f in FIELDS], "cost_usd", "latency_ms", "failed"
    )
    asked = gold.select(key, *FIELDS, F.explode(F.array(*[F.lit(p) for p in paths])).alias("path"))
    rows = field_matches(asked.join(named, ["path", key], "left"))
    rows = rows.select(
        "path",
        F.coalesce("cost_usd", F.lit(0.0)).alias("cost_usd"),
        F.coalesce("latency_ms", F.lit(0.0)).alias("latency_ms"),
        F.coalesce("failed", F.lit(True)).alias("failed"),
        *[f"ok_{f}" for f in FIELDS],
    )
    sums = rows.groupBy("path").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(f"ok_{f}").alias(f"correct_{f}") for f in FIELDS],
        F.avg("cost_usd").alias("mean_cost"),
        F.count_if("failed").alias("failures"),
    )
    correct = F.lit(0)
    for f in FIELDS:
        correct = correct + F.col(f"correct_{f}")
    sums = sums.withColumns({"k": correct, "of": F.col("n") * len(FIELDS)})
    low, high = wilson(F.col("k"), F.col("of"))
    sums = sums.withColumns({"accuracy": F.col("k") / F.col("of"), "wilson_low": low, "wilson_high": high})
    latency = nearest_rank(rows, ["path"], "latency_ms", {"p50_ms": 0.5, "p95_ms": 0.95})
    return sums.join(latency, "path")


def adopted_path(scores: DataFrame) -> DataFrame:
    """Cheapest path that is accurate enough; no row when none is."""
    good = scores.filter((F.col("accuracy") >= C.ADOPT_ACCURACY) & (F.col("wilson_low") >= C.ADOPT_WILSON_LOW))
    best = good.agg(F.min(F.struct("mean_cost", "path")).alias("best"))
    return best.filter("best IS NOT NULL").select("best.path", "best.mean_cost")
