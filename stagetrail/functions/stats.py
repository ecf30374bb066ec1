"""Rates and confidence intervals as plain Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stagetrail.constants import MIN_GROUP_SIZE, WILSON_Z


def wilson(k: Column, n: Column, z: float = WILSON_Z, clamp: bool = True) -> tuple[Column, Column]:
    """Wilson score interval of k successes in n trials; (0, 0) without trials."""
    k, n = k.cast("double"), n.cast("double")
    z2 = F.lit(z * z)
    denominator = n + z2
    centre = (k + z2 / F.lit(2.0)) / denominator
    margin = F.lit(z) / denominator * F.sqrt(F.try_divide(k * (n - k), n) + z2 / F.lit(4.0))
    low, high = centre - margin, centre + margin
    if clamp:
        low, high = F.greatest(F.lit(0.0), low), F.least(F.lit(1.0), high)
    none = F.lit(0.0)
    return F.when(n > 0, low).otherwise(none), F.when(n > 0, high).otherwise(none)


def rate(k: Column, n: Column) -> Column:
    """k / n, NULL when n is 0."""
    return F.try_divide(k.cast("double"), n.cast("double"))


def rate_or_zero(k: Column, n: Column, digits: int = 4) -> Column:
    return F.bround(F.coalesce(rate(k, n), F.lit(0.0)), digits)


def sample_flag(n: Column, minimum: int = MIN_GROUP_SIZE) -> Column:
    return F.when(n < minimum, F.lit("insufficient_n")).otherwise(F.lit("ok"))
