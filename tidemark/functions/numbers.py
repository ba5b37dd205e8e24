"""Ratios and rounding. ANSI mode is on by default, so every divisor is guarded."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(x: Column, digits: int) -> Column:
    """Scale, round half to even, unscale: 2.25 to one digit is 2.2."""
    scale = F.lit(float(10**digits))
    return F.rint(x * scale) / scale


def safe_ratio(part: Column, whole: Column) -> Column:
    """NULL where the divisor is zero."""
    return part / F.nullif(whole, F.lit(0))


def ratio_or_zero(part: Column, whole: Column, digits: int) -> Column:
    return F.coalesce(round_half_even(safe_ratio(part, whole), digits), F.lit(0.0))


def mean_whole(total: Column, count: Column) -> Column:
    """Mean cut to a whole number, 0 where there is nothing to average."""
    return F.coalesce(F.try_divide(total, count).cast("long"), F.lit(0).cast("long"))


def avg_positive_whole(x: Column) -> Column:
    """Mean of the positive values cut to a whole number, 0 where there are none."""
    return F.coalesce(F.avg(F.when(x > 0, x)).cast("long"), F.lit(0).cast("long"))


# Fixed values of the repeatable mean: the unit of the whole part, and the size from
# which a value does not fit 38 digits beside a million million others of its size.
UNIT = 1024.0
WHOLE_LIMIT = 1e22


def mean_sums(x: Column, whole: str, rest: str, count: str) -> list[Column]:
    """Aggregates from which ``mean_of`` takes a mean that does not depend on the
    order rows are added in, so that a retried task or another partitioning gives
    the same digits. A sum of doubles loses low digits differently in every order;
    here whole 1024ths add up as decimals, and only what is left as doubles. Beyond
    WHOLE_LIMIT, NaN and infinity included, there are plain doubles only."""
    units = x * F.lit(UNIT)
    full = F.when(F.abs(x) < WHOLE_LIMIT, units - units % 1).otherwise(F.lit(0.0))
    return [
        F.sum(F.when(x.isNotNull(), full).cast("decimal(28,0)")).alias(whole),
        F.sum(units - full).alias(rest),
        F.count(x).alias(count),
    ]


def mean_of(whole: Column, rest: Column, count: Column) -> Column:
    return F.try_divide((whole.cast("double") + rest) / F.lit(UNIT), count)
