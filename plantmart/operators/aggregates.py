"""Aggregate expressions and summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_when(condition: Column, measure: Column | str) -> Column:
    """Sum of ``measure`` over the rows meeting ``condition``, 0 when there are none."""
    value = F.col(measure) if isinstance(measure, str) else measure
    return F.sum(F.when(condition, value).otherwise(F.lit(0.0)))


def weighted_average(rate: str, weight: str, digits: int = 2) -> Column:
    """sum(rate * weight) / sum(weight), rounded and never below 0; null when the weights add up to 0."""
    ratio = F.round(F.try_divide(F.sum(F.col(rate) * F.col(weight)), F.sum(weight)), digits)
    return F.when(ratio < 0, F.lit(0.0)).otherwise(ratio)


def share_between_0_and_1(part: Column, whole: Column) -> Column:
    """part / whole held within [0, 1]; 0 when the ratio does not exist."""
    ratio = F.least(F.greatest(F.try_divide(part, whole), F.lit(0.0)), F.lit(1.0))
    return F.when((whole == 0) & (part == 0), F.lit(0.0)).otherwise(ratio)


def frequency(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def text_set(column: str, separator: str = ",") -> Column:
    """The different values of a group as one sorted text.

    For columns whose value range is a small dictionary (plants, countries): the buffer holds each value once.
    """
    return F.array_join(F.array_sort(F.collect_set(column)), separator)


def earliest(column: str) -> Column:
    """Earliest non-null value."""
    return F.min(column)


def two_level_sum(
    df: DataFrame, inner: Sequence[str], outer: Sequence[str], sums: Sequence[str], derive: dict[str, Column]
) -> DataFrame:
    """Sum per ``inner`` key, derive columns from those sums, then sum everything per ``outer`` key."""
    first = df.groupBy(*inner).agg(*[F.sum(c).alias(c) for c in sums]).withColumns(derive)
    return first.groupBy(*outer).agg(*[F.sum(c).alias(f"sum_{c}") for c in [*sums, *derive]])


def exact_total(amount: str) -> Column:
    """Total of an amount of money as a double that does not depend on the order of the rows; 0 without any amount.

    Amounts are added as decimals of ten digits behind the point. Those a decimal cannot hold (NaN, infinite, 1e18 and more) are
    added as doubles.
    """
    value = F.col(amount)
    fixed = value.try_cast("decimal(28,10)")
    rest = F.sum(F.when(fixed.isNull(), value))
    return F.coalesce(F.sum(fixed).cast("double"), F.lit(0.0)) + F.coalesce(rest, F.lit(0.0))
