"""Data checks: completeness, overlap, outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def completeness_check(df: DataFrame, rules: Sequence[tuple[str, Column]], all_failures: bool = False) -> DataFrame:
    """Rows failing any rule, with the first failing rule's name in ``remarks``.

    A rule is (name, condition that is true when the field is missing). ``all_failures`` adds an array of all names.
    """
    failed = [F.when(F.coalesce(condition, F.lit(False)), F.lit(name)) for name, condition in rules]
    out = df.withColumn("remarks", F.coalesce(*failed)).filter(F.col("remarks").isNotNull())
    return out.withColumn("failures", F.array_compact(F.array(*failed))) if all_failures else out


def missing(*columns: str) -> list[tuple[str, Column]]:
    """Rules that a column must not be null, named after the column."""
    return [(c, F.col(c).isNull()) for c in columns]


def common_keys(left: DataFrame, right: DataFrame, on: dict[str, str]) -> DataFrame:
    """Distinct key combinations both frames have."""
    return left.select(*on).intersect(right.select(*[F.col(r).alias(l) for l, r in on.items()]))


def keys_missing_from(left: DataFrame, right: DataFrame, on: dict[str, str]) -> DataFrame:
    """Distinct key combinations only ``left`` has."""
    return left.select(*on).subtract(right.select(*[F.col(r).alias(l) for l, r in on.items()]))


def relative_deviation(value: Column, base: Column) -> Column:
    return F.try_divide(F.abs(value - base), value)


def rows_matching_any(df: DataFrame, *conditions: Column) -> DataFrame:
    """Rows for which at least one condition is true (a null condition is not)."""
    matched = F.lit(False)
    for c in conditions:
        matched = matched | F.coalesce(c, F.lit(False))
    return df.filter(matched)
