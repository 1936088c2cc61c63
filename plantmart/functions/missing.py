"""One notion of "missing" for text and numbers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_or_null(column: Column, words: Sequence[str] = ("", "nan", "NULL")) -> Column:
    """Null for text that stands for a missing value."""
    return F.when(~column.isin(*words), column)


def text_or_blank(column: Column, words: Sequence[str] = ("nan", "NULL")) -> Column:
    """Blank for null and for text that stands for a missing value."""
    return F.coalesce(text_or_null(column, ("", *words)), F.lit(""))


def number_or_null(column: Column) -> Column:
    """Null for NaN."""
    return F.nanvl(column, F.lit(None).cast("double"))


def first_valid(first: Column, second: Column, numeric: bool = False) -> Column:
    """``first`` unless it is missing (for numbers: null or NaN), else ``second``."""
    return F.coalesce(number_or_null(first) if numeric else first, second)


def is_missing(column: Column, numeric: bool = False) -> Column:
    return column.isNull() | F.isnan(column) if numeric else column.isNull()


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace nulls per column; an unknown column name is an error."""
    unknown = set(values) - set(df.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    return df.fillna(dict(values))


def not_equal_or_null(column: Column, value: object) -> Column:
    """``column != value`` that keeps nulls."""
    return ~column.eqNullSafe(F.lit(value))
