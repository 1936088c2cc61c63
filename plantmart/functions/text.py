"""Names and text keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def snake_case(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def trim_text(df: DataFrame) -> DataFrame:
    """Trim the text columns; other types stay as they are."""
    return df.withColumns({f.name: F.trim(f.name) for f in df.schema if isinstance(f.dataType, StringType)})


def with_prefix(df: DataFrame, prefix: str, columns: Sequence[str] | None = None) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in (df.columns if columns is None else columns)})


def drop_strict(df: DataFrame, *columns: str) -> DataFrame:
    """Drop columns that must exist."""
    unknown = set(columns) - set(df.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    return df.drop(*columns)


def padded(column: Column, width: int) -> Column:
    """Fixed-width key with leading zeros."""
    return F.lpad(column.cast("string"), width, "0")


def without_leading_zeros(column: Column) -> Column:
    return F.ltrim(F.rtrim(column), F.lit("0"))


def first_token(column: Column, separators: Sequence[str], keep: str | None = None) -> Column:
    """Text before the first of any separator; the value ``keep`` is left whole."""
    out = column
    for s in separators:
        out = F.split_part(out, F.lit(s), F.lit(1))
    return out if keep is None else F.when(column == keep, column).otherwise(out)


def prefixes(column: Column, lengths: dict[str, int]) -> dict[str, Column]:
    """Hierarchy levels as prefixes of one code; a missing code gives blanks."""
    code = F.coalesce(column.cast("string"), F.lit(""))
    return {name: F.substring(code, 1, n) for name, n in lengths.items()}


def joined_key(*columns: str | Column) -> Column:
    """Concatenation that is null when any part is null."""
    return F.concat(*[F.col(c) if isinstance(c, str) else c for c in columns])
