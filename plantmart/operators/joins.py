"""Joins by effect: defaults for misses, reconciliation, brackets, overrides, neighbours in time.

No side is hinted: Spark decides by size, at run time where a size is only known then, and adaptive execution splits a hot key.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_HIT = "__hit"


def _column(value: Any) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def only_members(df: DataFrame, members: DataFrame, on: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``members``."""
    return _membership(df, members, on, "left_semi")


def without_members(df: DataFrame, members: DataFrame, on: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``members``; a null in ``members`` excludes nothing."""
    return _membership(df, members, on, "left_anti")


def _membership(df, members, on, how):
    pairs = on if isinstance(on, Mapping) else {c: c for c in on}
    # Distinct first: a hot member key is one row on the probing side.
    keys = members.select(*[F.col(r).alias(f"__m_{l}") for l, r in pairs.items()]).distinct()
    condition = [F.col(l) == F.col(f"__m_{l}") for l in pairs]
    return df.join(keys, condition, how)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` unchanged when ``keys`` is unique in it; the job fails on a duplicate key."""
    rest = [c for c in df.columns if c not in keys]
    grouped = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"), F.first(F.struct(*[F.col(c) for c in [*keys, *rest]])).alias("__row")
    )
    message = F.concat(F.lit("duplicate key in lookup: "), F.to_json(F.struct(*[F.col(c) for c in keys])))
    row_type = grouped.schema["__row"].dataType
    checked = grouped.select(
        F.when(F.col("__n") == 1, F.col("__row")).otherwise(F.raise_error(message).cast(row_type)).alias("__row")
    )
    return checked.select(*[F.col(f"__row.{c}").alias(c) for c in df.columns])


def lookup(df: DataFrame, dimension: DataFrame, on: Sequence[str], unique: bool = True) -> DataFrame:
    """Left join to a dimension; a duplicate dimension key is an error unless ``unique=False``."""
    return df.join(assert_unique(dimension, on) if unique else dimension, list(on), "left")


def left_join_with_defaults(
    left: DataFrame, right: DataFrame, on: Sequence[str], defaults: Mapping[str, Any]
) -> DataFrame:
    """Left join; on rows without a match each column in ``defaults`` takes its default.

    A matched row keeps the right side's values, nulls included. Defaults may refer to any joined column.
    """
    joined = left.join(right.withColumn(_HIT, F.lit(True)), list(on), "left")
    miss = F.col(_HIT).isNull()
    return joined.withColumns(
        {c: F.when(miss, _column(v)).otherwise(F.col(c)) for c, v in defaults.items()}
    ).drop(_HIT)


@dataclass(frozen=True)
class Reconciled:
    """The three sides of a full comparison."""

    matched: DataFrame
    left_only: DataFrame
    right_only: DataFrame


def reconcile(left: DataFrame, right: DataFrame, on: Mapping[str, str]) -> Reconciled:
    """Split two sources by whether their keys meet (left column -> right column, names disjoint).

    Written as an inner join and two anti joins against distinct keys instead of one full outer join: adaptive
    execution can split a hot key in these forms but not in a full outer join, and each branch is its own frame.
    Rows with a null in the key match nothing and stay on their own side.
    """
    condition = [F.col(l) == F.col(r) for l, r in on.items()]
    return Reconciled(
        matched=left.join(right, condition, "inner"),
        left_only=without_members(left, right, on),
        right_only=without_members(right, left, {r: l for l, r in on.items()}),
    )


# Value ranges of a bracket join: this many to each doubling of the value, and the last doubling of a double.
RANGES_PER_DOUBLING = 4
LAST_DOUBLING = 1025


def value_range(value: Column, per_doubling: int = RANGES_PER_DOUBLING) -> Column:
    """Number of the value's range, never falling as the value rises; the ranges widen with the value, so that any two
    doubles are at most some thousand ranges apart. NaN is in the last range, null in none."""
    doublings = F.log1p(F.abs(value.cast("double"))) * F.lit(per_doubling / math.log(2.0))
    size = F.least(doublings, F.lit(float(LAST_DOUBLING * per_doubling)))
    return F.when(value < 0, -F.floor(size)).otherwise(F.floor(size)).cast("int")


def bracket_join(
    df: DataFrame, brackets: DataFrame, on: Sequence[str], value: str, low: str, high: str
) -> DataFrame:
    """Left join to the brackets with ``low <= value < high`` among those of the same key.

    Key and value range together are the join key: a bracket is cut into one piece for each range it reaches, so rows
    of one frequent key go to many tasks, and a row meets only the brackets near its value. A null value, a null
    border and a bracket without width match nothing; overlapping brackets each match.
    """
    b = brackets.select(*[F.col(c).alias(f"__b_{c}") if c in on else F.col(c) for c in brackets.columns])
    first, last = value_range(F.col(low)), value_range(F.col(high))
    pieces = b.filter(first <= last).withColumn("__piece", F.explode(F.sequence(first, last)))
    condition = (F.col("__range") == F.col("__piece")) & (F.col(value) >= F.col(low)) & (F.col(value) < F.col(high))
    for c in on:
        condition = condition & (F.col(c) == F.col(f"__b_{c}"))
    ranged = df.withColumn("__range", value_range(F.col(value)))
    return ranged.join(pieces, condition, "left").drop("__range", "__piece", *[f"__b_{c}" for c in on])


def conditional_lookup(df: DataFrame, dimension: DataFrame, on: Sequence[str], when: Column) -> DataFrame:
    """Left join that only matches rows satisfying ``when``; the others keep nulls."""
    d = dimension.select(*[F.col(c).alias(f"__d_{c}") if c in on else F.col(c) for c in dimension.columns])
    condition = when
    for c in on:
        condition = condition & (F.col(c) == F.col(f"__d_{c}"))
    return df.join(d, condition, "left").drop(*[f"__d_{c}" for c in on])


def override(
    df: DataFrame, target: str, layers: Sequence[tuple[DataFrame, Sequence[str], str]]
) -> DataFrame:
    """Apply rule tables in order; each match replaces ``target``, so the last matching layer wins.

    A layer is (rules, key columns, value column). Rule keys must be unique, else the job fails.
    """
    out = df
    for rules, keys, value in layers:
        rule = assert_unique(rules.select(*keys, F.col(value).alias("__value")), keys)
        out = out.join(rule, list(keys), "left")
        out = out.withColumn(target, F.coalesce(F.col("__value"), F.col(target))).drop("__value")
    return out


def join_back(df: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """Add group aggregates to the detail rows.

    Aggregate and join rather than a window: the aggregate is combined on the map side and the join can split a
    hot key, while a window would put the whole group into one task.
    """
    return df.join(df.groupBy(*keys).agg(*aggregates), list(keys), "left")


def _neighbours(valid_from: str, valid_to: str, values: Sequence[str], as_of: Column) -> tuple[Column, Column]:
    """Aggregates: the next future and the most recent past validity, each with its values."""
    start, end = F.col(valid_from), F.col(valid_to)
    item = F.struct(start.alias("from"), end.alias("to"), *[F.col(v).alias(v) for v in values])
    ahead = (start > as_of) & (end > as_of)
    behind = (start < as_of) & (end < as_of)
    return F.min_by(item, F.when(ahead, item)), F.max_by(item, F.when(behind, F.struct(end.alias("to"), item.alias("item"))))


def _named_neighbours(valid_from: str, valid_to: str, values: Sequence[str]) -> list[Column]:
    return [
        c
        for name, prefix in (("__f", "future"), ("__p", "previous"))
        for c in (
            F.col(f"{name}.from").alias(f"{prefix}_{valid_from}"),
            F.col(f"{name}.to").alias(f"{prefix}_{valid_to}"),
            *[F.col(f"{name}.{v}").alias(f"{prefix}_{v}") for v in values],
        )
    ]


def neighbours_in_time(
    df: DataFrame, keys: Sequence[str], valid_from: str, valid_to: str, values: Sequence[str], as_of: Column
) -> DataFrame:
    """Add the next future and the most recent past validity of each key, seen from ``as_of``.

    Future: starts and ends after ``as_of``, earliest start wins. Past: starts and ends before, latest end wins.
    Both come from one aggregate; ties fall to the higher remaining columns.
    """
    future, past = _neighbours(valid_from, valid_to, values, as_of)
    picked = df.groupBy(*keys).agg(future.alias("__f"), past.alias("__p"))
    return df.join(picked.select(*keys, *_named_neighbours(valid_from, valid_to, values)), list(keys), "left")


def neighbours_by_window(
    df: DataFrame, keys: Sequence[str], valid_from: str, valid_to: str, values: Sequence[str], as_of: Column
) -> DataFrame:
    """The same where a key has few rows and ``df`` is already dealt out by some of the keys: a window, without a shuffle of its own."""
    future, past = _neighbours(valid_from, valid_to, values, as_of)
    window, whole = Window.partitionBy(*keys), ~F.expr(" OR ".join(f"`{k}` IS NULL" for k in keys))
    rows = df.withColumns({"__f": F.when(whole, future.over(window)), "__p": F.when(whole, past.over(window))})
    return rows.select(*df.columns, *_named_neighbours(valid_from, valid_to, values))
