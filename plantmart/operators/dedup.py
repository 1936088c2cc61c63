"""One row per key.

``row_number() == 1`` is planned by Spark as a group limit on both sides of the shuffle, so a key that holds a
large share of all rows leaves every map task as a single row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def _top(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the highest ``order`` per key; list enough columns to make the order total."""
    return _top(df, keys, [F.col(c).desc_nulls_last() for c in order])


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the lowest ``order`` per key, nulls last."""
    return _top(df, keys, [F.col(c).asc_nulls_last() for c in order])


def latest_release(df: DataFrame, keys: Sequence[str], release: str, order: Sequence[str]) -> DataFrame:
    """All rows carrying the same ``release`` as the group's highest-``order`` row.

    The winning release is found with a partial aggregate, then joined back; the join is one that adaptive
    execution can split when a group is hot.
    """
    ordering = F.struct(*[F.col(c) for c in order])
    winners = df.groupBy(*keys).agg(F.max_by(release, ordering).alias(release))
    return df.join(winners, [*keys, release], "inner")
