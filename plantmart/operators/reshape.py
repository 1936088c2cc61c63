"""Wide and long forms of a membership table, and inverse mappings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .ranking import number_distinct


def value_list(df: DataFrame, column: str) -> list[str]:
    """The different values of a dictionary-like column, for use as column names.

    The result is a table's header, so the driver must see it. Where a header makes no sense (ids, texts) use
    ``complement_pairs`` or keep the long form.
    """
    return sorted(r[0] for r in df.select(column).filter(F.col(column).isNotNull()).distinct().collect())


def membership_matrix(df: DataFrame, key: str, value: str, values: Sequence[str], prefix: str) -> DataFrame:
    """One row per key, one Yes/No column per value. Only partial aggregates, any key may be hot."""
    return df.groupBy(key).agg(
        *[
            F.when(F.coalesce(F.max(F.col(value) == v), F.lit(False)), "Yes").otherwise("No").alias(f"{prefix}{v}")
            for v in values
        ]
    )


def unpivot(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(columns), name, value)


CHUNK = 1024  # values of a domain that are compared with a key's values together


def complement_pairs(
    pairs: DataFrame, key: str, value: str, keys: DataFrame | None = None, values: DataFrame | None = None
) -> DataFrame:
    """All (key, value) combinations that do not occur in ``pairs``; a null value is no value.

    ``keys`` and ``values`` (same column names) widen the two domains. The values are numbered, and each key meets the numbers in chunks of
    ``CHUNK``: the numbers that it has in a chunk, at most as many, are taken from the chunk's range. So no task holds the
    domain, or all values of a key, and rows are made only for pairs that are missing.
    """
    has = pairs.select(key, value).filter(F.col(value).isNotNull())
    all_keys = pairs.select(key) if keys is None else pairs.select(key).unionByName(keys.select(key))
    domain = (pairs if values is None else values).select(value).filter(F.col(value).isNotNull()).distinct()
    numbered = cut_lineage(number_distinct(domain, [value], "__n"))
    n = numbered.count()
    if not n:
        return has.limit(0)
    chunk = F.floor(F.col("__n") / CHUNK).cast("long")
    own = has.join(numbered, value).groupBy(key, chunk.alias("__chunk")).agg(F.collect_set("__n").alias("__own"))
    each = all_keys.distinct().select(key, F.explode(F.sequence(*(F.lit(x).cast("long") for x in (0, (n - 1) // CHUNK)))).alias("__chunk"))
    met = each.join(
        own.select(F.col(key).alias("__key"), F.col("__chunk").alias("__c"), "__own"),
        F.col(key).eqNullSafe(F.col("__key")) & (F.col("__chunk") == F.col("__c")), "left",
    )
    first = F.col("__chunk") * F.lit(CHUNK).cast("long")
    whole = F.sequence(first, F.least(first + (CHUNK - 1), F.lit(n - 1).cast("long")))
    missing = F.array_except(whole, F.coalesce("__own", F.array().cast("array<bigint>")))
    return met.select(key, F.explode(missing).alias("__n")).join(numbered, "__n").select(key, value)


def with_inverse(df: DataFrame, source: str, target: str, rate: str) -> DataFrame:
    """Every mapping row plus its inverse: ends swapped, rate replaced by its reciprocal."""
    swapped = {source: F.col(target), target: F.col(source), rate: F.try_divide(F.lit(1.0), F.col(rate))}
    both = df.withColumn("__way", F.explode(F.array(F.lit(0), F.lit(1))))
    return both.select(
        *[
            F.when(F.col("__way") == 0, F.col(c)).otherwise(swapped[c]).alias(c) if c in swapped else F.col(c)
            for c in df.columns
        ]
    )
