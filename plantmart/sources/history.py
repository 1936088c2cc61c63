"""Keyed upsert into stored, partitioned history."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .files import path_exists

_AGE = "__age"


def merge_history(
    new: DataFrame, history: DataFrame, keys: Sequence[str], order: Sequence[str] = (), by_release: bool = False
) -> DataFrame:
    """Union with one row per key; a new row replaces the stored one.

    ``order`` (higher first) decides between several new rows of one key. With ``by_release`` it decides against the stored row
    too, so that a late load of an older release changes nothing and the result doesn't depend on how rows are split into loads.
    """
    rows = new.withColumn(_AGE, F.lit(0)).unionByName(
        history.select(*new.columns).withColumn(_AGE, F.lit(1))
    )
    newest = [F.col(c).desc_nulls_last() for c in order]
    window = Window.partitionBy(*keys).orderBy(*([*newest, _AGE] if by_release else [_AGE, *newest]))
    return (
        rows.withColumn("__rank", F.row_number().over(window)).filter(F.col("__rank") == 1).drop("__rank", _AGE)
    )


def upsert(
    spark: SparkSession,
    new: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    order: Sequence[str] = (),
    buckets: int = 0,
    by_release: bool = False,
) -> DataFrame:
    """Merge ``new`` into the parquet history at ``path`` and return the stored table.

    ``partition_by`` must be columns that a key never changes (site, production day): only the partitions that
    ``new`` touches are read, merged and replaced, the rest of the history stays where it is. Where no such column divides the
    history finely enough, ``buckets`` adds one: a stable hash of the key, modulo this number. It is part of the column's name,
    so a history with another number of buckets is not taken for this one. The merged rows
    are written to the shared folder before the target is overwritten, so the job never reads what it replaces.
    A first load has no history; a history with other columns is an error, not an empty one.
    """
    wanted = new.columns
    if buckets:
        name = bucket_column(buckets)
        new, partition_by = new.withColumn(name, key_bucket(keys, buckets)), [*partition_by, name]
    columns = new.columns
    if path_exists(spark, path):
        new = cut_lineage(new)
        touched = new.select(*partition_by).distinct()
        stored = spark.read.schema(new.schema).parquet(path)
        known = set(spark.read.parquet(path).columns)
        if known != set(columns):
            raise ValueError(f"stored columns differ: {sorted(known ^ set(columns))}")
        # At most ``buckets`` numbers come to the driver.
        numbers = [r[0] for r in touched.select(name).distinct().collect()] if buckets else []
        pruned = stored.filter(F.col(name).isin(numbers)) if buckets else stored
        part = _touched_part(pruned, touched, partition_by)
        merged = cut_lineage(merge_history(new, part, keys, order, by_release))
    else:
        merged = merge_history(new, new.filter(F.lit(False)), keys, order, by_release)
    write_partitions(merged, path, partition_by)
    return spark.read.schema(new.schema).parquet(path).select(*wanted)


def bucket_column(buckets: int) -> str:
    return f"key_bucket_of_{buckets}"


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a key; the same for equal keys in every load, a null part included."""
    parts = [part for k in keys for part in (F.col(k).cast("string"), F.col(k).isNull())]
    return F.pmod(F.xxhash64(*parts), F.lit(buckets)).cast("int")


def _touched_part(stored: DataFrame, touched: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Stored rows of the touched partitions.

    The least and the greatest touched value of each partition column prune the scan (one row comes to the driver, whatever the
    load's size); the semi join then makes the selection exact.
    """
    bounds = touched.agg(
        *[f(c).alias(f"{k}_{c}") for c in partition_by for k, f in (("lo", F.min), ("hi", F.max))],
        *[F.coalesce(F.bool_or(F.col(c).isNull()), F.lit(False)).alias(f"null_{c}") for c in partition_by],
    ).first()
    pruned = stored
    for c in partition_by:
        keep = F.lit(False) if bounds[f"lo_{c}"] is None else F.col(c).between(bounds[f"lo_{c}"], bounds[f"hi_{c}"])
        pruned = pruned.filter(keep | F.col(c).isNull() if bounds[f"null_{c}"] else keep)
    keys = touched.select(*[F.col(c).alias(f"__t_{c}") for c in partition_by])
    return pruned.join(keys, [F.col(c).eqNullSafe(F.col(f"__t_{c}")) for c in partition_by], "left_semi")


def write_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace exactly the partitions present in ``df``; adaptive execution splits a large partition by its size."""
    (
        df.hint("rebalance", *[F.col(c) for c in partition_by])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )
