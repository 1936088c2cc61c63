"""Exact global positions without a single-task sort: surrogate ids and quantiles.

Rows are range-partitioned by the sort key (boundaries sampled by Spark, so a skewed key space is spread evenly)
and sorted per partition. The numbered rows are written to the shared folder once, which fixes the boundaries for
both uses of them: a count per partition (as many rows as partitions) and the rows themselves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

# monotonically_increasing_id: partition in the bits above the 33rd, row within the partition below.
_ROW_BITS = 33


def _placed(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Globally sorted rows with their partition number; ``order`` must be distinct, so that ranges can split it."""
    columns = [F.col(c).asc_nulls_first() for c in order]
    placed = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    placed = cut_lineage(placed.withColumn("__mid", F.monotonically_increasing_id()))
    return placed.withColumn("__part", F.shiftright("__mid", _ROW_BITS))


def _offsets(placed: DataFrame, weight: Column) -> DataFrame:
    """Total weight in front of each partition: one row per partition, so the unkeyed window is tiny."""
    totals = placed.groupBy("__part").agg(F.sum(weight).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    return totals.select("__part", F.coalesce(before, F.lit(0)).alias("__offset"))


def number_distinct(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """0-based global position of each row; no two rows may agree in ``order`` (nulls first)."""
    placed = _placed(df, order)
    within = F.col("__mid") - F.shiftleft(F.col("__part"), _ROW_BITS)
    return (
        placed.join(_offsets(placed, F.lit(1)), "__part")
        .withColumn(out, within + F.col("__offset"))
        .drop("__mid", "__part", "__offset")
    )


def total_in_front(df: DataFrame, order: Sequence[str], weight: str, out: str) -> DataFrame:
    """Add the total of ``weight`` over the rows before each row in ``order``; no two rows may agree in it (nulls first)."""
    placed = _placed(df, order)
    window = Window.partitionBy("__part").orderBy("__mid").rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.join(_offsets(placed, F.col(weight)), "__part")
        .withColumn(out, F.col("__offset") + F.coalesce(F.sum(weight).over(window), F.lit(0)))
        .drop("__mid", "__part", "__offset")
    )


def surrogate_ids(df: DataFrame, keys: Sequence[str], out: str = "unique_id", first: int = 880) -> DataFrame:
    """Add a dense id per key combination, ascending in key order from ``first``; null keys get one too."""
    ids = number_distinct(df.select(*keys).distinct(), keys, "__pos")
    ids = ids.select(*[F.col(k).alias(f"__k_{k}") for k in keys], (F.col("__pos") + first).alias(out))
    condition = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]
    return df.join(ids, condition, "left").drop(*[f"__k_{k}" for k in keys])


def exact_quantiles(df: DataFrame, column: str, probabilities: Mapping[str, float]) -> DataFrame:
    """One row with the named quantiles of the non-null values, linear between neighbouring ranks.

    Equal values are counted before they are sorted, so a value held by a third of all rows is one row here.
    """
    values = df.select(F.col(column).cast("double").alias("__v")).filter(F.col("__v").isNotNull())
    placed = _placed(values.groupBy("__v").agg(F.count(F.lit(1)).alias("__w")), ["__v"])
    running = Window.partitionBy("__part").orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = placed.join(_offsets(placed, F.col("__w")), "__part").withColumn(
        "__end", F.col("__offset") + F.sum("__w").over(running)
    )
    last = placed.agg((F.sum("__w") - 1).alias("n")).select("n").scalar()

    def value_at(rank: Column) -> Column:
        holds = (F.col("__end") - F.col("__w") <= rank) & (rank < F.col("__end"))
        return F.max(F.when(holds, F.col("__v")))

    ranked = ranked.withColumn("__last", last)
    picked = ranked.agg(
        F.max("__last").alias("last"),
        *[
            value_at(end(F.col("__last") * F.lit(p))).alias(f"{name}_{side}")
            for name, p in probabilities.items()
            for side, end in (("lo", F.floor), ("hi", F.ceil))
        ],
    )
    rank = {name: F.col("last") * F.lit(p) for name, p in probabilities.items()}
    return picked.select(
        *[
            (
                F.col(f"{name}_lo") + (F.col(f"{name}_hi") - F.col(f"{name}_lo")) * (r - F.floor(r))
            ).alias(name)
            for name, r in rank.items()
        ]
    )


def band_by_quantile(
    df: DataFrame, measure: str, bands: Sequence[tuple[str, float]], lowest: str, out: str
) -> DataFrame:
    """Label rows by exact quantiles of ``measure``: the first band whose quantile is reached, else ``lowest``.

    ``bands`` runs from the highest quantile down. The thresholds enter as scalar subqueries (one row).
    """
    thresholds = exact_quantiles(df, measure, {f"q{i}": p for i, (_, p) in enumerate(bands)})
    label: Column | None = None
    for i, (name, _) in enumerate(bands):
        reached = F.col(measure) >= thresholds.select(f"q{i}").scalar()
        label = F.when(reached, name) if label is None else label.when(reached, name)
    return df.withColumn(out, F.lit(lowest) if label is None else label.otherwise(lowest))
