"""Ordered operators that never put one whole key into one task.

A unit's history can be a large share of the data, so a window over the whole unit does not scale. Each
operator here cuts a unit into chunks of its ordering column (an hour, by default), and works in two steps:

1. one aggregate per (unit, chunk), combined on the map side, and a window over those few rows per unit gives
   what each chunk must know about its neighbours (the last known value, the running total, the next start);
2. that knowledge enters the chunk as one *seed row* in front of or behind its rows, and an ordinary window
   over (unit, chunk) does the rest. Seed rows are dropped afterwards.

The detail rows are shuffled once. ``chunk`` must not decrease along ``order``. Without a ``chunk`` the whole
group is one window; use that only where groups are small by construction.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


CHUNK = "__chunk"
SEED = "__seed"
MEASURE = "__measure"
BEFORE, ROW, AFTER = -1, 0, 1
CHUNK_SECONDS = 3600


def time_chunk(ts: str | Column, seconds: int = CHUNK_SECONDS) -> Column:
    """Chunk number of a timestamp: whole ``seconds``-wide slots since the epoch."""
    column = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_timestamp(column.cast("timestamp")) / F.lit(seconds)).cast("long")


def cut(df: DataFrame, chunk: Column | None) -> DataFrame:
    return df.withColumn(CHUNK, F.lit(0).cast("long") if chunk is None else chunk.cast("long"))


def ordering(order: Sequence[str]) -> Column:
    """One comparable value for the order columns; a lone column stays primitive, which keeps hash aggregation."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*[F.col(c) for c in order])


def with_seeds(rows: DataFrame, *seeds: DataFrame) -> DataFrame:
    """Detail rows plus seed rows; columns a seed does not carry are null in it."""
    out = rows.withColumn(SEED, F.lit(ROW))
    for seed in seeds:
        out = out.unionByName(seed, allowMissingColumns=True)
    return out


def drop_seeds(df: DataFrame) -> DataFrame:
    return df.filter(F.col(SEED) == ROW).drop(SEED, CHUNK)


def inside(by: Sequence[str], order: Sequence[str]):
    """Window over one chunk of one unit, seeds in their place."""
    return Window.partitionBy(*by, CHUNK).orderBy(F.col(SEED), *[F.col(c).asc_nulls_first() for c in order])


def across(by: Sequence[str]):
    """Window over the chunk summaries of one unit."""
    return Window.partitionBy(*by).orderBy(CHUNK)


def until_now(window):
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def from_now(window):
    return window.rowsBetween(Window.currentRow, Window.unboundedFollowing)


def strictly_before(window):
    return window.rowsBetween(Window.unboundedPreceding, -1)


def strictly_after(window):
    return window.rowsBetween(1, Window.unboundedFollowing)


def next_value(
    df: DataFrame, value: str, by: Sequence[str], order: Sequence[str], chunk: Column | None, out: str
) -> DataFrame:
    """``value`` of the following row of the same unit; null on the unit's last row."""
    rows = cut(df, chunk)
    if chunk is None:
        return drop_seeds(with_seeds(rows).withColumn(out, F.lead(value).over(inside(by, order))))
    opening = F.min(value) if value == order[0] else F.min_by(value, ordering(order))
    first = rows.groupBy(*by, CHUNK).agg(opening.alias("__first"))
    seeds = first.select(
        *by, CHUNK, F.lead("__first").over(across(by)).alias(value), F.lit(AFTER).alias(SEED)
    ).filter(F.col(value).isNotNull())
    seeded = with_seeds(rows, seeds)
    return drop_seeds(seeded.withColumn(out, F.lead(value).over(inside(by, order))))


def forward_fill(
    df: DataFrame, columns: Mapping[str, str], by: Sequence[str], order: Sequence[str], chunk: Column | None
) -> DataFrame:
    """Last known value at or before each row; ``columns`` maps source column to result column."""
    rows = cut(df, chunk)
    seeds = []
    if chunk is not None:
        known = rows.groupBy(*by, CHUNK).agg(
            *[F.max_by(c, F.when(F.col(c).isNotNull(), ordering(order))).alias(c) for c in columns]
        )
        carried = known.select(
            *by,
            CHUNK,
            *[F.last(c, ignorenulls=True).over(strictly_before(across(by))).alias(c) for c in columns],
            F.lit(BEFORE).alias(SEED),
        )
        seeds = [carried.dropna("all", subset=list(columns))]
    window = until_now(inside(by, order))
    filled = with_seeds(rows, *seeds).withColumns(
        {out: F.last(c, ignorenulls=True).over(window) for c, out in columns.items()}
    )
    return drop_seeds(filled)


def backward_fill(
    df: DataFrame, columns: Mapping[str, str], by: Sequence[str], order: Sequence[str], chunk: Column | None
) -> DataFrame:
    """First known value at or after each row."""
    rows = cut(df, chunk)
    seeds = []
    if chunk is not None:
        known = rows.groupBy(*by, CHUNK).agg(
            *[F.min_by(c, F.when(F.col(c).isNotNull(), ordering(order))).alias(c) for c in columns]
        )
        seeds = [
            known.select(
                *by,
                CHUNK,
                *[F.first(c, ignorenulls=True).over(strictly_after(across(by))).alias(c) for c in columns],
                F.lit(AFTER).alias(SEED),
            )
        ]
    window = from_now(inside(by, order))
    filled = with_seeds(rows, *seeds).withColumns(
        {out: F.first(c, ignorenulls=True).over(window) for c, out in columns.items()}
    )
    return drop_seeds(filled)


def total_before(
    df: DataFrame, value: str, by: Sequence[str], order: Sequence[str], chunk: Column | None, out: str, whole: bool = False
) -> DataFrame:
    """Running total of ``value`` over the rows strictly before each row; 0 on the first row.

    ``whole``: the chunks of a unit are dealt to one task (each still a window of its own), for a reader that joins on the unit next.
    """
    # Summed in the widest type of its kind, as a total outgrows the measure's own type.
    integral = isinstance(df.schema[value].dataType, T.IntegralType)
    rows = cut(df, chunk).withColumn(MEASURE, F.col(value).cast("long") if integral else F.col(value))
    seeds = []
    if chunk is not None:
        sums = rows.groupBy(*by, CHUNK).agg(F.sum(MEASURE).alias("__sum"))
        carried = F.sum("__sum").over(strictly_before(across(by)))
        carried = carried.cast("long" if integral else df.schema[value].dataType)
        seeds = [
            sums.select(*by, CHUNK, carried.alias(MEASURE), F.lit(BEFORE).alias(SEED)).filter(F.col(MEASURE).isNotNull())
        ]
    window = strictly_before(inside(by, order))
    total = F.coalesce(F.sum(MEASURE).over(window), F.lit(0))
    seeded = with_seeds(rows, *seeds)
    seeded = seeded.repartition(*by) if whole else seeded
    return drop_seeds(seeded.withColumn(out, total)).drop(MEASURE)


def occurrence_index(
    df: DataFrame, by: Sequence[str], order: Sequence[str], chunk: Column | None, out: str
) -> DataFrame:
    """1 for the first row of a key, 2 for the second, and so on."""
    rows = cut(df, chunk).withColumn("__weight", F.lit(1).cast("long"))
    seeds = []
    if chunk is not None:
        counts = rows.groupBy(*by, CHUNK).agg(F.count(F.lit(1)).alias("__n"))
        seeds = [
            counts.select(
                *by,
                CHUNK,
                F.sum("__n").over(strictly_before(across(by))).alias("__weight"),
                F.lit(BEFORE).alias(SEED),
            ).filter(F.col("__weight").isNotNull())
        ]
    index = F.sum("__weight").over(until_now(inside(by, order)))
    return drop_seeds(with_seeds(rows, *seeds).withColumn(out, index)).drop("__weight")


def next_step(df: DataFrame, keys: Sequence[str], step: str, out: str, last: float) -> DataFrame:
    """Distinct (key, step) pairs with the next higher step of the key; ``last`` after the highest.

    Runs on the distinct steps only, so a group is as large as a key's list of different steps.
    """
    steps = df.select(*keys, step).distinct()
    window = Window.partitionBy(*keys).orderBy(F.col(step).asc_nulls_last())
    return steps.withColumn(out, F.coalesce(F.lead(step).over(window), F.lit(last)))
