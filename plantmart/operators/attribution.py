"""Gap filling with barriers: which order was a unit working on at each event?

Rules for every attribute (order, rate):

* a stop or change-over row forgets what was known before it;
* a blank row after a known value inherits that value;
* a change-over row, a blank row behind a barrier and a leading blank row take the *next* known value, unless a
  stop row comes first;
* a stop row itself stays empty.

Both directions are done in one pass over chunks (see ``ordered``): the chunk summary holds the last known item,
the first item that can answer a backward look, and whether the chunk opens with a blank that a carried value
would fill.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ordered as o


def _item(value: Column, is_barrier: bool) -> Column:
    return F.struct(value.alias("value"), F.lit(is_barrier).alias("barrier"))


def barrier_fill(
    df: DataFrame,
    attributes: Sequence[str],
    stop: Column,
    changeover: Column,
    by: Sequence[str],
    order: Sequence[str],
    chunk: Column | None,
) -> DataFrame:
    """Replace each attribute by its attributed value; a null attribute is a blank."""
    stop = F.coalesce(stop, F.lit(False))
    changeover = F.coalesce(changeover, F.lit(False))
    rows = o.cut(df, chunk).withColumns({"__stop": stop, "__barrier": stop | changeover})
    for a in attributes:
        empty = F.lit(None).cast(df.schema[a].dataType)
        known = F.when(F.col("__barrier"), _item(empty, True)).when(F.col(a).isNotNull(), _item(F.col(a), False))
        rows = rows.withColumn(f"__known_{a}", known)

    at = o.ordering(order)
    parts = []
    for a in attributes:
        known = F.col(f"__known_{a}")
        answers = F.when(F.col("__stop") | ~F.col("__barrier"), known)
        parts += [
            F.max_by(known, F.when(known.isNotNull(), at)).alias(f"__last_{a}"),
            F.min_by(known.isNull(), at).alias(f"__opens_blank_{a}"),
            F.min_by(answers, F.when(answers.isNotNull(), at)).alias(f"__answer_{a}"),
        ]
    seeds = []
    if chunk is not None:
        chunks = rows.groupBy(*by, o.CHUNK).agg(*parts)
        units = o.across(by)
        chunks = chunks.withColumns(
            {f"__in_{a}": F.last(f"__last_{a}", ignorenulls=True).over(o.strictly_before(units)) for a in attributes}
        )
        chunks = chunks.withColumns(
            {
                f"__offer_{a}": F.when(
                    F.col(f"__opens_blank_{a}") & F.coalesce(~F.col(f"__in_{a}.barrier"), F.lit(False)),
                    F.col(f"__in_{a}"),
                ).otherwise(F.col(f"__answer_{a}"))
                for a in attributes
            }
        )
        before = chunks.select(
            *by, o.CHUNK, *[F.col(f"__in_{a}").alias(f"__known_{a}") for a in attributes], F.lit(o.BEFORE).alias(o.SEED)
        )
        after = chunks.select(
            *by,
            o.CHUNK,
            *[
                F.first(f"__offer_{a}", ignorenulls=True).over(o.strictly_after(units)).alias(f"__known_{a}")
                for a in attributes
            ],
            F.lit(o.AFTER).alias(o.SEED),
        )
        seeds = [before, after]

    window = o.inside(by, order)
    seeded = o.with_seeds(rows, *seeds)
    seeded = seeded.withColumns(
        {f"__fwd_{a}": F.last(f"__known_{a}", ignorenulls=True).over(o.until_now(window)) for a in attributes}
    )
    # What a row offers to the rows in front of it: a stop answers "nothing", a filled row its value.
    offer = {}
    for a in attributes:
        filled = F.when(F.col(f"__fwd_{a}.barrier"), F.lit(None)).otherwise(F.col(f"__fwd_{a}"))
        offer[f"__offer_{a}"] = (
            F.when(F.col(o.SEED) == o.AFTER, F.col(f"__known_{a}"))
            .when(F.col(o.SEED) == o.BEFORE, F.lit(None))
            .when(F.col("__stop"), F.col(f"__known_{a}"))
            .when(~F.col("__barrier"), filled)
        )
    seeded = seeded.withColumns(offer)
    seeded = seeded.withColumns(
        {f"__back_{a}": F.first(f"__offer_{a}", ignorenulls=True).over(o.from_now(window)) for a in attributes}
    )
    result = seeded.withColumns({a: F.when(~F.col("__stop"), F.col(f"__back_{a}.value")) for a in attributes})
    helpers = [f"__{p}_{a}" for a in attributes for p in ("known", "fwd", "offer", "back")]
    return o.drop_seeds(result).drop("__stop", "__barrier", *helpers)
