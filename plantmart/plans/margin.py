"""Margin matrix: slices of region x customer group x product group, their volume bracket and margin level."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import joined_key, padded
from ..operators.checks import relative_deviation, rows_matching_any
from ..operators.joins import bracket_join, lookup, override
from ..operators.ordered import occurrence_index
from ..session import cut_lineage

SLICE = "rxcxp"
SLICE_KEYS = [SLICE, "prod_grp"]
MONTH_PARTS = 1024


def slice_key() -> Column:
    return joined_key("cxp_region", F.lit("-"), "cust_grp_adj", F.lit("-"), "prod_grp")


def unit_economics() -> list[dict[str, Column]]:
    """Cost, price and margin per kilogram and in total; the second step uses the first."""
    volume = F.col("transactional_vol_kg")
    parts = ["reb_kg_eur", "current_vpc_kg_eur", "frght_kg_eur", "othvse_kg_eur"]
    total = F.col(parts[0]) * volume
    for c in parts[1:]:
        total = total + F.col(c) * volume
    return [
        {"cost_eur_kg": F.try_divide(total, volume), "new_price_eur_kg": F.col("giv_kg_eur")},
        {"new_cm_eur_kg": F.col("new_price_eur_kg") - F.col("cost_eur_kg")},
        {"new_cm_abs": F.col("new_cm_eur_kg") * volume},
    ]


def priced(transactions: DataFrame) -> DataFrame:
    """Transactions of the last twelve months with family, slice and unit economics."""
    rows = transactions.filter(F.col("rolling_12_month") == "Yes").fillna(
        0.0, subset=["reb_kg_eur", "frght_kg_eur", "othvse_kg_eur"]
    )
    rows = rows.withColumn("pfam", joined_key("bu", F.lit("/"), padded(F.col("pfam"), 3)))
    rows = rows.withColumns({"giv_abs": F.col("giv_kg_eur") * F.col("transactional_vol_kg"), SLICE: slice_key()})
    for step in unit_economics():
        rows = rows.withColumns(step)
    return rows


def with_volume_index(rows: DataFrame, volume_index: DataFrame) -> DataFrame:
    return lookup(rows, volume_index.select(F.col("pline").alias("pfam"), "volume_index").distinct(), ["pfam"])


def with_bracket(rows: DataFrame, brackets: DataFrame) -> DataFrame:
    limits = brackets.select(
        "volume_index", F.col("min").alias("__lo"), F.col("max").alias("__hi"), F.col("bracket").alias("yearly_volume_bracket")
    ).distinct()
    return bracket_join(rows, limits, ["volume_index"], "yearly_volume_rxcxp", "__lo", "__hi").drop("__lo", "__hi")


def with_managers(rows: DataFrame, managers: DataFrame) -> DataFrame:
    rules = managers.select(
        F.col("ml2").alias("ibg"), F.col("customer").alias("cust_number"), "sales_org", "am_responsible"
    )
    return override(
        rows,
        "account_manager",
        [
            (rules.filter(F.col("cust_number").isNotNull()), ["ibg", "cust_number", "sales_org"], "am_responsible"),
            (rules.filter(F.col("cust_number").isNull()), ["ibg", "sales_org"], "am_responsible"),
        ],
    )


def margin_matrix(
    transactions: DataFrame,
    volume_index: DataFrame,
    brackets: DataFrame,
    managers: DataFrame,
    order: Sequence[str] | None = None,
    chunk: Column | None = None,
) -> dict[str, DataFrame]:
    """Transactions with their slice's margin level, three summaries, and the outlier sample.

    ``order`` decides which row is a slice's first; that row carries the slice margin, the others 0, and the
    product-group mean runs over all of them. Manager rules: the customer's own rule first, then the general rule
    of the line of business replaces it. ``chunk`` cuts large slices and must follow ``order``. By default rows are
    numbered by month and, within it, by a hash of product and customer, which also cuts each month into parts.
    """
    month = F.col("fiscal_year").cast("int") * 12 + F.col("month").cast("int")
    if order is None:
        order = ["fiscal_year", "month", "__part", "prod_number", "cust_number", "transactional_vol_kg", "giv_kg_eur"]
        chunk = month * MONTH_PARTS + F.col("__part")
    elif chunk is None:
        chunk = month
    transactions = transactions.withColumn(
        "__part", F.pmod(F.xxhash64("prod_number", "cust_number", "transactional_vol_kg", "giv_kg_eur"), F.lit(MONTH_PARTS))
    )
    rows = with_volume_index(priced(transactions), volume_index)
    levels = slice_levels(rows, order)
    first = F.col("instance_rxcxp") == 1
    rows = occurrence_index(rows, [SLICE], order, chunk, "instance_rxcxp").drop("__part").join(levels, SLICE_KEYS, "left")
    rows = rows.withColumns(
        {
            "avg_rxcxp_cm_kg_eur": F.when(first, F.col("__level")).otherwise(0.0),
            "avg_pg_cm_kg_eur": F.when(first, F.col("avg_pg_cm_kg_eur")),
        }
    ).drop("__level")
    rows = with_managers(with_bracket(rows, brackets), managers)
    share = F.try_divide(F.col("avg_rxcxp_cm_kg_eur"), F.col("avg_pg_cm_kg_eur"))
    # Five tables read these rows; they are written once.
    rows = cut_lineage(rows.withColumn("avg_rxcxp_cm_perc", F.when(first, share).otherwise(0.0)))
    return {
        "base": rows,
        "by_bracket": level_by(rows, "yearly_volume_bracket", "volume_bracket"),
        "by_segment": level_by(rows, "cust_segment", "customer_size"),
        "by_region": level_by(rows, "country_grp", "country_grp"),
        "outliers": outliers(rows),
    }


def slice_levels(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Volume, margin and margin level per slice, with the mean level of its product group.

    Only a slice's first row carries its level and the other rows count as 0, so the mean over all rows of a product group
    follows from one line per slice: its level and how many of its rows have a figure. Rows without a slice are numbered as one
    slice over all product groups; its first row has no level and leaves the mean of its own group only.
    """
    return levels_of(
        rows.groupBy(*SLICE_KEYS).agg(
            F.sum("transactional_vol_kg").alias("yearly_volume_rxcxp"),
            F.sum("new_cm_abs").alias("total_rxcxp_cm_abs"),
            F.count(F.lit(1)).alias("__n"),
            F.min(F.struct(*order)).alias("__first"),
        )
    )


def levels_of(slices: DataFrame) -> DataFrame:
    """The same from the totals of each slice and product group."""
    unnamed = slices.filter(F.col(SLICE).isNull()).agg(F.min("__first").alias("first")).select("first").scalar()
    level = F.try_divide(F.col("total_rxcxp_cm_abs"), F.col("yearly_volume_rxcxp"))
    slices = slices.withColumn("__level", F.when(F.col(SLICE).isNotNull(), level))
    numbered_first = F.col(SLICE).isNotNull() | (F.col("__first") == unnamed)
    counted = F.col("__n") - F.when(F.col("__level").isNull() & numbered_first, 1).otherwise(0)
    groups = slices.groupBy("prod_grp").agg(
        F.try_divide(F.coalesce(F.sum("__level"), F.lit(0.0)), F.sum(counted)).alias("avg_pg_cm_kg_eur")
    ).withColumnRenamed("prod_grp", "__group")
    out = slices.join(groups, F.col("prod_grp").eqNullSafe(F.col("__group")), "left")
    return out.drop("__n", "__first", "__group")


# What the summaries tell rows apart by.
GROUP_KEYS = [*SLICE_KEYS, "volume_index", "account_manager", "cust_segment", "country_grp"]


def margin_groups(
    transactions: DataFrame, volume_index: DataFrame, brackets: DataFrame, managers: DataFrame, order: Sequence[str]
) -> DataFrame:
    """The rows of ``margin_matrix`` totalled by slice, volume index, manager, segment and country, with their bracket.

    Rows are added up before they are shuffled: only a slice's first row (``order``) carries the slice's margin, so it is the least of
    the groups' first rows. ``n`` rows, ``firsts`` (1 in the group that holds the first row), and the sums of ``new_cm_abs``,
    ``avg_rxcxp_cm_kg_eur`` and ``avg_rxcxp_cm_perc``, which are null if no row has a figure; ``figures`` rows have a percentage.
    """
    rows = with_managers(with_volume_index(priced(transactions), volume_index), managers)
    groups = rows.groupBy(*GROUP_KEYS).agg(
        F.sum("transactional_vol_kg").alias("__volume"), F.sum("new_cm_abs").alias("new_cm_abs"),
        F.count(F.lit(1)).alias("n"), F.min(F.struct(*order)).alias("__first"),
    )
    # Slices and brackets are both taken from the groups.
    groups = cut_lineage(groups)
    levels = levels_of(
        groups.groupBy(*SLICE_KEYS).agg(
            F.sum("__volume").alias("yearly_volume_rxcxp"), F.sum("new_cm_abs").alias("total_rxcxp_cm_abs"),
            F.sum("n").alias("__n"), F.min("__first").alias("__first"),
        )
    )
    item = F.struct("__first", *GROUP_KEYS[1:])
    least = groups.groupBy(F.col(SLICE).alias("__slice")).agg(F.min(item).alias("__least"))
    found = groups.join(least, F.col(SLICE).eqNullSafe(F.col("__slice"))).withColumn("firsts", item.eqNullSafe(F.col("__least")).cast("int"))
    found = found.drop("__slice", "__least", "__first").join(levels, SLICE_KEYS, "left")
    first, alone = F.col("firsts") == 1, F.col("n") == 1

    def total(figure: Column) -> Column:
        """The first row's figure; the other rows have 0."""
        return F.when(first & alone, figure).when(first, F.coalesce(figure, F.lit(0.0))).otherwise(0.0)

    share = F.try_divide(F.col("__level"), F.col("avg_pg_cm_kg_eur"))
    found = found.withColumns(
        {
            "avg_rxcxp_cm_kg_eur": total(F.col("__level")),
            "avg_rxcxp_cm_perc": total(share),
            "figures": F.col("n") - F.when(first & share.isNull(), 1).otherwise(0),
        }
    )
    return with_bracket(found, brackets).drop("__level", "__volume")


def group_level_by(groups: DataFrame, column: str, name: str) -> DataFrame:
    """``level_by`` on the groups."""
    mean = F.try_divide(F.sum("avg_rxcxp_cm_perc"), F.sum("figures"))
    return groups.groupBy(F.col(column).alias(name)).agg(F.round(mean * 100, 2).alias("percentage"))


def level_by(rows: DataFrame, column: str, name: str) -> DataFrame:
    """Mean margin level in percent."""
    return rows.groupBy(F.col(column).alias(name)).agg(
        F.round(F.avg("avg_rxcxp_cm_perc") * 100, 2).alias("percentage")
    )


def outliers(rows: DataFrame) -> DataFrame:
    """Rows worth a manual look: odd cost, negative margin, tiny volume, or a cost that moved by 10 % or more."""
    cost = F.col("cost_eur_kg")
    return rows_matching_any(
        rows,
        cost == 0,
        cost > 10,
        F.col("new_cm_eur_kg") < 0,
        F.col("new_cm_abs") < 0,
        F.col("cmstd_kg_eur") < 0,
        F.col("transactional_vol_kg") < 500,
        relative_deviation(F.col("vpc_kg_eur"), F.col("current_vpc_kg_eur")) >= 0.1,
    )
