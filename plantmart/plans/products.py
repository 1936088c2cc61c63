"""Product tables: dimension, positioning statistics, blacklist, enrichment, competitiveness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import month_number
from ..functions.missing import number_or_null
from ..functions.text import padded, prefixes
from ..operators.aggregates import text_set
from ..operators.checks import completeness_check, missing
from ..operators.dedup import first_by, latest_by
from ..operators.joins import only_members, without_members
from ..operators.reshape import complement_pairs, membership_matrix

# Fixed values.
PACKED_TYPE = "YV"
ACTIVE_STATUS = 4
SALES_STATUS = (4, 7)
DIVISION = "75"
HIERARCHY = {"ph1": 2, "bu": 4, "pfam": 7, "pline": 10}
SAMPLE_SUFFIX = "S001"
OUT_OF_SCOPE = "Out of scope"
ENOUGH_CUSTOMERS = 5
ENOUGH_TRANSACTIONS = 10

PRODUCT_COLUMNS = [
    "prod_grp", "prod_number", "prod_descrp", "prod_type", "unpacked_product_code", "pfam", "pfam_descrp", "pline",
    "pline_descrp", "bu", "sales_org", "volume_index", "prod_chemistry", "vmsta",
]


def product_rules() -> list[tuple[str, Column]]:
    return [
        *missing(
            "prod_grp", "prod_number", "prod_descrp", "prod_type", "unpacked_product_code", "pfam", "pfam_descrp",
            "pline", "pline_descrp", "bu",
        ),
        ("sales_org", F.col("sales_org") == "#"),
        *missing("volume_index", "plant_of_origin", "prod_chemistry", "vmsta"),
    ]


def product_dimension(t: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Packed active products with hierarchy, status per sales unit and plants of origin; completeness report.

    ``t``: materials (matnr, maktx, prdha, mtart, mstae, unpacked_product_code), hierarchy_texts (PRODH, VTEXT,
    STUFE), sales_status (vkorg, matnr, vmsta), product_types (pfam, prod_type, chemistry), volume_index (pline,
    volume_index), material_plants (matnr, werks), plants (plant, plant_descrp), sales_orgs (sales_org_id).
    """
    materials = t["materials"]
    unpacked = first_by(
        materials.filter(F.col("mtart") != PACKED_TYPE).select(
            F.col("matnr").alias("unpacked_product_code"), F.col("maktx").alias("prod_grp")
        ),
        ["unpacked_product_code"],
        ["prod_grp"],
    )
    packed = materials.filter(
        (F.col("mstae").cast("string").try_cast("int") == ACTIVE_STATUS)
        & (F.col("mtart") == PACKED_TYPE)
        & ~F.col("maktx").endswith(SAMPLE_SUFFIX)
    ).select(
        F.col("matnr").alias("prod_number"),
        F.col("maktx").alias("prod_descrp"),
        "unpacked_product_code",
        *[c.alias(name) for name, c in prefixes(F.col("prdha"), HIERARCHY).items()],
    )
    packed = packed.filter(F.col("ph1") == DIVISION).drop("ph1").join(unpacked, "unpacked_product_code", "left")

    def texts(level: str, code: str) -> DataFrame:
        rows = t["hierarchy_texts"].filter(F.col("STUFE") == level)
        return rows.groupBy(F.col("PRODH").alias(code)).agg(F.min("VTEXT").alias(f"{code}_descrp"))

    def by_family(name: str, family: str, *columns: Column) -> DataFrame:
        rows = t[name].select(F.regexp_replace(family, "/", "").alias("pfam"), *columns)
        return first_by(rows, ["pfam"], [c for c in rows.columns if c != "pfam"])

    low, high = SALES_STATUS
    status = t["sales_status"].select(
        F.col("vkorg").cast("string").alias("sales_org"), F.col("matnr").alias("prod_number"), "vmsta"
    ).filter(F.col("vmsta").cast("string").try_cast("int").between(low, high))
    status = only_members(status, t["sales_orgs"].select(F.col("sales_org_id").cast("string").alias("sales_org")), ["sales_org"])
    # Plants are reduced to one text per product before they meet the sales units.
    plants = (
        t["material_plants"]
        .filter(F.col("matnr").isNotNull())
        .select(F.col("matnr").alias("prod_number"), F.col("werks").alias("plant"))
        .distinct()
        .join(t["plants"].select("plant", F.col("plant_descrp").alias("plant_of_origin")), "plant", "left")
        .groupBy("prod_number")
        .agg(text_set("plant_of_origin").alias("plant_of_origin"))
    )
    rows = (
        packed.join(by_family("product_types", "pfam", F.col("prod_type"), F.col("chemistry").alias("prod_chemistry")), "pfam", "left")
        .join(texts("3", "pfam"), "pfam", "left")
        .join(texts("4", "pline"), "pline", "left")
        .join(status, "prod_number", "inner")
        .join(by_family("volume_index", "pline", F.col("volume_index")), "pfam", "left")
        .join(plants, "prod_number", "left")
    )
    products = rows.select(*PRODUCT_COLUMNS, F.coalesce("plant_of_origin", F.lit("")).alias("plant_of_origin")).distinct()
    return {"products": products, "data_check": completeness_check(products, product_rules())}


def competitiveness(
    chemistry: DataFrame, geography: DataFrame, chemistry_factors: DataFrame, geography_factors: DataFrame
) -> DataFrame:
    """Chemistry positions per segment, one row per region of the segment, with both adjustment factors."""
    return (
        chemistry.select("ms_new", "chemistry", "competitive_position_chemistry")
        .join(
            geography.select("ms_new", F.col("region_ship_to").alias("region"), "competitive_position_geography"),
            "ms_new", "left",
        )
        .join(
            chemistry_factors.select("competitive_position_chemistry", "adjustment_factor_chemistry"),
            "competitive_position_chemistry", "left",
        )
        .join(
            geography_factors.select("competitive_position_geography", "adjustment_factor_geography"),
            "competitive_position_geography", "left",
        )
        .select(
            "ms_new", "chemistry", "competitive_position_chemistry", "adjustment_factor_chemistry", "region",
            "competitive_position_geography", "adjustment_factor_geography",
        )
    )


def usable_transactions(transactions: DataFrame) -> DataFrame:
    cost = number_or_null(F.col("current_vpc_kg_eur"))
    return transactions.filter(
        (F.col("rolling_12_month") == "Yes")
        & (F.col("transactional_vol_kg") > 0)
        & cost.isNotNull()
        & (cost != 0)
        & number_or_null(F.col("cmstd_kg_eur")).isNotNull()
    )


def transaction_statistics(transactions: DataFrame) -> DataFrame:
    """Customers, transactions, mean cost and mean margin per product group over the usable transactions."""
    return usable_transactions(transactions).groupBy("prod_grp").agg(
        F.count_distinct("cust_number").cast("double").alias("no_of_customers"),
        F.count("cmstd_kg_eur").cast("double").alias("no_of_sizeable_transactions"),
        F.avg("current_vpc_kg_eur").alias("pg_cost_stats"),
        F.avg("cmstd_kg_eur").alias("pg_cm_stats"),
    )


def forward_cost(costs: DataFrame) -> DataFrame:
    """Mean of the four regional costs in each product's newest month."""
    regions = ["emea", "nam", "latam", "apac"]
    total = F.coalesce(regions[0], F.lit(0.0))
    for r in regions[1:]:
        total = total + F.coalesce(r, F.lit(0.0))
    dated = costs.select(
        "unpacked_product_code", "year", month_number(F.col("month")).alias("__month"), (total / 4.0).alias("vpc")
    )
    return latest_by(dated, ["unpacked_product_code"], ["year", "__month", "vpc"]).select("unpacked_product_code", "vpc")


def positioning(
    transactions: DataFrame, products: DataFrame, costs: DataFrame, manual: DataFrame, sales_orgs: Sequence[str] | None = None
) -> DataFrame:
    """Cost and margin per product group, from transactions or else from forward costs, with the manual position.

    ``sales_orgs`` adds one ``sales_org_<code>`` Yes/No column per code: where the group is sold.
    """
    stats = transaction_statistics(transactions)
    silent = without_members(products.select("prod_grp", "unpacked_product_code"), stats, ["prod_grp"])
    planned = (
        silent.join(forward_cost(costs), "unpacked_product_code", "left")
        .groupBy("prod_grp")
        .agg(F.avg("vpc").alias("pg_cost_stats"))
        .select(
            "prod_grp",
            F.lit(0.0).alias("no_of_customers"),
            F.lit(0.0).alias("no_of_sizeable_transactions"),
            "pg_cost_stats",
            F.lit(0.0).alias("pg_cm_stats"),
        )
    )
    positions = first_by(manual.select("prod_grp", "pg_cost", "pg_cm"), ["prod_grp"], ["pg_cost", "pg_cm"])
    families = products.groupBy("prod_grp").agg(F.substring(F.min(F.col("pfam").cast("string")), 5, 3).alias("pfam"))
    out = (
        stats.unionByName(planned)
        .join(positions, "prod_grp", "left")
        .withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("pg_cost", "pg_cm")})
        .join(families, "prod_grp", "left")
    )
    if sales_orgs is None:
        return out
    matrix = membership_matrix(products, "prod_grp", "sales_org", sales_orgs, "sales_org_")
    flags = [f"sales_org_{o}" for o in sales_orgs]
    return out.join(matrix, "prod_grp", "left").fillna("No", subset=flags)


def blacklist(products: DataFrame, transactions: DataFrame) -> DataFrame:
    """(product group, sales unit) combinations that are not sold; units from products and transactions alike."""
    pairs = products.select("prod_grp", "sales_org")
    units = pairs.select("sales_org").unionByName(transactions.select("sales_org")).distinct()
    missing_pairs = complement_pairs(pairs, "prod_grp", "sales_org", values=units)
    return missing_pairs.select("prod_grp", F.upper("sales_org").alias("sales_org"))


def enriched_products(
    products: DataFrame, positions: DataFrame, transactions: DataFrame, scope: DataFrame
) -> dict[str, DataFrame]:
    """Products with line of business and average cost and margin; groups without a line of business.

    Statistics count from five customers and ten transactions on, else the manual position is used. The list of
    groups without a line of business is taken before rows out of scope are dropped (that filter also drops them).
    """
    business = latest_by(
        transactions.filter(F.col("rolling_12_month") == "Yes").select(
            padded(F.col("prod_number"), 18).alias("prod_number"), "ibg", "ibg_descrp", "fiscal_year", "month"
        ),
        ["prod_number", "ibg"],
        ["fiscal_year", "month", "ibg_descrp"],
    ).drop("fiscal_year", "month")
    scopes = first_by(
        scope.select(F.col("marketing_level_2").alias("ibg"), F.col("sbe").alias("bu_scope")), ["ibg"], ["bu_scope"]
    )
    rows = (
        products.drop("upload_date", "source_system")
        .withColumn("prod_number", padded(F.col("prod_number"), 18))
        .join(positions.drop("pfam"), "prod_grp", "left")
        .join(business, "prod_number", "left")
        .join(scopes, "ibg", "left")
    )
    enough = (F.col("no_of_customers") >= ENOUGH_CUSTOMERS) & (F.col("no_of_sizeable_transactions") >= ENOUGH_TRANSACTIONS)
    in_scope = rows.filter(F.col("bu_scope") != OUT_OF_SCOPE).withColumns(
        {
            "average_vpc_kg_eur": F.when(enough, F.col("pg_cost_stats")).otherwise(F.col("pg_cost").try_cast("double")),
            "average_cm_kg_eur": F.when(enough, F.col("pg_cm_stats")).otherwise(F.col("pg_cm").try_cast("double")),
            "sales_org": F.col("sales_org").cast("string"),
        }
    )
    columns = [
        "prod_grp", "prod_number", "prod_descrp", "prod_type", "unpacked_product_code", "pfam", "pfam_descrp", "pline",
        "pline_descrp", "bu", "ibg", "ibg_descrp", "sales_org", "volume_index", "plant_of_origin", "prod_chemistry",
        "average_vpc_kg_eur", "average_cm_kg_eur",
    ]
    gaps = rows.filter(F.col("ibg").isNull()).select(F.col("prod_grp").alias("produced_material"), F.col("ibg").alias("ml2"))
    return {"products": in_scope.select(*columns).distinct(), "missing_business": gaps.distinct()}
