"""Customer tables: size segments, customer dimension, enrichment with cost averages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import months_since, period_start, trailing_year_start
from ..functions.missing import first_valid, text_or_null
from ..functions.text import first_token, joined_key, padded
from ..operators.aggregates import exact_total
from ..operators.checks import completeness_check, missing
from ..operators.dedup import first_by, latest_by
from ..operators.joins import only_members, without_members
from ..operators.ranking import band_by_quantile
from ..session import cut_lineage

# Fixed values.
SEGMENTS = [("Large", 0.9), ("Medium", 0.8)]
SMALLEST_SEGMENT = "Small"
SOLD_TO_TYPE = "0001"
DELETED = "X"
OUT_OF_SCOPE = "Out of scope"
NO_CUSTOMER = "0000000000"
NO_GROUP = "#"
GLOBAL_OFFICE = "SALESGROUP GLOBAL"
LOCAL_SCRIPT = "C"
LOCAL_SCRIPT_COUNTRY = "CN"
CONDITION_TYPE = "YP00"
NO_PAYMENT_TERM = "missing in SAP"
RECENT_MONTHS = 6


def segments(t: Mapping[str, DataFrame], as_of: Column) -> DataFrame:
    """Customers with their group and its size: group margin of the trailing year against its 80 % and 90 % quantile.

    Active customers without any transaction are listed too; a customer whose group has no recent margin is small. Margins are added
    up as decimals, so that groups of equal margin are equal in any order of their rows and none is parted from a quantile between them.
    ``t``: transactions, group_mapping, customer_sales, customer_master.
    """
    mapping = first_by(
        t["group_mapping"].select(
            padded(F.col("customer_sold_to"), 10).alias("cust_number"),
            F.col("marketing_customer_ship_to_description").alias("__mapped"),
        ),
        ["cust_number"],
        ["__mapped"],
    )
    sales = t["transactions"].select(
        padded(F.col("sold_to_party"), 10).alias("cust_number"),
        F.col("sold_to_party_description").alias("cust_descrp"),
        F.col("consolidated_marginal_income_eur").cast("double").alias("cmstd_eur"),
        F.col("marketing_customer_sold_to").alias("cust_grp_adj"),
        period_start(F.col("fiscal_year"), F.col("posting_period")).alias("__day"),
    )

    def grouped(df: DataFrame) -> DataFrame:
        joined = df.join(mapping, "cust_number", "left")
        return joined.withColumn("cust_grp_adj", first_valid(F.col("cust_grp_adj"), F.col("__mapped"))).drop("__mapped")

    sales = grouped(sales)
    recent = sales.filter(F.col("__day") >= trailing_year_start(as_of))
    margins = recent.groupBy("cust_grp_adj").agg(exact_total("cmstd_eur").alias("__margin"))
    sized = band_by_quantile(margins, "__margin", SEGMENTS, SMALLEST_SEGMENT, "cust_segment").drop("__margin")

    master = t["customer_master"].select(
        padded(F.col("kunnr"), 10).alias("cust_number"),
        F.col("name1").alias("cust_descrp"),
        "ktokd",
        F.col("loevm").alias("__deleted"),
    )
    active = (
        t["customer_sales"]
        .select(padded(F.col("kunnr"), 10).alias("cust_number"), "loevm")
        .filter(F.col("loevm") != DELETED)
        .select("cust_number")
        .distinct()
        .join(master, "cust_number", "inner")
        .filter((F.col("__deleted") != DELETED) & (F.col("ktokd") == SOLD_TO_TYPE))
    )
    quiet = without_members(active, sales, ["cust_number"]).select(
        "cust_number", "cust_descrp", F.lit(None).cast("string").alias("cust_grp_adj")
    )
    names = ["cust_number", "cust_descrp", "cust_grp_adj"]
    everyone = sales.select(*names).unionByName(grouped(quiet).select(*names)).distinct()
    return everyone.join(sized, "cust_grp_adj", "left").fillna(SMALLEST_SEGMENT, subset=["cust_segment"])


CUSTOMER_COLUMNS = [
    "cust_grp_adj_id", "cust_grp_adj", "cust_size", "cust_number", "cust_descrp", "cust_descrp_chi",
    "country_soldto", "country_grp", "cust_classification", "old_am", "account_mgr", "ibg", "ibg_type",
    "cust_region", "order_cost_eur", "cust_payment_term", "base_currency", "base_unit", "condition_type",
    "order_cost_base_currency", "sales_org", "sales_off", "sales_off_descrp", "sales_off_email", "incoterm1",
    "incoterm2", "average_reb_kg_eur", "average_frght_kg_eur", "average_com_kg_eur",
]


def customer_rules() -> list[tuple[str, Column]]:
    """Completeness rules in the order in which the first hit becomes the remark."""
    return [
        *missing("cust_number"),
        ("account mgr = #", F.col("account_mgr") == NO_GROUP),
        *missing(
            "cust_descrp", "cust_grp_adj", "cust_grp_adj_id", "cust_size", "country_soldto", "country_grp",
            "cust_region", "ibg", "cust_classification", "order_cost_eur", "cust_payment_term", "base_currency",
            "base_unit", "condition_type", "order_cost_base_currency",
        ),
        ("sales_org == #", F.col("sales_org") == NO_GROUP),
        *missing("sales_off", "sales_off_descrp", "incoterm2", "sales_off_email", "incoterm1"),
        *[(c, F.isnan(c)) for c in ("average_reb_kg_eur", "average_frght_kg_eur", "average_com_kg_eur")],
    ]


def customer_groups(t: Mapping[str, DataFrame]) -> DataFrame:
    """Customer-sales rows with line of business and customer group: newest transaction first, else the mapping."""
    newest = latest_by(
        t["transactions"]
        .select(
            padded(F.col("sold_to_party"), 10).alias("kunnr"),
            F.col("marketing_level_2").cast("string").alias("ibg1"),
            F.col("marketing_customer_sold_to").alias("grp1"),
            "fiscal_year",
            "posting_period",
        )
        .filter(F.col("ibg1") != NO_GROUP),
        ["kunnr"],
        ["fiscal_year", "posting_period", "ibg1", "grp1"],
    ).select("kunnr", "ibg1", "grp1", F.lit("bw").alias("type1"))
    mapped = first_by(
        t["group_mapping"]
        .filter(F.col("customer_sold_to") != NO_CUSTOMER)
        .select(
            F.col("customer_sold_to").alias("kunnr"),
            F.col("ml2").cast("string").alias("ibg2"),
            F.col("marketing_customer_ship_to_description").alias("grp2"),
        ),
        ["kunnr"],
        ["ibg2", "grp2"],
    ).withColumn("type2", F.lit("cust_grp_ml2"))
    rows = t["customer_sales"].join(newest, "kunnr", "left").join(mapped, "kunnr", "left")
    rows = rows.withColumns(
        {
            "ibg": text_or_null(first_valid(F.col("ibg1"), F.col("ibg2")), ("nan",)),
            "cust_grp_adj": first_valid(F.col("grp1"), F.col("grp2")),
            "ibg_type": first_valid(F.col("type1"), F.col("type2")),
        }
    )
    return rows.filter(F.col("ibg").isNotNull()).drop("ibg1", "ibg2", "grp1", "grp2", "type1", "type2")


def customer_dimension(t: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Customer dimension, offices without a mail address, and the completeness report.

    ``t``: customer_sales, customer_master, transactions, group_mapping, scope (marketing_level_2, sbe),
    classification (segment, description), addresses (addrnumber, name1, nation), countries (landx, land1),
    districts (bzirk, bztxt), offices (vkgrp, bezei, name_first, name_last), segments, country_groups
    (land, country_group, region_text), order_cost (charge, region), mails (sales_off, sales_off_email), fx, sales_orgs.

    Each lookup keeps the row count: dimensions are reduced to one row per key first.
    """
    def one(name: str, key: list[str], **columns: str) -> DataFrame:
        picked = t[name].select(*[F.col(source).alias(target) for target, source in columns.items()])
        return first_by(picked, key, [c for c in columns if c not in key])

    def dimension(name: str, key: list[str], **columns: str) -> DataFrame:
        return one(name, key, **columns)

    scope = one("scope", ["ibg"], ibg="marketing_level_2", bu_scope="sbe").withColumn("ibg", F.col("ibg").cast("string"))
    master = one(
        "customer_master", ["kunnr"], kunnr="kunnr", cust_descrp="name1", land1="land1", adrnr="adrnr",
        segment="segment", ktokd="ktokd", __deleted="loevm",
    )
    addresses = (
        t["addresses"].filter(F.col("nation") == LOCAL_SCRIPT)
        .groupBy(F.col("addrnumber").alias("adrnr")).agg(F.min("name1").alias("cust_descrp_chi"))
        .withColumn("land1", F.lit(LOCAL_SCRIPT_COUNTRY))
    )
    offices = first_by(
        t["offices"].select(
            "vkgrp",
            F.col("bezei").alias("sales_off"),
            F.concat("name_first", F.lit(" "), "name_last").alias("sales_off_descrp"),
        ),
        ["vkgrp"],
        ["sales_off", "sales_off_descrp"],
    )
    to_eur = latest_by(
        t["fx"].filter(F.col("to_currency") == "EUR"), ["from_currency"], ["first_date", "exchange_rate"]
    ).select(F.col("from_currency").alias("waers"), "exchange_rate")

    rows = customer_groups(t).join(scope, "ibg", "left").filter(F.col("bu_scope") != OUT_OF_SCOPE)
    rows = rows.join(master, "kunnr", "left").filter(
        (F.col("ktokd") == SOLD_TO_TYPE) & (F.col("loevm") != DELETED) & (F.col("__deleted") != DELETED)
    )
    rows = (
        rows.join(dimension("classification", ["segment"], segment="segment", cust_classification="description"), "segment", "left")
        .join(addresses, ["adrnr", "land1"], "left")
        .join(dimension("countries", ["land1"], land1="land1", country_soldto="landx"), "land1", "left")
        .join(dimension("districts", ["bzirk"], bzirk="bzirk", account_mgr="bztxt"), "bzirk", "left")
        .join(offices, "vkgrp", "left")
        .join(one("segments", ["cust_grp_adj"], cust_grp_adj="cust_grp_adj", cust_size="cust_segment"), "cust_grp_adj", "left")
        .join(
            dimension("country_groups", ["land1"], land1="land", country_grp="country_group", cust_region="region_text"),
            "land1", "left",
        )
        .join(dimension("order_cost", ["cust_region"], cust_region="region", order_cost_eur="charge"), "cust_region", "left")
        .join(to_eur, "waers", "left")
        .join(dimension("mails", ["sales_off"], sales_off="sales_off", sales_off_email="sales_off_email"), "sales_off", "left")
    )
    cost = F.col("order_cost_eur").cast("double")
    blank = {c: text_or_null(F.col(c), ("",)) for c in ("incoterm1", "incoterm2", "cust_payment_term", "cust_grp_adj", "cust_size")}
    rows = rows.withColumnsRenamed(
        {"kunnr": "cust_number", "zterm": "cust_payment_term", "waers": "base_currency", "vkorg": "sales_org",
         "inco1": "incoterm1", "inco2": "incoterm2"}
    ).withColumns(
        {
            "order_cost_base_currency": F.when(F.col("base_currency") == "EUR", cost).otherwise(
                F.try_divide(cost, F.col("exchange_rate").cast("double"))
            ),
            "cust_grp_adj_id": F.lit(" "),
            "old_am": F.col("account_mgr"),
            "base_unit": F.lit(None).cast("string"),
            "condition_type": F.lit(CONDITION_TYPE),
            "average_reb_kg_eur": F.lit(0.0),
            "average_frght_kg_eur": F.lit(0.0),
            "average_com_kg_eur": F.lit(0.0),
            "sales_org": F.col("sales_org").cast("string"),
            "sales_off": first_token(F.col("sales_off"), [" ", "_", ","], keep=GLOBAL_OFFICE),
            **blank,
        }
    )
    orgs = t["sales_orgs"].select(F.col("sales_org_id").cast("string").alias("sales_org"))
    customers = only_members(rows, orgs, ["sales_org"]).select(*CUSTOMER_COLUMNS).distinct()
    return {
        "customers": customers,
        "missing_mail": customers.filter(F.col("sales_off_email").isNull())
        .select("sales_off", "sales_off_descrp", F.lit("").alias("sales_off_email")),
        "data_check": completeness_check(customers, customer_rules()),
    }


def cost_averages(complete: DataFrame, as_of: Column) -> DataFrame:
    """Volume-weighted rebate, freight and commission per customer, region and sales unit.

    The last six months where they give a figure, else all time; one pass over the rows, never below zero.
    """
    recent = months_since(as_of, F.col("transaction_date")) <= RECENT_MONTHS
    rates = {"reb": "reb_kg_eur", "frght": "frght_kg_eur", "com": "othvse_kg_eur"}
    volume = F.col("transactional_vol_kg")
    rows = complete.filter(F.col("valid_price_kg_eur").isNull() | (F.col("last_transaction_per_cxp") == "Yes"))
    sums = rows.groupBy("cust_number", F.col("cxp_region").alias("cust_region"), "sales_org").agg(
        F.sum(F.when(recent, volume)).alias("__vol_recent"),
        F.sum(volume).alias("__vol_all"),
        *[
            a
            for name, column in rates.items()
            for a in (
                F.sum(F.when(recent, F.coalesce(column, F.lit(0.0)) * volume)).alias(f"__{name}_recent"),
                F.sum(F.coalesce(column, F.lit(0.0)) * volume).alias(f"__{name}_all"),
            )
        ],
    )

    def average(name: str, span: str) -> Column:
        ratio = F.round(F.try_divide(F.col(f"__{name}_{span}"), F.col(f"__vol_{span}")), 2)
        return F.when(ratio < 0, 0.0).otherwise(ratio)

    return sums.select(
        "cust_number", "cust_region", "sales_org",
        *[F.coalesce(average(n, "recent"), average(n, "all")).alias(f"average_{n}_kg_eur") for n in rates],
    )


def newest_condition(prices: DataFrame, state: str, out: str) -> DataFrame:
    """Condition type of the customer's newest price in a validity state; the more frequent type wins a tie.

    ``prices``: price terms with the date of the newest price and the number of rates (``__rates``).
    """
    rows = prices.filter(F.col("scale_type") == state).groupBy("cust_number", F.col("cond_type").alias(out)).agg(
        F.max("valid_from").alias("__from"), F.sum("__rates").alias("__n")
    )
    return latest_by(rows, ["cust_number"], ["__from", "__n", out]).select("cust_number", out)


def enriched_customers(customers: DataFrame, complete: DataFrame, terms: DataFrame, as_of: Column) -> DataFrame:
    """Customer dimension with cost averages, base unit and condition type.

    ``terms``: the newest price and the number of rates of each kind of terms of a customer, as ``price_terms`` makes them of the
    price master.

    All three averages are filled with 0 and published; the usual table leaves the rebate column at its initial value.
    """
    averages = ["average_reb_kg_eur", "average_frght_kg_eur", "average_com_kg_eur"]
    base = customers.drop("upload_date", "source_system", "condition_type", "base_unit", *averages).distinct()
    # Four lookups read the terms.
    prices = cut_lineage(terms)
    units = prices.select("cust_number", "sales_org", "valid_from", F.col("uom").alias("__unit"))
    by_org = latest_by(units, ["cust_number", "sales_org"], ["valid_from", "__unit"]).select(
        "cust_number", "sales_org", F.col("__unit").alias("__unit1")
    )
    by_customer = latest_by(units, ["cust_number"], ["valid_from", "__unit", "sales_org"]).select(
        "cust_number", F.col("__unit").alias("__unit2")
    )
    out = (
        base.join(cost_averages(complete, as_of), ["cust_number", "cust_region", "sales_org"], "left")
        .join(by_org, ["cust_number", "sales_org"], "left")
        .join(by_customer, "cust_number", "left")
        .join(newest_condition(prices, "Current", "__cond1"), "cust_number", "left")
        .join(newest_condition(prices, "Past", "__cond2"), "cust_number", "left")
    )
    filled = out.withColumns(
        {
            "base_unit": first_valid(F.col("__unit1"), F.col("__unit2")),
            "condition_type": F.coalesce("__cond1", "__cond2", F.lit(CONDITION_TYPE)),
            "cust_payment_term": F.coalesce("cust_payment_term", F.lit(NO_PAYMENT_TERM)),
            **{c: F.coalesce(c, F.lit(0.0)) for c in averages},
        }
    )
    return filled.drop("__unit1", "__unit2", "__cond1", "__cond2", "old_am", "ibg_type")


def key_overlap(customers: DataFrame, complete: DataFrame) -> DataFrame:
    """How many keys of the two sources meet, per key kind (a data check)."""
    pairs = {
        "cust_number": (F.col("cust_number"), F.col("cust_number")),
        "cust_region": (F.col("cust_region"), F.col("cxp_region")),
        "sales_org": (F.col("sales_org"), F.col("sales_org")),
        "all": (joined_key("cust_number", "cust_region", "sales_org"), joined_key("cust_number", "cxp_region", "sales_org")),
    }

    def long(df: DataFrame, side: int) -> DataFrame:
        items = F.array(*[F.struct(F.lit(n).alias("kind"), c[side].cast("string").alias("value")) for n, c in pairs.items()])
        return df.select(F.explode(items).alias("i")).select("i.*")

    return long(customers, 0).intersect(long(complete, 1)).groupBy("kind").agg(F.count(F.lit(1)).alias("common"))
