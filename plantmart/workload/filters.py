"""Predicates: null-aware, by code, by date, branches, data checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import months_since, trailing_year_start
from ..functions.missing import not_equal_or_null
from ..operators.checks import (
    common_keys,
    completeness_check,
    keys_missing_from,
    missing,
    relative_deviation,
    rows_matching_any,
)
from ..operators.joins import only_members, without_members
from ..plans.common import from_start_date
from ..sources.files import literal_rows
from .registry import Tables, query, tidy_sql


@query(
    """SELECT o_orderkey, o_orderpriority FROM orders
       WHERE CAST(o_orderdate AS DATE) >= CASE o_orderpriority WHEN '1-URGENT' THEN DATE '1996-06-01'
             WHEN '2-HIGH' THEN DATE '1999-01-01' ELSE DATE '2019-01-01' END"""
)
def per_site_date_bound(t: Tables) -> DataFrame:
    """Start date per site from a settings table, the default date where a site has none."""
    settings = literal_rows(t.spark, [("1-URGENT", "1996-06-01"), ("2-HIGH", "1999-01-01")], "site string, start_date string")
    settings = settings.withColumn("start_date", F.to_date("start_date"))
    rows = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("site"), F.to_date("o_orderdate").alias("calendar_day"))
    return from_start_date(rows, settings).select("o_orderkey", F.col("site").alias("o_orderpriority"))


@query(
    """WITH o AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS status,
                         CASE WHEN o_totalprice > 250000 THEN NULL ELSE o_totalprice END AS price,
                         CASE WHEN o_custkey < 100 THEN '#' ELSE CAST(o_custkey AS VARCHAR) END AS cust FROM orders)
       SELECT 'differs' AS rule, count(*) AS n FROM o WHERE status <> 'F'
       UNION ALL SELECT 'differs or null', count(*) FROM o WHERE status <> 'F' OR status IS NULL
       UNION ALL SELECT 'in list', count(*) FROM o WHERE status IN ('F', 'O')
       UNION ALL SELECT 'price or first', count(*) FROM o WHERE price IS NULL OR status = 'F'
       UNION ALL SELECT 'complete', count(*) FROM o WHERE status IS NOT NULL AND price IS NOT NULL
       UNION ALL SELECT 'real customer', count(*) FROM o WHERE cust NOT IN ('#', '0000000')"""
)
def null_aware_filters(t: Tables) -> DataFrame:
    """How many rows each null rule keeps; all rules in one pass over the orders."""
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    price = F.when(~(F.col("o_totalprice") > 250000), F.col("o_totalprice"))
    cust = F.when(F.col("o_custkey") < 100, "#").otherwise(F.col("o_custkey").cast("string"))
    rows = t.orders.select(status.alias("status"), price.alias("price"), cust.alias("cust"))
    status, price = F.col("status"), F.col("price")
    rules = {
        "differs": status != "F",
        "differs or null": not_equal_or_null(status, "F"),
        "in list": status.isin("F", "O"),
        "price or first": price.isNull() | (status == "F"),
        "complete": status.isNotNull() & price.isNotNull(),
        "real customer": ~F.col("cust").isin("#", "0000000"),
    }
    counts = rows.agg(*[F.count_if(c).alias(name) for name, c in rules.items()])
    return counts.unpivot([], list(rules), "rule", "n")


@query(
    """SELECT p_partkey, p_name, p_type, p_size FROM part
       WHERE p_size BETWEEN 4 AND 27 AND p_name NOT LIKE '%bolt' AND substr(p_brand, 7, 1) = '1' AND p_type <> 'PROMO'"""
)
def code_filters(t: Tables) -> DataFrame:
    """Numeric range on a text code, suffix exclusion, prefix match, equality."""
    rows = t.part.withColumn("code", F.col("p_size").cast("string"))
    return rows.filter(
        F.col("code").try_cast("int").between(4, 27)
        & ~F.col("p_name").endswith("bolt")
        & (F.substring(F.regexp_replace("p_brand", "Brand#", ""), 1, 1) == "1")
        & (F.col("p_type") != "PROMO")
    ).select("p_partkey", "p_name", "p_type", "p_size")


@query(
    """SELECT CASE WHEN event_type IN ('view', 'click') AND value <= 50 THEN 'within'
                   WHEN event_type IN ('view', 'click') THEN 'over'
                   WHEN event_type = 'purchase' THEN 'explained' ELSE 'other' END AS branch,
              count(*) AS n, count(DISTINCT user_id) AS users
       FROM events GROUP BY 1"""
)
def branch_split(t: Tables) -> DataFrame:
    """Disjoint branches as a label in one pass."""
    planned = F.col("event_type").isin("view", "click")
    branch = (
        F.when(planned & (F.col("value") <= 50), "within")
        .when(planned, "over")
        .when(F.col("event_type") == "purchase", "explained")
        .otherwise("other")
    )
    return t.events.groupBy(branch.alias("branch")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users")
    )


@query(
    """SELECT c_custkey, c_name FROM customer
       WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)"""
)
def semi_membership(t: Tables) -> DataFrame:
    """Customers with a large order."""
    return only_members(t.customer, t.orders.filter("o_totalprice > 400000"), {"c_custkey": "o_custkey"}).select(
        "c_custkey", "c_name"
    )


@query(
    """SELECT o_orderkey, o_custkey FROM orders
       WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber <> 7)"""
)
def anti_membership(t: Tables) -> DataFrame:
    """Orders without lines; a null key in the other table (here on every seventh line) excludes nothing."""
    lines = t.lineitem.select(F.when(F.col("l_linenumber") != 7, F.col("l_orderkey")).alias("l_orderkey"))
    return without_members(t.orders, lines, {"o_orderkey": "l_orderkey"}).select("o_orderkey", "o_custkey")


@query(
    """SELECT o_orderkey FROM orders
       WHERE CAST(o_orderdate AS DATE) >= DATE '2000-03-01' AND CAST(o_orderdate AS DATE) <= DATE '2001-03-17'"""
)
def trailing_12m(t: Tables) -> DataFrame:
    """From the first of this month last year up to the given day."""
    as_of = F.lit("2001-03-17").cast("date")
    day = F.col("o_orderdate").cast("date")
    return t.orders.filter((day >= trailing_year_start(as_of)) & (day <= as_of)).select("o_orderkey")


# Whole months between two dates count by day of month; both last days of their month count as whole.
_MONTHS = """round((datediff('month', d, a))
    + CASE WHEN day(d) = day(a) OR (d = last_day(d) AND a = last_day(a)) THEN 0
           ELSE (day(a) - day(d)) / 31.0 END)"""


@query(
    f"""WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, DATE '2001-05-16' AS a FROM orders)
        SELECT o_orderkey, CAST({_MONTHS} AS BIGINT) AS months FROM o WHERE {_MONTHS} <= 6"""
)
def recency_months(t: Tables) -> DataFrame:
    """Orders of the last six months, months rounded."""
    months = months_since(F.lit("2001-05-16").cast("date"), F.col("o_orderdate").cast("date"))
    return t.orders.select("o_orderkey", months.cast("long").alias("months")).filter("months <= 6")


@query(
    tidy_sql(
        """WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
                             l_discount * 100 AS cost, l_extendedprice / l_quantity / 700 - l_discount * 20 AS margin,
                             l_quantity AS volume, l_tax AS old_cost, l_discount AS new_cost FROM lineitem)
           SELECT * FROM l WHERE cost = 0 OR cost > 9.5 OR margin < 0 OR volume < 2
              OR (old_cost <> 0 AND abs(old_cost - new_cost) / old_cost >= 0.1)""",
        double="l_extendedprice cost margin volume old_cost new_cost", long="l_linenumber",
    )
)
def outlier_sample(t: Tables) -> DataFrame:
    """Rows failing any plausibility test; a relative deviation from zero is no deviation."""
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        (F.col("l_discount") * 100).alias("cost"),
        (F.col("l_extendedprice") / F.col("l_quantity") / 700 - F.col("l_discount") * 20).alias("margin"),
        F.col("l_quantity").alias("volume"), F.col("l_tax").alias("old_cost"), F.col("l_discount").alias("new_cost"),
    )
    return rows_matching_any(
        rows, F.col("cost") == 0, F.col("cost") > 9.5, F.col("margin") < 0, F.col("volume") < 2,
        relative_deviation(F.col("old_cost"), F.col("new_cost")) >= 0.1,
    )


@query(
    """WITH c AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS name,
                         CASE WHEN c_nationkey < 5 THEN NULL ELSE c_nationkey END AS nation,
                         CASE WHEN c_mktsegment = 'BUILDING' THEN '#' ELSE c_mktsegment END AS segment FROM customer)
       SELECT c_custkey, CASE WHEN segment = '#' THEN 'segment = #' WHEN name IS NULL THEN 'name' ELSE 'nation' END AS remarks,
              concat_ws(',', CASE WHEN segment = '#' THEN 'segment = #' END, CASE WHEN name IS NULL THEN 'name' END,
                        CASE WHEN nation IS NULL THEN 'nation' END) AS failures
       FROM c WHERE segment = '#' OR name IS NULL OR nation IS NULL"""
)
def completeness(t: Tables) -> DataFrame:
    """First failing rule and the list of all failing rules."""
    rows = t.customer.select(
        "c_custkey",
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("name"),
        F.when(F.col("c_nationkey") >= 5, F.col("c_nationkey")).alias("nation"),
        F.when(F.col("c_mktsegment") == "BUILDING", "#").otherwise(F.col("c_mktsegment")).alias("segment"),
    )
    rules = [("segment = #", F.col("segment") == "#"), *missing("name", "nation")]
    return completeness_check(rows, rules, all_failures=True).select(
        "c_custkey", "remarks", F.array_join("failures", ",").alias("failures")
    )


@query("SELECT c_custkey AS cust FROM customer INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def intersect_keys(t: Tables) -> DataFrame:
    """Keys both sources have."""
    left = t.customer.select(F.col("c_custkey").alias("cust"))
    return common_keys(left, t.orders.filter("o_orderstatus = 'F'"), {"cust": "o_custkey"})


@query("SELECT l_partkey AS part, l_suppkey AS supp FROM lineitem WHERE l_returnflag = 'R' EXCEPT SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'N'")
def except_keys(t: Tables) -> DataFrame:
    """Part and supplier pairs that were returned but never booked normally."""
    def pairs(flag: str) -> DataFrame:
        return t.lineitem.filter(F.col("l_returnflag") == flag).select(
            F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp")
        )

    return keys_missing_from(pairs("R"), pairs("N"), {"part": "part", "supp": "supp"})
