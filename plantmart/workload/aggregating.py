"""Aggregates, statistics, quantile segments, ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.aggregates import (
    frequency,
    share_between_0_and_1,
    sum_when,
    text_set,
    two_level_sum,
    weighted_average,
)
from ..operators.ranking import band_by_quantile, exact_quantiles, surrogate_ids
from .registry import Tables, query, tidy_sql


@query(
    tidy_sql(
        """SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS quantity, sum(l_extendedprice) AS price,
                  sum(CASE WHEN l_tax > 0.04 THEN l_extendedprice ELSE 0 END) AS taxed,
                  sum(CASE WHEN l_discount = 0 THEN l_quantity ELSE 0 END) AS undiscounted
           FROM lineitem GROUP BY ALL""",
        double="quantity price taxed undiscounted",
    )
)
def conditional_sums(t: Tables) -> DataFrame:
    """Several measures and per-measure conditions in one pass."""
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("l_quantity").alias("quantity"),
        F.sum("l_extendedprice").alias("price"),
        sum_when(F.col("l_tax") > 0.04, "l_extendedprice").alias("taxed"),
        sum_when(F.col("l_discount") == 0, "l_quantity").alias("undiscounted"),
    )


@query("SELECT p_brand, count(*) AS count FROM part GROUP BY p_brand")
def frequency_table(t: Tables) -> DataFrame:
    return frequency(t.part, "p_brand")


@query("SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem")
def distinct_rows(t: Tables) -> DataFrame:
    return t.lineitem.select("l_suppkey", "l_returnflag").distinct()


@query(
    tidy_sql(
        """WITH a AS (SELECT o_custkey, l_orderkey, sum(l_quantity) AS q, sum(l_discount) AS d
                      FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL)
           SELECT o_custkey, sum(q) AS sum_l_quantity, sum(d) AS sum_l_discount, sum(least(q - d, 100)) AS sum_running,
                  sum(greatest(q - 100, 0)) AS sum_extra FROM a GROUP BY 1""",
        double="sum_l_quantity sum_l_discount sum_running sum_extra",
    )
)
def two_level_agg(t: Tables) -> DataFrame:
    """Sum per order, derive, sum per customer."""
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return two_level_sum(
        rows, ["o_custkey", "l_orderkey"], ["o_custkey"], ["l_quantity", "l_discount"],
        {
            "running": F.least(F.col("l_quantity") - F.col("l_discount"), F.lit(100.0)),
            "extra": F.greatest(F.col("l_quantity") - 100, F.lit(0.0)),
        },
    )


@query(
    tidy_sql(
        """SELECT l_suppkey, l_returnflag, CASE WHEN r < 0 THEN 0 ELSE r END AS rate FROM (
             SELECT l_suppkey, l_returnflag,
                    round(sum((l_discount - 0.05) * l_quantity) / nullif(sum(l_quantity), 0), 2) AS r FROM lineitem GROUP BY ALL) x""",
        double="rate",
    )
)
def weighted_avg(t: Tables) -> DataFrame:
    """Volume-weighted mean, rounded, not below zero."""
    rows = t.lineitem.withColumn("rate", F.col("l_discount") - 0.05)
    return rows.groupBy("l_suppkey", "l_returnflag").agg(weighted_average("rate", "l_quantity").alias("rate"))


@query(
    tidy_sql(
        """SELECT l_orderkey, produced, good, CASE WHEN produced = 0 AND good = 0 THEN 0 WHEN produced = 0 THEN 0
                  ELSE least(greatest(good / produced, 0), 1) END AS q1
           FROM (SELECT l_orderkey, sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS produced,
                        sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE -l_quantity / 2 END) AS good
                 FROM lineitem GROUP BY 1) x""",
        double="produced good q1",
    )
)
def q1_ratio(t: Tables) -> DataFrame:
    """Ratio held in [0, 1]; 0 when nothing was produced."""
    sums = t.lineitem.groupBy("l_orderkey").agg(
        sum_when(F.col("l_returnflag") == "R", "l_quantity").alias("produced"),
        F.sum(F.when(F.col("l_linestatus") == "O", F.col("l_quantity")).otherwise(-F.col("l_quantity") / 2)).alias("good"),
    )
    return sums.withColumn("q1", share_between_0_and_1(F.col("good"), F.col("produced")))


@query(
    tidy_sql(
        """SELECT p_brand, count(DISTINCT o_custkey) AS customers, count(l_discount) AS transactions,
                  avg(l_extendedprice / l_quantity) AS cost, avg(l_discount) AS margin
           FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey GROUP BY 1""",
        double="cost margin",
    )
)
def count_distinct_stats(t: Tables) -> DataFrame:
    """Distinct customers next to counts and means."""
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        t.part, F.col("l_partkey") == F.col("p_partkey")
    )
    return rows.groupBy("p_brand").agg(
        F.count_distinct("o_custkey").alias("customers"),
        F.count("l_discount").alias("transactions"),
        F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("cost"),
        F.avg("l_discount").alias("margin"),
    )


@query(
    """SELECT l_partkey, string_agg(DISTINCT n_name, ',' ORDER BY n_name) AS origins
       FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY 1"""
)
def set_string(t: Tables) -> DataFrame:
    """Supplier nations of a part as one sorted text."""
    origins = t.lineitem.select("l_partkey", "l_suppkey").distinct()
    return (
        origins.join(t.supplier, F.col("s_suppkey") == F.col("l_suppkey"))
        .join(t.nation, F.col("n_nationkey") == F.col("s_nationkey"))
        .groupBy("l_partkey").agg(text_set("n_name").alias("origins"))
    )


@query(
    tidy_sql(
        """SELECT quantile_cont(revenue, 0.8) AS p80, quantile_cont(revenue, 0.9) AS p90
           FROM (SELECT o_custkey, sum(o_totalprice) AS revenue FROM orders GROUP BY 1) x""",
        double="p80 p90",
    )
)
def customer_quantiles(t: Tables) -> DataFrame:
    """Exact quantiles of customer revenue."""
    sums = t.orders.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("revenue"))
    return exact_quantiles(sums, "revenue", {"p80": 0.8, "p90": 0.9})


@query(
    tidy_sql(
        """WITH s AS (SELECT o_custkey, sum(o_totalprice) AS revenue FROM orders GROUP BY 1),
           q AS (SELECT quantile_cont(revenue, 0.8) AS p80, quantile_cont(revenue, 0.9) AS p90 FROM s)
           SELECT c_custkey, revenue, CASE WHEN revenue >= (SELECT p90 FROM q) THEN 'Large'
                  WHEN revenue >= (SELECT p80 FROM q) THEN 'Medium' ELSE 'Small' END AS segment
           FROM customer LEFT JOIN s ON o_custkey = c_custkey""",
        double="revenue",
    )
)
def segment_by_quantile(t: Tables) -> DataFrame:
    """Large, medium and small customers by revenue; without orders: small."""
    sums = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.sum("o_totalprice").alias("revenue"))
    banded = band_by_quantile(sums, "revenue", [("Large", 0.9), ("Medium", 0.8)], "Small", "segment")
    return t.customer.select("c_custkey").join(banded, "c_custkey", "left").fillna("Small", subset=["segment"])


@query(
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, count(*) AS rows,
              dense_rank() OVER (ORDER BY l_partkey, l_suppkey) + 879 AS unique_id
       FROM lineitem GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey"""
)
def surrogate_id(t: Tables) -> DataFrame:
    """Dense ids from 880 per part and supplier, in key order."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    rows = t.lineitem.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return surrogate_ids(rows, ["l_partkey", "l_suppkey"])
