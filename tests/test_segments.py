"""Customer segments on small frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from plantmart.operators.aggregates import exact_total
from plantmart.plans import customers


def test_groups_of_equal_margin_share_a_segment(spark):
    """The margins of A and B are equal, but as doubles added in this order they differ in the last digit."""
    rows = [("A", x) for x in (0.1, 0.2, 0.3)] + [("B", x) for x in (0.3, 0.2, 0.1)]
    sold = spark.createDataFrame(
        [(g, g, x, g, 2001, 3) for g, x in rows],
        "sold_to_party string, sold_to_party_description string, consolidated_marginal_income_eur double, marketing_customer_sold_to string, fiscal_year int, posting_period int",
    ).coalesce(1)
    none = {
        "group_mapping": spark.createDataFrame([], "customer_sold_to string, marketing_customer_ship_to_description string"),
        "customer_sales": spark.createDataFrame([], "kunnr string, loevm string"),
        "customer_master": spark.createDataFrame([], "kunnr string, name1 string, ktokd string, loevm string"),
    }
    got = customers.segments({"transactions": sold, **none}, F.lit("2001-07-15").cast("timestamp"))
    assert {r.cust_grp_adj: r.cust_segment for r in got.collect()} == {"A": "Large", "B": "Large"}


def test_exact_total(spark):
    rows = [("a", 0.1), ("a", 0.2), ("a", None), ("b", 1e30), ("b", 1.0), ("c", None), ("d", float("nan"))]
    got = spark.createDataFrame(rows, "k string, v double").groupBy("k").agg(exact_total("v").alias("t"))
    found = {r.k: r.t for r in got.collect()}
    assert (found["a"], found["b"], found["c"], found["d"] != found["d"]) == (0.3, 1e30 + 1.0, 0.0, True)
