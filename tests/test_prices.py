"""Price tables on small frames."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from plantmart.operators import joins, ranking
from plantmart.plans import prices


def test_thresholds_skip_equal_quantities_and_keep_nulls(spark):
    rows = [("c", "p", None, "i", "t", q) for q in (None, 1.0, 1.0, 5.0, float("nan"))] + [("c", "p", "r", "i", "t", 2.0)]
    base = spark.createDataFrame(rows, "kunag string, matnr string, cust_region string, ibg string, inco1 string, scales_qty double")
    got = prices.with_next_threshold(base)
    found = sorted((str(r.cust_region), str(r.scales_qty), str(r.max_vol)) for r in got.collect())
    last = str(prices.OPEN_END)
    assert found == [("None", "1.0", "5.0"), ("None", "1.0", "5.0"), ("None", "5.0", "nan"), ("None", "None", "None"), ("None", "nan", last), ("r", "2.0", last)]


def test_ids_run_on_from_customer_to_customer(spark):
    rows = [("b", "p", "t"), ("a", "q", None), ("a", "q", "t"), ("a", "p", "t"), ("a", "p", "t"), ("c", "p", None)]
    got = prices.with_ids(spark.createDataFrame(rows, "kunag string, matnr string, inco1 string"))
    found = sorted((r.unique_id, r.kunag, r.matnr, r.inco1) for r in got.distinct().collect())
    assert found == [(880, "a", "p", "t"), (881, "a", "q", None), (882, "a", "q", "t"), (883, "b", "p", "t"), (884, "c", "p", None)]


def test_total_in_front(spark):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("c", 5)], "k string, n int")
    assert sorted((r.k, r.t) for r in ranking.total_in_front(df, ["k"], "n", "t").collect()) == [("a", 0), ("b", 1), ("c", 3)]


def test_neighbours_by_window_are_those_of_the_join(spark):
    rows = [("a", 6, 9, 1.0), ("a", 7, 8, 2.0), ("a", 1, 2, 3.0), ("a", 1, 3, 4.0), ("b", 1, 9, 5.0), (None, 6, 9, 6.0)]
    df = spark.createDataFrame(rows, "k string, f int, t int, v double")
    given = (["k"], "f", "t", ["v"], F.lit(5))
    want = joins.neighbours_in_time(df, *given)
    got = joins.neighbours_by_window(df, *given).select(*want.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_prices_are_dealt_out_once(spark):
    """Ids, neighbours and thresholds need one shuffle of the price rows, by customer."""
    day = datetime.date(2001, 1, 1)
    columns = "kunag string, matnr string, vkorg string, inco1 string, cust_region string, ibg string, valid_from date, valid_to date, scales_qty double, valid_price_base_currency double"
    base = spark.createDataFrame([("c", "p", "o", "t", "r", "i", day, day, 1.0, 2.0)], columns)
    keys = ["kunag", "matnr", "vkorg", "inco1"]
    rows = joins.neighbours_by_window(prices.with_ids(base), keys, "valid_from", "valid_to", ["valid_price_base_currency"], F.current_timestamp())
    plan = prices.with_next_threshold(rows)._jdf.queryExecution().executedPlan().toString()
    assert {line.split("hashpartitioning(")[1].split("#")[0] for line in plan.splitlines() if "Exchange hashpartitioning" in line} <= {"kunag", "__part"}
