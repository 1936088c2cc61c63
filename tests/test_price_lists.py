"""Prices found on lists that customers share are those found on each customer's own rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from plantmart.operators.joins import neighbours_by_window
from plantmart.plans import prices
from plantmart.workload.registry import DIGITS, NUDGE, rounded

SAYS = (
    "matnr string, vkorg string, inco1 string, valid_from date, valid_to date, uom string, uom_scale string, per double, scales_qty double, "
    "konwa string, kbetr double, valid_price_base_currency double, weight_rate_to_apply_scale double, weight_rate_to_apply double, "
    "fx_rate_into_eur double, cond_type string, type1 string, type2 string"
)
KNOWN = "inco2 string, ibg string, cust_region string"


def parts(spark, seed):
    """Customers of one, two or no groups, some repeated or in two regions; products with group prices, own prices and both."""
    pick = random.Random(seed)

    def price(matnr, vkorg, inco1):
        start, end = sorted((pick.randrange(1, 28), pick.randrange(1, 28)))
        day = "2001-07-{:02d}".format
        quantity = pick.choice([None, 1.0, 1.0, 5.0, 9.0])
        rate = float(pick.randrange(5))
        return (matnr, vkorg, inco1, day(start), day(end), "KG", "KG", 1.0, quantity, "EUR", rate, rate, 1.0, 1.0, 1.0, pick.choice(["YP00", "YP11"]), "t", "k")

    term = lambda: pick.choice(["EXW", None])
    product = lambda: f"K{pick.randrange(90)}"
    groups = [(g, *price(product(), f"O{pick.randrange(2)}", term())) for g in ("G1", "G2", "G3") for _ in range(120)]
    own = [(f"c{pick.randrange(14):02d}", *price(product(), f"O{pick.randrange(2)}", term())) for _ in range(60)]
    buyers = []
    for k in range(12):
        for group in pick.sample(["G1", "G2", "G3"], pick.choice([1, 1, 2])):
            for org in pick.sample(["O0", "O1"], pick.choice([1, 2])):
                for inco1 in ("EXW", None):
                    buyers += [(group, org, inco1, f"c{k:02d}", None, "L", region) for region in (["R"], ["R", None])[k % 2]] * pick.choice([1, 1, 2])
    regions = spark.createDataFrame([(f"c{k:02d}", "L", r) for k in range(14) for r in (["R"], ["R", None])[k % 2]], "kunag string, ibg string, cust_region string")
    dated = {"valid_from": F.to_date("valid_from"), "valid_to": F.to_date("valid_to")}
    frame = lambda rows, first: spark.createDataFrame(rows, f"{first} string, " + SAYS.replace(" date", " string")).withColumns(dated)
    return prices.Prices(
        frame(groups, "konda"), spark.createDataFrame(buyers, f"konda string, vkorg string, inco1 string, kunag string, {KNOWN}"),
        frame(own, "kunag"), lambda rows: rows.withColumn("inco2", F.lit(None).cast("string")).join(regions, "kunag", "left"),
    )


def plain(given, as_of):
    same = (F.col("o.konda") == F.col("b.konda")) & (F.col("o.vkorg") == F.col("b.vkorg")) & F.col("o.inco1").eqNullSafe(F.col("b.inco1"))
    of_groups = given.of_groups.alias("o").join(given.buyers.alias("b"), same).select("o.*", "b.kunag", "b.inco2", "b.ibg", "b.cust_region").drop("konda")
    rows = prices.with_ids(given.known(given.own).unionByName(of_groups))
    rows = neighbours_by_window(rows, ["kunag", "matnr", "vkorg", "inco1"], "valid_from", "valid_to", ["valid_price_base_currency"], as_of)
    return prices.with_price_states(prices.with_next_threshold(rows), as_of)


@pytest.mark.parametrize("seed", [1, 2])
def test_lists_give_what_the_rows_of_each_customer_give(spark, monkeypatch, seed):
    monkeypatch.setattr(prices, "LIST_CHUNK", 8)
    given, as_of = parts(spark, seed), F.lit("2001-07-15").cast("date")
    want = plain(given, as_of)
    got = prices.price_rows(given, as_of).select(*want.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_customers_of_one_group_share_a_list(spark):
    given = parts(spark, 1)
    buyers = spark.createDataFrame([("G1", "O0", "EXW", f"c{k:03d}", None, "L", "R") for k in range(500)], given.buyers.schema)
    of_customer, rows = prices._price_lists(prices.Prices(given.of_groups, buyers, given.own, given.known), F.lit("2001-07-15").cast("date"))
    assert of_customer.count() == 500 and of_customer.select("list").distinct().count() == 1
    assert rows.count() == given.of_groups.filter("konda = 'G1' AND vkorg = 'O0'").count()


def test_plain_arithmetic_rounds_as_round_does(spark):
    values = [0.0, -0.0, 1e12, 0.1234565, -0.1234565, 2.5e-7, 5e-7, 9999999.1234565, 12345678.1234565, 1e300, float("nan"), float("inf"), None, 0.00000049, 7.0]
    pick = random.Random(1)
    values += [pick.uniform(-1, 1) * 10 ** pick.randrange(-7, 9) for _ in range(2000)] + [k / 1e6 + 5e-7 for k in range(500)]
    value = F.round(F.col("v") + NUDGE, DIGITS)
    slow = F.when(value == 0, F.lit(0.0)).otherwise(value)
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", rounded(F.col("v")).alias("got"), slow.alias("want"))
    assert rows.filter(~F.col("got").eqNullSafe(F.col("want"))).collect() == []


def test_terms_of_customers_are_those_of_their_prices(spark, monkeypatch):
    """Newest price and number of rates, without a row for each price of each customer."""
    given, as_of = parts(spark, 3), F.lit("2001-07-15").cast("date")
    rows = plain(given, as_of).select(
        F.col("kunag").alias("cust_number"), F.col("vkorg").alias("sales_org"), "valid_from", "uom", "scale_type", F.col("rate_eur").alias("scales_rate"), "cond_type"
    )
    met = []

    def reduced_parts(t, fx, store):
        none = F.lit(None).cast("string")
        of_groups = store(given.of_groups.withColumns({"type1": F.lit("g"), "kunag": none}))
        own = store(given.own.withColumns({"type1": F.lit("c"), "konda": none}))
        met.extend([of_groups.count() <= given.of_groups.count(), "matnr" not in of_groups.columns])
        return prices.Prices(of_groups.drop("kunag"), given.buyers, own.drop("konda"), given.known)

    monkeypatch.setattr(prices, "price_parts", reduced_parts)
    want = prices.price_terms(rows)
    got = prices.customer_terms({}, None, as_of).select(*want.columns)
    assert met == [True, True] and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
