"""Joins and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import first_by
from ..operators.joins import (
    bracket_join,
    conditional_lookup,
    join_back,
    left_join_with_defaults,
    lookup,
    neighbours_in_time,
    override,
    reconcile,
)
from ..operators.ordered import occurrence_index
from ..sources.files import literal_rows
from .registry import Tables, query, tidy_sql

LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity"]


def ship_chunk() -> Column:
    """Shipping day, cut once more by order number: never decreases along (l_shipdate, l_orderkey).

    However many lines one part or supplier has, a chunk holds only one day's lines of 2^28 order numbers.
    """
    day = F.unix_date(F.col("l_shipdate").cast("date")).cast("long")
    return F.shiftleft(day, 24) + F.shiftright("l_orderkey", 28)


@query(
    tidy_sql(
        """SELECT r_name, n_name, count(*) AS n, sum(l_extendedprice * (1 - l_discount)) AS revenue,
                  sum(CASE WHEN p_partkey IS NULL THEN 1 ELSE 0 END) AS no_part
           FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
           JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
           JOIN supplier ON s_suppkey = l_suppkey
           LEFT JOIN (SELECT * FROM part WHERE p_type <> 'PROMO') p ON p_partkey = l_partkey
           GROUP BY r_name, n_name""",
        double="revenue", long="no_part",
    )
)
def hierarchy_join(t: Tables) -> DataFrame:
    """Six-level chain with an optional level."""
    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.part.filter("p_type <> 'PROMO'"), F.col("l_partkey") == F.col("p_partkey"), "left")
        .groupBy("r_name", "n_name")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"),
            F.sum(F.col("p_partkey").isNull().cast("int")).alias("no_part"),
        )
    )


@query(
    """SELECT c_custkey, cn.n_name AS own_nation, s.s_name AS home_supplier, sn.n_name AS supplier_nation
       FROM customer LEFT JOIN nation cn ON cn.n_nationkey = c_nationkey
       LEFT JOIN (SELECT min(s_name) AS s_name, s_nationkey FROM supplier GROUP BY s_nationkey) s ON s.s_nationkey = c_nationkey
       LEFT JOIN nation sn ON sn.n_nationkey = s.s_nationkey"""
)
def unique_dimension_join(t: Tables) -> DataFrame:
    """The same dimension at two levels, and a dimension reduced to one row per key; a duplicate key would fail."""
    nation = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("own_nation"))
    home = first_by(t.supplier, ["s_nationkey"], ["s_name"]).select(
        F.col("s_nationkey").alias("c_nationkey"), F.col("s_name").alias("home_supplier"), "s_nationkey"
    )
    supplier_nation = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("supplier_nation"))
    rows = lookup(lookup(t.customer, nation, ["c_nationkey"]), home, ["c_nationkey"])
    return lookup(rows, supplier_nation, ["s_nationkey"]).select(
        "c_custkey", "own_nation", "home_supplier", "supplier_nation"
    )


@query(
    tidy_sql(
        """SELECT e.event_id, CASE WHEN o.o_orderkey IS NULL THEN 'UNKNOWN MATERIAL' ELSE o.o_orderpriority END AS product,
                  CASE WHEN o.o_orderkey IS NULL THEN e.value ELSE o.price END AS price,
                  CASE WHEN o.o_orderkey IS NULL THEN '0000000' ELSE CAST(e.event_id AS VARCHAR) END AS order_number
           FROM events e LEFT JOIN (SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS price
                                    FROM orders WHERE o_totalprice > 200000) o ON o.o_orderkey = e.event_id""",
        double="price",
    )
)
def left_join_defaults(t: Tables) -> DataFrame:
    """Defaults only for rows without a match; a matched null stays null."""
    orders = t.orders.filter("o_totalprice > 200000").select(
        F.col("o_orderkey").alias("event_id"),
        F.col("o_orderpriority").alias("product"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
    )
    events = t.events.select("event_id", "value", F.col("event_id").cast("string").alias("order_number"))
    return left_join_with_defaults(
        events, orders, ["event_id"],
        {"product": "UNKNOWN MATERIAL", "price": F.col("value"), "order_number": "0000000"},
    ).select("event_id", "product", "price", "order_number")


_SIDES = """l AS (SELECT l_orderkey AS lo, l_partkey AS lp, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag <> 'A' GROUP BY ALL),
            r AS (SELECT l_orderkey AS ro, l_partkey AS rp, min(l_linenumber) AS line FROM lineitem WHERE l_linestatus = 'O' GROUP BY ALL)"""


@query(
    tidy_sql(
        f"""WITH {_SIDES}
            SELECT CASE WHEN ro IS NULL THEN 'left' WHEN lo IS NULL THEN 'right' ELSE 'both' END AS side,
                   coalesce(lo, ro) AS order_key, coalesce(lp, rp) AS part_key, q AS quantity, line
            FROM l FULL OUTER JOIN r ON lo = ro AND lp = rp""",
        double="quantity", long="line",
    )
)
def reconcile_full_outer(t: Tables) -> DataFrame:
    """Two views of the same documents, compared on order and part."""
    left = t.lineitem.filter("l_returnflag <> 'A'").groupBy(
        F.col("l_orderkey").alias("lo"), F.col("l_partkey").alias("lp")
    ).agg(F.sum("l_quantity").alias("q"))
    right = t.lineitem.filter("l_linestatus = 'O'").groupBy(
        F.col("l_orderkey").alias("ro"), F.col("l_partkey").alias("rp")
    ).agg(F.min("l_linenumber").alias("line"))
    sides = reconcile(left, right, {"lo": "ro", "lp": "rp"})

    def shaped(df: DataFrame, side: str, order: str, part: str) -> DataFrame:
        have = set(df.columns)
        return df.select(
            F.lit(side).alias("side"), F.col(order).alias("order_key"), F.col(part).alias("part_key"),
            (F.col("q") if "q" in have else F.lit(None).cast("double")).alias("quantity"),
            (F.col("line") if "line" in have else F.lit(None).cast("int")).alias("line"),
        )

    parts = [
        shaped(sides.matched, "both", "lo", "lp"),
        shaped(sides.left_only, "left", "lo", "lp"),
        shaped(sides.right_only, "right", "ro", "rp"),
    ]
    return reduce(DataFrame.unionByName, parts)


_BRACKETS = [
    (kind, low, high, f"{kind} {low:g}+")
    for kind in ("ECONOMY", "SMALL", "MEDIUM", "STANDARD", "LARGE")
    for low, high in ((0.0, 200.0), (200.0, 700.0), (700.0, 1e12))
]


@query(
    tidy_sql(
        f"""WITH b(kind, low, high, bracket) AS (VALUES {', '.join(f"('{k}', {lo}, {hi}, '{n}')" for k, lo, hi, n in _BRACKETS)}),
            v AS (SELECT p_partkey, p_type, sum(l_quantity) AS volume FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL)
            SELECT p_partkey, p_type, volume, bracket FROM v LEFT JOIN b ON kind = p_type AND volume >= low AND volume < high""",
        double="volume",
    )
)
def bracket_of_volume(t: Tables) -> DataFrame:
    """Volume bracket by part type; a type without brackets keeps null."""
    brackets = literal_rows(t.spark, _BRACKETS, "p_type string, low double, high double, bracket string")
    volumes = (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_partkey", "p_type").agg(F.sum("l_quantity").alias("volume"))
    )
    return bracket_join(volumes, brackets, ["p_type"], "volume", "low", "high").select(
        "p_partkey", "p_type", "volume", "bracket"
    )


_FIRST_LINE = """row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity)"""


@query(
    tidy_sql(
        f"""WITH l AS (SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, l_extendedprice, {_FIRST_LINE} AS nth FROM lineitem),
            p AS (SELECT l_partkey AS pk, max(l_quantity) AS top FROM lineitem GROUP BY 1)
            SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, l_extendedprice, nth, top
            FROM l LEFT JOIN p ON pk = l_partkey AND nth = 1""",
        double="l_extendedprice top", long="l_linenumber nth",
    )
)
def conditional_match_join(t: Tables) -> DataFrame:
    """Only the first line of a part meets the part's figures."""
    columns = ["l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]
    rows = occurrence_index(
        t.lineitem.select(*columns, "l_shipdate", "l_quantity"), ["l_partkey"], LINE_ORDER, ship_chunk(), "nth"
    )
    tops = t.lineitem.groupBy("l_partkey").agg(F.max("l_quantity").alias("top"))
    return conditional_lookup(rows, tops, ["l_partkey"], F.col("nth") == 1).select(*columns, "nth", "top")


@query(
    """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' AND r_name = 'ASIA' THEN 'general ASIA'
              WHEN c_mktsegment = 'BUILDING' AND c_nationkey = 3 THEN 'own 3'
              WHEN c_mktsegment = 'MACHINERY' AND c_nationkey = 7 THEN 'own 7' ELSE n_name END AS manager
       FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey"""
)
def waterfall_override(t: Tables) -> DataFrame:
    """A specific rule, then a general rule that replaces it."""
    rows = (
        t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
        .join(t.region, F.col("r_regionkey") == F.col("n_regionkey"))
        .select("c_custkey", "c_mktsegment", "c_nationkey", "r_name", F.col("n_name").alias("manager"))
    )
    own = literal_rows(
        t.spark,
        [("BUILDING", 3, "own 3"), ("MACHINERY", 7, "own 7")], "c_mktsegment string, c_nationkey int, who string"
    )
    general = literal_rows(t.spark, [("BUILDING", "ASIA", "general ASIA")], "c_mktsegment string, r_name string, who string")
    return override(
        rows, "manager", [(own, ["c_mktsegment", "c_nationkey"], "who"), (general, ["c_mktsegment", "r_name"], "who")]
    ).select("c_custkey", "manager")


@query(
    tidy_sql(
        """WITH l AS (SELECT l_partkey AS part, l_suppkey AS supp, CAST(l_shipdate AS DATE) AS valid_from,
                             CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) AS valid_to, max(l_extendedprice) AS price
                      FROM lineitem GROUP BY ALL),
           f AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY valid_from, valid_to, price) AS rn FROM l
                 WHERE valid_from > DATE '1998-09-02' AND valid_to > DATE '1998-09-02'),
           p AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY valid_to DESC, valid_from DESC, price DESC) AS rn FROM l
                 WHERE valid_from < DATE '1998-09-02' AND valid_to < DATE '1998-09-02')
           SELECT l.part, l.supp, l.valid_from, l.valid_to, l.price, f.valid_from AS future_valid_from,
                  f.valid_to AS future_valid_to, f.price AS future_price, p.valid_from AS previous_valid_from,
                  p.valid_to AS previous_valid_to, p.price AS previous_price
           FROM l LEFT JOIN f ON f.part = l.part AND f.rn = 1 LEFT JOIN p ON p.part = l.part AND p.rn = 1""",
        double="price future_price previous_price",
        day="valid_from valid_to future_valid_from future_valid_to previous_valid_from previous_valid_to",
    )
)
def as_of_prev_next(t: Tables) -> DataFrame:
    """Every price with the next future and the last past price of its part, seen from a day."""
    start = F.col("l_shipdate").cast("date")
    prices = t.lineitem.groupBy(
        F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"), start.alias("valid_from"),
        F.date_add(start, F.col("l_quantity").cast("int")).alias("valid_to"),
    ).agg(F.max("l_extendedprice").alias("price"))
    as_of = F.lit("1998-09-02").cast("date")
    return neighbours_in_time(prices, ["part"], "valid_from", "valid_to", ["price"], as_of)


@query(
    tidy_sql(
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
                  sum(l_quantity) OVER (PARTITION BY l_returnflag, l_partkey) AS part_quantity,
                  avg(l_discount) OVER (PARTITION BY l_returnflag, l_partkey) AS part_discount FROM lineitem""",
        double="l_extendedprice part_quantity part_discount", long="l_linenumber",
    )
)
def agg_join_back(t: Tables) -> DataFrame:
    """Group figures on every detail row."""
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_quantity", "l_discount"
    )
    return join_back(
        rows, ["l_returnflag", "l_partkey"],
        F.sum("l_quantity").alias("part_quantity"), F.avg("l_discount").alias("part_discount"),
    ).drop("l_returnflag", "l_quantity", "l_discount")


@query(
    tidy_sql(
        """SELECT 'approved' AS source_status, event_type, count(*) AS n, sum(value) AS total FROM events WHERE event_type <> 'error' GROUP BY ALL
           UNION ALL SELECT 'unapproved', event_type, count(*), sum(value) FROM events WHERE event_type IN ('error', 'view') GROUP BY ALL""",
        double="total",
    )
)
def union_sources(t: Tables) -> DataFrame:
    """Two overlapping sources with different column order and an extra column, labelled and aggregated once."""
    first = t.events.filter("event_type <> 'error'").select("event_type", "value", F.lit("approved").alias("source_status"))
    second = t.events.filter("event_type IN ('error', 'view')").select(
        F.lit("unapproved").alias("source_status"), "value", "event_type", "props"
    )
    both = first.unionByName(second, allowMissingColumns=True)
    return both.groupBy("source_status", "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


@query(
    """SELECT c_nationkey AS nation, c_mktsegment AS segment FROM customer
       UNION SELECT s_nationkey, 'SUPPLIER' FROM supplier"""
)
def union_distinct(t: Tables) -> DataFrame:
    """Distinct rows of a union."""
    a = t.customer.select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.col("s_nationkey").alias("nation"), F.lit("SUPPLIER").alias("segment"))
    return a.unionByName(b).distinct()
