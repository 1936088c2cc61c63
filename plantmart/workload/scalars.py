"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import (
    calendar_columns,
    cycle_position,
    from_inverted,
    month_number,
    plus_minutes,
    production_day,
    shift_code,
    stamp_from_parts,
    validity_state,
)
from ..functions.text import first_token, joined_key, padded, prefixes, without_leading_zeros
from ..functions.units import kg_to_ton, lb_to_ton, signed_rate, to_kg, to_lb, unit_factor
from .registry import Tables, query, tidy_sql


@query(
    tidy_sql(
        """SELECT event_id, CAST(ts - INTERVAL 6 HOUR AS DATE) AS day,
                  CASE WHEN hour(ts) < 6 OR hour(ts) >= 22 THEN 'ND' WHEN hour(ts) < 14 THEN 'OD' ELSE 'MD' END AS shift,
                  datediff('day', CAST(ts - INTERVAL 6 HOUR AS DATE), DATE '2019-10-01') % 14 AS cycle14,
                  (10 + datediff('day', CAST(ts AS DATE), DATE '2017-08-19') % 10) % 10 AS cycle10,
                  date_trunc('second', ts) + INTERVAL 1 MINUTE * (event_id % 1000) AS later
           FROM events""",
        long="cycle14 cycle10", day="day", ts="later",
    )
)
def shift_and_cycle(t: Tables) -> DataFrame:
    """Production day, shift, place in the shift cycle (signed and not), shifted timestamps."""
    ts = F.col("ts").cast("timestamp")
    day = production_day(ts, 6)
    return t.events.select(
        "event_id", day.alias("day"), shift_code(ts).alias("shift"),
        cycle_position("2019-10-01", day, 14).alias("cycle14"),
        cycle_position("2017-08-19", F.to_date(ts), 10, signed=False).alias("cycle10"),
        plus_minutes(ts, F.col("event_id") % 1000).alias("later"),
    )


@query(
    tidy_sql(
        """SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) || ' W' || CAST(week(o_orderdate) AS VARCHAR) AS calendar_week,
                  strftime(o_orderdate, '%b %Y') AS calendar_month, year(o_orderdate) AS calendar_year,
                  year(o_orderdate) * 100 + month(o_orderdate) AS "indexMonth", week(o_orderdate) AS weeknum,
                  CAST(isoyear(o_orderdate) AS VARCHAR) || ' W' || CAST(week(o_orderdate) AS VARCHAR) AS iso_week,
                  o_orderstatus || '-' || CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END || CAST(o_orderkey AS VARCHAR) AS key
           FROM orders""",
        long="calendar_year indexMonth weeknum",
    )
)
def calendar_keys(t: Tables) -> DataFrame:
    """Calendar attributes, and a composite key that is null when a part is."""
    day = F.col("o_orderdate").cast("date")
    priority = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    return t.orders.select(
        "o_orderkey", *[c.alias(n) for n, c in calendar_columns(day).items()],
        calendar_columns(day, iso_year=True)["calendar_week"].alias("iso_week"),
        joined_key("o_orderstatus", F.lit("-"), priority, F.col("o_orderkey").cast("string")).alias("key"),
    )


@query(
    """SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS padded,
              ltrim('000' || CAST(c_custkey AS VARCHAR), '0') AS stripped, split_part(c_name, '#', 1) AS head,
              CASE WHEN c_mktsegment = 'BUILDING' THEN c_name ELSE split_part(split_part(c_name, '#', 1), 'o', 1) END AS token,
              substr(c_name, 1, 2) AS ph1, substr(c_name, 1, 4) AS bu, upper(c_name) AS loud, replace(c_name, '#0', '/') AS clean
       FROM customer"""
)
def string_keys(t: Tables) -> DataFrame:
    """Padding, stripping, tokens, prefixes."""
    name = F.col("c_name")
    levels = prefixes(name, {"ph1": 2, "bu": 4})
    label = F.when(F.col("c_mktsegment") == "BUILDING", "KEEP ME").otherwise(name)
    token = first_token(label, ["#", "o"], keep="KEEP ME")
    return t.customer.select(
        "c_custkey", padded(F.col("c_custkey"), 10).alias("padded"),
        without_leading_zeros(F.concat(F.lit("000"), F.col("c_custkey").cast("string"), F.lit(" "))).alias("stripped"),
        first_token(name, ["#"]).alias("head"),
        F.when(token == "KEEP ME", name).otherwise(token).alias("token"),
        *[c.alias(n) for n, c in levels.items()], F.upper(name).alias("loud"),
        F.regexp_replace(name, "#0", "/").alias("clean"),
    )


@query(
    tidy_sql(
        """WITH l AS (SELECT *, CASE WHEN l_linenumber < 4 THEN 'LB' ELSE 'KG' END AS unit FROM lineitem)
           SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
                  CASE WHEN unit = 'LB' THEN l_quantity * 0.45359237 ELSE l_quantity END AS kg,
                  CASE WHEN unit = 'LB' THEN l_quantity ELSE l_quantity / 0.45359237 END AS lb,
                  l_quantity * 0.00045359237 AS lb_ton, l_quantity * 0.001 AS kg_ton,
                  l_quantity / nullif(l_discount, 0) * pow(10, CAST(l_linenumber - 6 AS DOUBLE)) AS factor,
                  CASE WHEN l_discount - 0.05 >= 0 THEN l_discount - 0.05 ELSE abs(1.0 / (l_discount - 0.05)) END AS quoted FROM l""",
        double="l_extendedprice kg lb lb_ton kg_ton factor quoted", long="l_linenumber",
    )
)
def unit_conversion(t: Tables) -> DataFrame:
    """Mass units, unit factors, rates quoted the other way round."""
    unit = F.when(F.col("l_linenumber") < 4, "LB").otherwise("KG")
    quantity = F.col("l_quantity")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        to_kg(quantity, unit).alias("kg"), to_lb(quantity, unit).alias("lb"),
        lb_to_ton(quantity).alias("lb_ton"), kg_to_ton(quantity).alias("kg_ton"),
        unit_factor(quantity, F.col("l_discount"), (F.col("l_linenumber") - 6).cast("double")).alias("factor"),
        signed_rate(F.col("l_discount") - 0.05).alias("quoted"),
    )


@query(
    """SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE month(o_orderdate) END AS BIGINT) AS month_no FROM orders"""
)
def month_name_number(t: Tables) -> DataFrame:
    """Short month names in any case to numbers; an unknown name is 0."""
    name = F.date_format("o_orderdate", "MMM")
    text = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "MMMM-")).otherwise(
        F.when(F.col("o_orderstatus") == "F", F.upper(name)).otherwise(name)
    )
    return t.orders.select("o_orderkey", month_number(text).alias("month_no"))


@query(
    tidy_sql(
        """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day,
                  o_orderdate + INTERVAL 1 SECOND * (o_orderkey % 60) + INTERVAL 1 HOUR * (o_custkey % 24) AS entry,
                  CASE WHEN CAST(o_orderdate AS DATE) > DATE '1998-06-15' THEN 'Future'
                       WHEN CAST(o_orderdate AS DATE) + 90 < DATE '1998-06-15' THEN 'Past' ELSE 'Current' END AS state
           FROM orders""",
        day="day", ts="entry",
    )
)
def dates_from_parts(t: Tables) -> DataFrame:
    """Inverted dates, date plus time text, state of a validity."""
    day = F.col("o_orderdate").cast("date")
    inverted = F.lit(99999999) - F.date_format(day, "yyyyMMdd").cast("int")
    clock = F.format_string("%02d:00:%02d", F.col("o_custkey") % 24, F.col("o_orderkey") % 60)
    return t.orders.select(
        "o_orderkey", from_inverted(inverted).alias("day"), stamp_from_parts(day, clock).alias("entry"),
        validity_state(day, F.date_add(day, 90), F.lit("1998-06-15").cast("date")).alias("state"),
    )
