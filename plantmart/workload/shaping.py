"""Projections, casts, names, missing values, parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_stamp
from ..functions.missing import fill, first_valid, text_or_blank, text_or_null
from ..functions.text import drop_strict, snake_case, trim_text, with_prefix
from ..sources.spec import Field, TableSpec, fields
from .registry import Tables, query, tidy_sql

ORDER_SPEC = TableSpec(
    fields(
        "Order Key:order_key:bigint",
        "Cust Key:cust_key:int",
        "Order Status:order_status",
        "Total Price:total_price:double",
        "Order Date:order_date:timestamp",
        Field("Order Priority", "order_priority", missing=("5-LOW",), default="none"),
        Field("Remark", "remark", optional=True),
    )
)


@query(
    tidy_sql(
        """SELECT o_orderkey AS order_key, o_custkey AS cust_key, o_orderstatus AS order_status,
                  o_totalprice AS total_price, o_orderdate AS order_date,
                  CASE WHEN o_orderpriority = '5-LOW' THEN 'none' ELSE o_orderpriority END AS order_priority,
                  CAST(NULL AS VARCHAR) AS remark, false AS default_values_used, 0.95 AS target_rate
           FROM orders""",
        double="total_price target_rate", long="cust_key", ts="order_date",
    )
)
def typed_projection(t: Tables) -> DataFrame:
    """Orders as padded text, read back through a table spec, with constants."""
    text = t.orders.select(
        *[F.concat(F.lit(" "), F.col(c).cast("string"), F.lit("  ")).alias(n) for c, n in (
            ("o_orderkey", "Order Key"), ("o_custkey", "CUST KEY"), ("o_orderstatus", "Order Status"),
            ("o_totalprice", "Total Price"), ("o_orderdate", "Order Date"), ("o_orderpriority", "Order Priority"),
        )]
    )
    return ORDER_SPEC.apply(text).withColumns({"default_values_used": F.lit(False), "target_rate": F.lit(0.95)})


@query(
    """SELECT c_custkey AS cust_key, 'Customer' AS cust_kind, c_name AS "cust_full_name", c_mktsegment AS cust_segment
       FROM customer"""
)
def renamed_columns(t: Tables) -> DataFrame:
    """Snake case, trimming, prefixes and strict drops."""
    raw = t.customer.select(
        F.col("c_custkey").alias("Key"), F.lit(" Customer ").alias("Kind"), F.concat("c_name", F.lit(" ")).alias("Full Name"),
        F.col("c_mktsegment").alias("SEGMENT"), F.col("c_acctbal").alias("Account Balance"),
    )
    return with_prefix(drop_strict(trim_text(snake_case(raw)), "account_balance"), "cust_")


@query(
    """SELECT event_id,
              CASE WHEN event_type IN ('error', 'signup') THEN '' ELSE event_type END AS reason,
              CASE WHEN event_type IN ('error', 'signup', 'view') THEN NULL ELSE event_type END AS group_name,
              CASE WHEN event_type = 'click' THEN 0.0 ELSE CAST(event_id AS DOUBLE) END AS yield_target
       FROM events"""
)
def missing_normalise(t: Tables) -> DataFrame:
    """Null, blank and placeholder words to one form of "missing"."""
    kind = F.col("event_type")
    raw = t.events.select(
        "event_id",
        F.when(kind == "error", F.lit(None)).when(kind == "signup", "NULL").otherwise(kind).alias("reason"),
        F.when(kind == "error", "nan").when(kind == "signup", "").when(kind != "view", kind).alias("group_name"),
        F.when(kind != "click", F.col("event_id").cast("double")).alias("yield_target"),
    )
    words = raw.withColumns({"reason": text_or_blank(F.col("reason")), "group_name": text_or_null(F.col("group_name"))})
    return fill(words, {"yield_target": 0.0})


@query(
    tidy_sql(
        """SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN value ELSE CAST(user_id AS DOUBLE) END AS rate,
                  CASE WHEN event_type = 'error' THEN props ELSE event_type END AS label
           FROM events""",
        double="rate",
    )
)
def first_valid_value(t: Tables) -> DataFrame:
    """The first of two columns that holds a value: NaN and null count as missing."""
    kind, value = F.col("event_type"), F.col("value")
    broken = F.when(kind.isin("view", "click"), value).when(kind == "error", F.lit(float("nan")))
    return t.events.select(
        "event_id",
        first_valid(broken, F.col("user_id").cast("double"), numeric=True).alias("rate"),
        first_valid(F.when(kind != "error", kind), F.col("props")).alias("label"),
    )


@query(
    tidy_sql(
        """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE date_trunc('second', ts) END AS event_time
           FROM events""",
        ts="event_time",
    )
)
def parse_multi_format(t: Tables) -> DataFrame:
    """Timestamps written in two formats, one of them with fractions, and some that fit neither."""
    ts = F.col("ts").cast("timestamp")
    text = (
        F.when(F.col("event_type") == "error", F.date_format(ts, "dd/MM/yyyy"))
        .when(F.col("event_type").isin("view", "click"), F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS"))
    )
    return t.events.select("event_id", parse_stamp(text).alias("event_time"))
