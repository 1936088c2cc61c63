"""Ordered operators on events and lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import production_day
from ..operators import ordered
from ..operators.dedup import first_by, latest_by, latest_release
from .joining import LINE_ORDER, ship_chunk
from .registry import Tables, query, tidy_sql


def chunked(rows: DataFrame) -> tuple[DataFrame, Column]:
    """Events with the library's chunk of time."""
    return rows, ordered.time_chunk("ts")


@query(
    """SELECT event_id, user_id,
              CAST(floor(epoch(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) - floor(epoch(ts)) AS BIGINT) AS duration_s
       FROM events"""
)
def event_duration(t: Tables) -> DataFrame:
    """Whole seconds to the user's next event."""
    rows, chunk = chunked(t.events.select("event_id", "user_id", "ts"))
    rows = ordered.next_value(rows, "ts", ["user_id"], ["ts", "event_id"], chunk, "next_ts")
    seconds = F.unix_timestamp(F.col("next_ts").cast("timestamp")) - F.unix_timestamp(F.col("ts").cast("timestamp"))
    return rows.select("event_id", "user_id", seconds.alias("duration_s"))


@query(
    tidy_sql(
        """WITH e AS (SELECT *, CAST(ts - INTERVAL 6 HOUR AS DATE) AS day FROM events),
           r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, day ORDER BY ts DESC, event_id DESC) AS rn FROM e)
           SELECT user_id, event_type, day, event_id, value FROM r WHERE rn = 1""",
        double="value", day="day",
    )
)
def latest_event_per_day(t: Tables) -> DataFrame:
    """Last event per user, kind and production day (which begins at six)."""
    rows = t.events.withColumn("day", production_day(F.col("ts").cast("timestamp"), 6))
    return latest_by(rows, ["user_id", "event_type", "day"], ["ts", "event_id"]).select(
        "user_id", "event_type", "day", "event_id", "value"
    )


@query(
    """WITH w AS (SELECT user_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1)
       SELECT event_id, user_id, event_type FROM events JOIN w USING (user_id, event_type)"""
)
def latest_release_rows(t: Tables) -> DataFrame:
    """All rows whose release is that of the user's newest row."""
    rows = t.events.select("event_id", "user_id", "event_type")
    return latest_release(rows, ["user_id"], "event_type", ["event_id"]).select("event_id", "user_id", "event_type")


@query(
    tidy_sql(
        """SELECT event_id, last_value(CASE WHEN event_type = 'view' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id
                  ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rate,
                  last_value(CASE WHEN event_type = 'click' THEN props END IGNORE NULLS) OVER (PARTITION BY user_id
                  ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS label FROM events""",
        double="rate",
    )
)
def ffill_rate(t: Tables) -> DataFrame:
    """Last known rate and label."""
    rows = t.events.select(
        "event_id", "user_id", "ts",
        F.when(F.col("event_type") == "view", F.col("value")).alias("r"),
        F.when(F.col("event_type") == "click", F.col("props")).alias("l"),
    )
    rows, chunk = chunked(rows)
    return ordered.forward_fill(rows, {"r": "rate", "l": "label"}, ["user_id"], ["ts", "event_id"], chunk).select(
        "event_id", "rate", "label"
    )


@query(
    tidy_sql(
        """SELECT event_id, first_value(CASE WHEN event_type = 'view' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id
                  ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate FROM events""",
        double="rate",
    )
)
def bfill_rate(t: Tables) -> DataFrame:
    """Next known rate."""
    rows = t.events.select("event_id", "user_id", "ts", F.when(F.col("event_type") == "view", F.col("value")).alias("r"))
    rows, chunk = chunked(rows)
    return ordered.backward_fill(rows, {"r": "rate"}, ["user_id"], ["ts", "event_id"], chunk).select("event_id", "rate")


@query(
    tidy_sql(
        """SELECT event_id, coalesce(sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM events""",
        double="before",
    )
)
def exclusive_prefix_sum(t: Tables) -> DataFrame:
    """Total of the user's earlier events."""
    rows, chunk = chunked(t.events.select("event_id", "user_id", "ts", "value"))
    return ordered.total_before(rows, "value", ["user_id"], ["ts", "event_id"], chunk, "before").select("event_id", "before")


@query(
    tidy_sql(
        """SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice,
                  row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS nth
           FROM lineitem""",
        double="l_extendedprice", long="l_linenumber",
    )
)
def occurrence_number(t: Tables) -> DataFrame:
    """Running number of a supplier's lines in shipping order."""
    columns = ["l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    return ordered.occurrence_index(
        t.lineitem.select(*columns, "l_shipdate"), ["l_suppkey"], order, ship_chunk(), "nth"
    ).drop("l_shipdate")


@query(
    tidy_sql(
        """SELECT l_partkey, l_quantity, coalesce(lead(l_quantity) OVER (PARTITION BY l_partkey ORDER BY l_quantity), 1e12) AS max_vol
           FROM (SELECT DISTINCT l_partkey, l_quantity FROM lineitem) x""",
        double="l_quantity max_vol",
    )
)
def next_threshold(t: Tables) -> DataFrame:
    """Quantity steps of a part and where each ends."""
    return ordered.next_step(t.lineitem, ["l_partkey"], "l_quantity", "max_vol", 1e12)


@query(
    tidy_sql(
        """WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity) AS rn FROM lineitem)
           SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, l_extendedprice FROM r WHERE rn = 1""",
        double="l_extendedprice", long="l_linenumber",
    )
)
def first_per_key(t: Tables) -> DataFrame:
    """First shipped line of each part, in part order."""
    return (
        first_by(t.lineitem, ["l_partkey"], LINE_ORDER)
        .select("l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
        .orderBy(F.col("l_partkey").asc_nulls_first())
    )
