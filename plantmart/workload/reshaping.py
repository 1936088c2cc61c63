"""Wide, long and inverse forms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.reshape import complement_pairs, membership_matrix, unpivot, value_list, with_inverse
from .registry import Tables, query, tidy_sql

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_SOLD = """SELECT DISTINCT l_partkey, c_mktsegment FROM lineitem JOIN orders ON o_orderkey = l_orderkey
           JOIN customer ON c_custkey = o_custkey"""
_MATRIX = ", ".join(
    f"max(CASE WHEN c_mktsegment = '{s}' THEN 'Yes' ELSE 'No' END) AS sold_{s}" for s in SEGMENTS
)


def sold_pairs(t: Tables) -> DataFrame:
    """Which part was sold to which customer segment."""
    return (
        t.lineitem.select("l_partkey", "l_orderkey")
        .join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
        .select("l_partkey", "c_mktsegment")
    )


@query(f"SELECT l_partkey, {_MATRIX} FROM ({_SOLD}) s GROUP BY 1")
def membership(t: Tables) -> DataFrame:
    """One Yes/No column per segment; the column names come from the data."""
    segments = value_list(t.customer, "c_mktsegment")
    return membership_matrix(sold_pairs(t), "l_partkey", "c_mktsegment", segments, "sold_")


@query(
    f"""UNPIVOT (SELECT l_partkey, {_MATRIX} FROM ({_SOLD}) s GROUP BY 1)
        ON {', '.join(f'sold_{s}' for s in SEGMENTS)} INTO NAME segment VALUE sold"""
)
def unpivot_matrix(t: Tables) -> DataFrame:
    """The matrix back in long form."""
    matrix = membership_matrix(sold_pairs(t), "l_partkey", "c_mktsegment", SEGMENTS, "sold_")
    return unpivot(matrix, ["l_partkey"], [f"sold_{s}" for s in SEGMENTS], "segment", "sold")


@query(
    f"""SELECT p_partkey AS l_partkey, s.c_mktsegment FROM part, (SELECT DISTINCT c_mktsegment FROM customer) s
        EXCEPT ({_SOLD})"""
)
def complement(t: Tables) -> DataFrame:
    """Part and segment combinations that were never sold, parts without any sale included."""
    return complement_pairs(
        sold_pairs(t), "l_partkey", "c_mktsegment", keys=t.part.select(F.col("p_partkey").alias("l_partkey")), values=t.customer
    )


@query(
    tidy_sql(
        """WITH r AS (SELECT CAST(o_custkey AS VARCHAR) AS source, o_orderpriority AS target, sum(o_totalprice) / 1000 AS rate FROM orders GROUP BY ALL)
           SELECT source, target, rate FROM r UNION ALL SELECT target, source, 1.0 / rate FROM r""",
        double="rate",
    )
)
def inverse_rows(t: Tables) -> DataFrame:
    """Every mapping and its inverse."""
    rates = t.orders.groupBy(F.col("o_custkey").cast("string").alias("source"), F.col("o_orderpriority").alias("target")).agg(
        (F.sum("o_totalprice") / 1000).alias("rate")
    )
    return with_inverse(rates, "source", "target", "rate")
