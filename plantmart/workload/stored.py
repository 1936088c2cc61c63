"""Queries that write and read back: site folders, history, several outputs.

They write below the shared folder of the session, each run to a path of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, work_path
from ..sources.files import Catalog, literal_rows, read_optional, scan_sites
from ..sources.history import merge_history, upsert
from ..sources.sink import with_audit, write_outputs, write_table
from ..sources.spec import TableSpec, fields
from ..sources.stream import load_arrived
from ..plans.inputs import MOVEMENTS
from ..plans.jobs import publish_movements
from .registry import Tables, query, tidy_sql

CUSTOMER_SPEC = TableSpec(fields("Key:key:bigint", "Full Name:full_name", "Balance:balance:double", "Segment"))


@query(
    tidy_sql(
        "SELECT 'site ' || CAST(c_nationkey AS VARCHAR) AS site, c_custkey AS key, c_name AS full_name, c_acctbal AS balance, c_mktsegment AS segment FROM customer",
        double="balance",
    )
)
def csv_scan_typed(t: Tables) -> DataFrame:
    """Customers as one CSV folder per site, read back in one scan with the folder as a column."""
    root = work_path(t.spark, "csv")
    rows = t.customer.select(
        F.concat(F.lit("site "), F.col("c_nationkey").cast("string")).alias("site"),
        F.col("c_custkey").alias("Key"), F.col("c_name").alias("Full Name"), F.col("c_acctbal").alias("Balance"),
        F.col("c_mktsegment").alias("Segment"),
    )
    rows.write.partitionBy("site").option("header", True).csv(root)
    found = scan_sites(t.spark, root, "*.csv", CUSTOMER_SPEC, "site")
    return found.withColumn("site", F.regexp_replace("site", "^site=", ""))


@query(
    tidy_sql(
        """SELECT o_orderkey, o_orderpriority, o_orderstatus,
                  CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE o_totalprice + 1 END AS o_totalprice FROM orders""",
        double="o_totalprice",
    )
)
def upsert_history(t: Tables) -> DataFrame:
    """Two loads into one stored table, the second changing some orders and adding others."""
    path = work_path(t.spark, "history")
    orders = t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice")
    upsert(t.spark, orders.filter("o_orderstatus <> 'O'"), path, ["o_orderkey"], ["o_orderpriority"])
    changed = orders.filter("o_orderstatus <> 'F'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return upsert(t.spark, changed, path, ["o_orderkey"], ["o_orderpriority"])


@query(
    tidy_sql(
        """SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus = 'P' THEN 'new' WHEN o_orderstatus = 'O' THEN 'new' ELSE 'old' END AS origin
           FROM orders""",
        double="o_totalprice",
    )
)
def merge_rows(t: Tables) -> DataFrame:
    """Union of new rows and history with one row per key, new rows first."""
    def rows(condition: str, origin: str) -> DataFrame:
        return t.orders.filter(condition).select("o_orderkey", "o_totalprice", F.lit(origin).alias("origin"))

    return merge_history(rows("o_orderstatus <> 'F'", "new"), rows("o_orderstatus <> 'O'", "old"), ["o_orderkey"])


@query(
    """SELECT n_nationkey AS key, count(c_custkey) AS n FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1
       UNION ALL SELECT -1, 0"""
)
def literal_and_optional_rows(t: Tables) -> DataFrame:
    """Counts per nation, a literal row, and an optional source that is not there."""
    counts = t.nation.join(t.customer, F.col("c_nationkey") == F.col("n_nationkey"), "left").groupBy(
        F.col("n_nationkey").cast("long").alias("key")
    ).agg(F.count("c_custkey").alias("n"))
    absent = read_optional(t.spark, work_path(t.spark, "absent"), counts.schema)
    return counts.unionByName(literal_rows(t.spark, [(-1, 0)], "key long, n long")).unionByName(absent)


@query(
    tidy_sql(
        """WITH s AS (SELECT l_partkey, l_suppkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY ALL)
           SELECT 'all' AS output, count(*) AS n, sum(quantity) AS quantity FROM s
           UNION ALL SELECT 'check', count(*), sum(quantity) FROM s WHERE quantity > 60
           UNION ALL SELECT 'unknown part', count(*), sum(quantity) FROM s WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_type <> 'PROMO')""",
        double="quantity",
    )
)
def shared_outputs(t: Tables) -> DataFrame:
    """Three tables of one parent: the parent is computed once, the tables are written and read back."""
    catalog = Catalog(t.spark, {"lines": t.lineitem, "parts": f"{t.folder}/part.parquet"})
    parent = cut_lineage(catalog("lines").groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").alias("quantity")))
    known = catalog("parts").filter("p_type <> 'PROMO'").select(F.col("p_partkey").alias("l_partkey"))
    outputs = {
        "all": parent,
        "check": parent.filter("quantity > 60"),
        "unknown part": parent.join(known, "l_partkey", "left_anti"),
    }
    root = work_path(t.spark, "outputs")
    write_outputs({n: with_audit(df, n) for n, df in outputs.items()}, root)
    stored = [t.spark.read.parquet(f"{root}/{n}") for n in outputs]
    both = stored[0].unionByName(stored[1]).unionByName(stored[2])
    result = both.groupBy(F.col("source_system").alias("output")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("quantity")
    )
    write_table(result, f"{root}/summary", few_files=True)
    return t.spark.read.parquet(f"{root}/summary")


# Movement headers with the line column or text that fills them; a quantity is unreadable for each 11th order, a day for each 13th.
_MOVED = {
    "MBLNR": "CAST(l_orderkey AS {text})", "ZEILE": "CAST(l_linenumber AS {text})", "BWART": "CASE WHEN l_returnflag = 'R' THEN '102' ELSE '101' END",
    "MATNR": "CAST(l_partkey AS {text})", "CHARG": "CAST(l_suppkey AS {text})", "SHKZG": "l_linestatus", "AUFNR": "'000' || CAST(l_orderkey AS {text})",
    "MENGE": "CASE WHEN l_orderkey % 11 = 0 THEN 'n/a ' || l_returnflag WHEN l_orderkey % 17 = 0 THEN '' ELSE CAST(CAST(l_quantity AS {whole}) AS {text}) END",
    "BUDAT_MKPF": "CASE WHEN l_orderkey % 13 = 0 THEN '31.12.' ELSE {day} END",
}


FILE_ROWS = 250_000


def _movement_files(t: Tables) -> str:
    """Line items as packed movement files, one folder for each of three sites."""
    root = work_path(t.spark, "movements")
    day = "date_format(l_shipdate, 'yyyy-MM-dd')"
    made = {name: text.format(text="STRING", whole="INT", day=day) for name, text in _MOVED.items()}
    columns = [F.expr(made[f.source]).alias(f.source) if f.source in made else F.lit("").alias(f.source) for f in MOVEMENTS.fields]
    rows = t.lineitem.select(F.format_string("s%d", F.col("l_suppkey") % 3).alias("site"), *columns)
    # A packed file is read by one task: a bounded number of rows in each.
    writer = rows.write.partitionBy("site").option("header", True).option("compression", "gzip").option("maxRecordsPerFile", FILE_ROWS)
    writer.csv(root)
    return root


def _raw_movements(t: Tables) -> tuple[DataFrame, dict[str, int]]:
    family = {"movements": scan_sites(t.spark, _movement_files(t), "*.csv.gz", MOVEMENTS, "source_site", checked=True)}
    path = work_path(t.spark, "raw")
    counts = publish_movements(t.spark, {"line": family}, path)
    return t.spark.read.parquet(path), counts


_MOVED_SQL = f"""
    m AS (SELECT 'site=s' || CAST(l_suppkey % 3 AS VARCHAR) AS source_site,
                 {', '.join(f"{v.format(text='VARCHAR', whole='INTEGER', day="strftime(l_shipdate, '%Y-%m-%d')")} AS {k.lower()}_text" for k, v in _MOVED.items())}
          FROM lineitem)"""


@query(
    tidy_sql(
        f"""WITH {_MOVED_SQL}
            SELECT source_site, mblnr_text AS mblnr, zeile_text AS zeile, bwart_text AS bwart, matnr_text AS matnr, charg_text AS charg,
                   shkzg_text AS shkzg, aufnr_text AS aufnr, try_cast(menge_text AS DOUBLE) AS menge, try_strptime(budat_mkpf_text, '%Y-%m-%d') AS budat_mkpf,
                   CAST(NULL AS DOUBLE) AS erfmg, CAST(NULL AS VARCHAR) AS equnr,
                   CASE WHEN starts_with(menge_text, 'n/a') THEN menge_text END AS rejected_menge,
                   CASE WHEN budat_mkpf_text = '31.12.' THEN budat_mkpf_text END AS rejected_day
            FROM m""",
        double="menge", day="budat_mkpf",
    )
)
def raw_movements(t: Tables) -> DataFrame:
    """The published raw movements: every row, typed, with the texts that are no quantity or no day."""
    stored, _ = _raw_movements(t)
    return stored.select(
        "source_site", "mblnr", "zeile", "bwart", "matnr", "charg", "shkzg", "aufnr", "menge", "budat_mkpf", "erfmg", "equnr",
        F.col("rejected")["menge"].alias("rejected_menge"), F.col("rejected")["budat_mkpf"].alias("rejected_day"),
    )


@query(
    f"""WITH {_MOVED_SQL}
        SELECT 'rows' AS figure, count(*) AS n FROM m
        UNION ALL SELECT 'rejected_menge', count(*) FILTER (starts_with(menge_text, 'n/a')) FROM m
        UNION ALL SELECT 'rejected_budat_mkpf', count(*) FILTER (budat_mkpf_text = '31.12.') FROM m
        UNION ALL SELECT unnest(['rejected_erfmg', 'rejected_pbamg', 'rejected_cpudt_mkpf']), 0"""
)
def rejected_values(t: Tables) -> DataFrame:
    """Rows and rejects by column, as counted by the job that wrote the raw movements."""
    _, counts = _raw_movements(t)
    return literal_rows(t.spark, list(counts.items()), "figure string, n long")


@query(
    tidy_sql(
        """SELECT o_orderkey, o_orderpriority, o_orderstatus, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 2 ELSE o_totalprice END AS o_totalprice,
                  CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END AS release FROM orders""",
        double="o_totalprice", long="release",
    )
)
def stream_history(t: Tables) -> DataFrame:
    """Orders that arrive as files, some sent twice and some with a later release before the earlier one, loaded two files at a time."""
    source, path, checkpoint = (work_path(t.spark, x) for x in ("arrived", "history", "checkpoint"))
    orders = t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice", F.lit(1).alias("release"))
    later = orders.filter("o_orderkey % 3 = 0").withColumns({"o_totalprice": F.col("o_totalprice") + 2, "release": F.lit(2)})
    load = lambda: load_arrived(
        t.spark, source, orders.schema, path, checkpoint, ["o_orderkey"], ["o_orderpriority"], ["release"], buckets=8, files_at_once=2
    )
    later.repartition(2).write.parquet(source)
    orders.filter("o_orderkey % 5 < 3").repartition(3).write.mode("append").parquet(source)
    load()
    orders.filter("o_orderkey % 5 >= 2").repartition(2).write.mode("append").parquet(source)
    return load()


@query(
    tidy_sql(
        """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders""",
        double="o_totalprice",
    )
)
def bucketed_history(t: Tables) -> DataFrame:
    """Two loads into a history divided by a hash of the key."""
    path = work_path(t.spark, "history")
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    upsert(t.spark, orders.filter("o_orderkey % 8 <> 0"), path, ["o_orderkey"], [], buckets=16)
    changed = orders.filter("o_orderkey % 4 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return upsert(t.spark, changed, path, ["o_orderkey"], [], buckets=16)
