"""Compare registered queries with their SQL answers: ``python tests/oracle.py [folder] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def difference(spark, con, name: str, folder: str) -> str | None:
    """None when query and SQL agree in columns, row count and every value, else a short description."""
    from plantmart.workload import QUERIES, SQL

    frame = QUERIES[name](spark, folder)
    got = [tuple(r) for r in frame.collect()]
    answer = con.execute(SQL[name])
    columns = [d[0] for d in answer.description]
    want = answer.fetchall()
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    got, want = rows_of(frame.columns, got), rows_of(columns, want)
    if got == want:
        types = [(c, type(a).__name__, type(b).__name__) for c, a, b in zip(sorted(columns), got[0], want[0]) if got and type(a) is not type(b) and a is not None and b is not None] if got else []
        return f"types differ {types}" if types else None
    only_got, only_want = list(set(got) - set(want))[:3], list(set(want) - set(got))[:3]
    return f"rows {len(got)} != {len(want)}; {sorted(columns)}\n    spark only {only_got}\n    sql only   {only_want}"


def main() -> None:
    from pyspark.sql import SparkSession

    from plantmart.workload import QUERIES, SQL

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connection(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            found = difference(spark, con, name, folder) if name in SQL else "no SQL"
        except Exception as e:  # noqa: BLE001 - the report lists every failure
            found = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - start:.1f}s {found or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
