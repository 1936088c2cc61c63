"""Registration of queries and a common result form that both engines can produce exactly."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import bound_tasks, configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
DIGITS = 6


_SCHEMAS: dict[str, T.StructType] = {}


class Tables:
    """The driver's parquet tables by attribute; a file's schema is inferred once."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)


def query(sql: str | None = None, name: str | None = None):
    """Register a function of ``Tables``; its name is the query key."""

    def register(build: Callable[[Tables], DataFrame]):
        key = name or build.__name__

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return tidy(build(Tables(bound_tasks(configure(spark)), folder)))

        QUERIES[key] = run
        if sql is not None:
            SQL[key] = sql
        return build

    return register


# The engines round an exact half differently; this shift takes values off the half in both.
NUDGE = 1e-8


# Below this a double has digits enough to tell how far from a half its last digit is.
CLEAR = 1e7


def rounded(column: Column) -> Column:
    """``round`` to ``DIGITS``, which goes through text: whole numbers, and values clearly off a half, take plain arithmetic to the
    same double (a whole number divided by a power of ten is the double nearest to the decimal)."""
    moved = column.cast("double") + NUDGE
    scaled = moved * F.lit(10.0**DIGITS)
    whole = F.rint(scaled)
    clear = (F.abs(moved) < CLEAR) & (F.abs(scaled - whole) < 0.49)
    value = F.when(F.rint(moved) == moved, moved).when(clear, whole / F.lit(10.0**DIGITS)).otherwise(F.round(moved, DIGITS))
    return F.when(value == 0, F.lit(0.0)).otherwise(value)


def tidy(df: DataFrame) -> DataFrame:
    """Days as text, timestamps as microseconds, whole numbers as bigint, other numbers rounded."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.unix_micros(c.cast("timestamp"))
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = rounded(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def tidy_sql(sql: str, double: str = "", long: str = "", day: str = "", ts: str = "") -> str:
    """The same form in SQL; each argument lists column names."""
    parts = [
        f'CASE WHEN round(CAST("{c}" AS DOUBLE) + {NUDGE}, {DIGITS}) = 0 THEN CAST(0 AS DOUBLE)'
        f' ELSE round(CAST("{c}" AS DOUBLE) + {NUDGE}, {DIGITS}) END AS "{c}"'
        for c in double.split()
    ]
    parts += [f'CAST("{c}" AS BIGINT) AS "{c}"' for c in long.split()]
    parts += [f'strftime("{c}", \'%Y-%m-%d\') AS "{c}"' for c in day.split()]
    parts += [f'epoch_us("{c}") AS "{c}"' for c in ts.split()]
    return f"SELECT * REPLACE ({', '.join(parts)}) FROM ({sql}) AS result" if parts else sql
