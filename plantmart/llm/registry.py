"""Queries of this folder: name to function of session and folder, and SQL answers where SQL can give them."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


BATCH_ROWS = 2000
_shipped: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Set the library's run-time options, and let Spark send the package to the executors once per application."""
    context = spark.sparkContext
    package = Path(__file__).resolve().parents[1]
    if context.applicationId not in _shipped and package.is_dir():
        folder = tempfile.mkdtemp(prefix=f"{package.name}-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        path = Path(folder, f"{package.name}.zip")
        with zipfile.ZipFile(path, "w") as archive:
            for file in sorted(package.rglob("*.py")):
                archive.write(file, file.relative_to(package.parent))
        context.addPyFile(str(path))  # served from here as long as the application runs
        _shipped.add(context.applicationId)
    # Whole texts are long; fewer of them in a batch keep the memory of Python workers and of Arrow's buffers down.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return configure(spark)


def query(name: str, sql: str | None = None):
    """Register a function of session and folder under ``name``."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(prepare(spark), folder)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def first_by_hash(rows: DataFrame, key: str, most: int) -> DataFrame:
    """At most ``most`` rows, the ones whose ``key`` has the smallest hash: the same rows on every run."""
    return rows.orderBy(F.xxhash64(F.col(key)), F.col(key)).limit(most)
