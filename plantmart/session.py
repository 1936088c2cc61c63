"""Session settings the library relies on, and the shared folder for cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Run-time SQL settings only; cluster sizing (executors, memory, shuffle partitions) stays with the caller.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when that costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time SQL settings to a session and return it."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


# What one task reads at most of a file, and of a shuffle whose small partitions are put together: its memory follows from this
# and not from the size of the tables.
TASK_BYTES = 16 << 20
TASK_SETTINGS = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
# Partitions that a shuffle begins with; adaptive execution puts them together up to TASK_BYTES, but does not split them.
FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
LEAST_PARTITIONS = 1000
_UNITS = {unit: 1024**power for power, unit in enumerate("bkmgtp")}


def _bytes(size: str) -> int:
    """A size as Spark writes it: a number with or without a unit."""
    number, unit = re.fullmatch(r"(\d+)\s*([a-z]*)", size.strip().lower()).groups()
    return int(number) * _UNITS[unit[:1] or "b"]


def bound_tasks(spark: SparkSession) -> SparkSession:
    """Keep what a task reads, and so its sorts and hash tables, below one size however large the tables are.

    A session with smaller sizes or more partitions keeps its own. ``spark.sql.shuffle.partitions`` stays with the caller.
    """
    for name in TASK_SETTINGS:
        if _bytes(spark.conf.get(name)) > TASK_BYTES:
            spark.conf.set(name, f"{TASK_BYTES}b")
    own = max(int(spark.conf.get(FIRST_PARTITIONS, None) or 0), int(spark.conf.get("spark.sql.shuffle.partitions")))
    if own < LEAST_PARTITIONS:
        spark.conf.set(FIRST_PARTITIONS, LEAST_PARTITIONS)
    return spark


def compile_large_stages(spark: SparkSession) -> None:
    """Let stages whose generated method HotSpot would only interpret (more than 8000 bytes) run operator by operator, each compiled."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as named by ``spark.checkpoint.dir``.

    Only a local session that names none (tests on one machine) gets a folder of its own; on a cluster that is an error,
    because executors cannot see the driver's temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    current = context.getCheckpointDir()
    if current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="plantmart-"))
        current = context.getCheckpointDir()
    return current


# Lists of work paths, the innermost job's last; the first one is for work outside a job.
_jobs: list[list[str]] = [[]]
_tables: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _jobs[-1].append(path)
    return path


def _remove(spark: SparkSession, name: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def work_removed(spark: SparkSession) -> Iterator[None]:
    """Remove the work paths made inside the block at its end, also when it fails; nothing may read them any more."""
    own: list[str] = []
    _jobs.append(own)
    try:
        yield
    finally:
        _jobs.remove(own)
        for name in own:
            _remove(spark, name)


def remove_table(df: DataFrame) -> None:
    """Remove the files of a table that ``cut_lineage`` returned, when nothing reads it any more."""
    path = _tables.pop(df, None)
    if path:
        _remove(df.sparkSession, path)


# Shuffle files of a query that writes a table are of no use once it is written.
RELEASE = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.shuffleDependency.fileCleanup.enabled")


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Let Spark remove the shuffle files of each query inside the block at the query's end."""
    before = {name: spark.conf.get(name, None) for name in RELEASE}
    for name in RELEASE:
        spark.conf.set(name, "true")
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    Every later use reads the same rows, also after an executor is lost, with column pruning and real sizes.
    """
    spark = df.sparkSession
    path = work_path(spark, "table")
    with shuffles_released(spark):
        df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    _tables[stored] = path
    return stored
