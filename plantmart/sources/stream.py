"""Repeated loads of files into stored history as a stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .files import path_exists
from .history import upsert

ARRIVED = "__arrived"


def arrivals(spark: SparkSession, source: str, schema: StructType, files_at_once: int | None = None, again_within: str = "1 day") -> DataFrame:
    """Rows of the parquet files below ``source`` as they arrive, without rows that were sent again.

    A row equal in all columns to one that arrived at most ``again_within`` before is left out. The time is that of the row's file, which
    never runs back, so no row is late and none is lost; the state holds the rows of that time only. What is sent again later
    passes, and merging it changes nothing.
    """
    reader = spark.readStream.schema(schema)
    if files_at_once:
        reader = reader.option("maxFilesPerTrigger", files_at_once)
    rows = reader.parquet(source).select("*", F.col("_metadata.file_modification_time").alias(ARRIVED))
    return rows.withWatermark(ARRIVED, again_within).dropDuplicatesWithinWatermark(schema.names).select(*schema.names)


def batch_merger(
    path: str, done: str, keys: Sequence[str], partition_by: Sequence[str], order: Sequence[str], buckets: int = 0
) -> Callable[[DataFrame, int], None]:
    """Merges a batch into the history at ``path`` once: ``done`` has a mark for each batch that is in.

    A batch that failed between both is merged again, which gives the same rows.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        mark = f"{done.rstrip('/')}/batch-{number}"
        if path_exists(spark, mark):
            return
        if not batch.isEmpty():
            upsert(spark, batch, path, keys, partition_by, order, buckets, by_release=True)
        name = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(mark)
        name.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(name)

    return merge


def load_arrived(
    spark: SparkSession, source: str, schema: StructType, path: str, checkpoint: str, keys: Sequence[str], partition_by: Sequence[str],
    order: Sequence[str], buckets: int = 0, files_at_once: int | None = None, again_within: str = "1 day",
) -> DataFrame:
    """Merge all files that arrived below ``source`` since the last call into the history at ``path``, and return the stored table.

    ``order`` must decide between all rows of a key that differ: then the result is that of one load of all rows, however they are
    split into files and batches. ``checkpoint`` remembers what has been read and which batches are in. Null keys are keys; a source
    without files leaves the history as it is.
    """
    rows = arrivals(spark, source, schema, files_at_once, again_within)
    merge = batch_merger(path, f"{checkpoint.rstrip('/')}/merged", keys, partition_by, order, buckets)
    stream = (
        rows.writeStream.foreachBatch(merge).option("checkpointLocation", f"{checkpoint.rstrip('/')}/stream").trigger(availableNow=True).start()
    )
    stream.awaitTermination()
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.parquet(path).select(*[F.col(f.name).cast(f.dataType) for f in schema])
