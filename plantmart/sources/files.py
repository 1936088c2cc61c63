"""Scans of per-site CSV folders and of catalogued tables, optional sources, literal rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, StructType

from .spec import TableSpec


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when the path or glob matches something in its file system."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(path)
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    return found is not None and len(found) > 0


def scan_sites(
    spark: SparkSession, root: str, file: str, spec: TableSpec, site_column: str = "source_site", sites: Sequence[str] = (),
    checked: bool = False,
) -> DataFrame:
    """One scan over ``root/<site>/file`` for all sites, or only the folders in ``sites``; the folder name is a column.

    All text, columns taken by header name. Every file's header is checked against the first one, so a site with
    another column order fails instead of shifting values. ``checked`` keeps what has no value (``TableSpec.checked``).
    """
    raw = _csv(spark, [f"{root.rstrip('/')}/{site}/{file}" for site in sites or ["*"]])
    # ``file`` may lie in a sub-folder of the site. input_file_name rather than the metadata column: a run-time join
    # filter on the latter can reach the scan before it is ready when the scan runs without generated code.
    folder = F.element_at(F.split(F.input_file_name(), "/"), -2 - file.count("/"))
    name = F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))
    return (spec.checked if checked else spec.apply)(raw.withColumn(site_column, name), keep=[site_column])


def read_csv(spark: SparkSession, path: str, spec: TableSpec, checked: bool = False) -> DataFrame:
    """CSV with a header, all text, typed by the spec."""
    return (spec.checked if checked else spec.apply)(_csv(spark, path))


def _csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.option("header", True).option("enforceSchema", False).csv(path)


def read_optional(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Parquet at ``path``, or no rows of ``schema`` when nothing is there. A schema conflict is an error."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.parquet(path).select(*[F.col(f.name).cast(f.dataType) for f in schema])


def scan_optional_sites(
    spark: SparkSession, root: str, file: str, spec: TableSpec, site_column: str = "source_site"
) -> DataFrame:
    """As ``scan_sites``, but no rows when no site has the file."""
    if path_exists(spark, f"{root.rstrip('/')}/*/{file}"):
        return scan_sites(spark, root, file, spec, site_column)
    raw = spark.createDataFrame([], spec.source_schema()).withColumn(site_column, F.lit(None).cast("string"))
    return spec.apply(raw, keep=[site_column])


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str | StructType) -> DataFrame:
    """Given rows as a relation whose size Spark knows: joined to a large table, they are broadcast, and the table is not dealt out
    by their few keys first."""
    kind = schema if isinstance(schema, StructType) else DataType.fromDDL(schema)
    given = pa.Table.from_pylist([dict(zip(kind.names, row)) for row in rows], to_arrow_schema(kind))
    return spark.createDataFrame(given, kind)


class Catalog:
    """Named inputs: a name maps to a parquet path, a catalogued table, or a ready frame."""

    def __init__(self, spark: SparkSession, tables: Mapping[str, str | DataFrame]):
        self.spark = spark
        self.tables = dict(tables)

    def __call__(self, name: str) -> DataFrame:
        target = self.tables.get(name, name)
        if isinstance(target, DataFrame):
            return target
        if "/" in target:
            return self.spark.read.parquet(target)
        return self.spark.table(target)
