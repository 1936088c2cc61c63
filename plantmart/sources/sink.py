"""Thin runner: plans stay lazy until here. What is written is counted on the way."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ROWS = "rows"


class Published(dict):
    """Stored tables by name, and in ``counts`` for each the rows and other figures taken while it was written."""

    def __init__(self, tables: Mapping[str, DataFrame], counts: Mapping[str, Mapping[str, int]]):
        super().__init__(tables)
        self.counts = dict(counts)


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), few_files: bool = False, most_rows: int | None = None,
    figures: Mapping[str, Column] | None = None,
) -> dict[str, int]:
    """Overwrite a parquet table; return the number of its rows and further ``figures`` (aggregates), taken by the same job.

    ``few_files`` lets adaptive execution put a small result together by its size: one more exchange of the result, while the plan
    above keeps its tasks. ``most_rows`` bounds the rows of a file.
    """
    taken = Observation()
    out = df.observe(taken, F.count(F.lit(1)).alias(ROWS), *[c.alias(name) for name, c in (figures or {}).items()])
    writer = (out.hint("rebalance") if few_files else out).write.mode("overwrite")
    if most_rows:
        writer = writer.option("maxRecordsPerFile", most_rows)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return dict(taken.get)


def write_outputs(
    outputs: Mapping[str, DataFrame], root: str, partition_by: Mapping[str, Sequence[str]] | None = None,
    figures: Mapping[str, Mapping[str, Column]] | None = None,
) -> dict[str, dict[str, int]]:
    """Write tables below ``root``; the figures of each, see ``write_table``."""
    return {
        name: write_table(df, f"{root.rstrip('/')}/{name}", (partition_by or {}).get(name, ()), figures=(figures or {}).get(name))
        for name, df in outputs.items()
    }


def with_audit(df: DataFrame, source_system: str, at: Column | None = None) -> DataFrame:
    """Load time and origin of each row."""
    return df.withColumns(
        {"upload_date": F.current_timestamp() if at is None else at, "source_system": F.lit(source_system)}
    )
