"""Names and small steps shared by the plant tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import joined_key, without_leading_zeros


PATH = ["enterprise", "site", "plant", "process_cell", "unit"]
UNIT = ["site", "unit"]
ORDER = "process_order_number"

# Fixed values.
NO_ORDER = "0000000"
DEFAULT_START = "2019-01-01"
UNKNOWN_MATERIAL = "UNKNOWN MATERIAL"
UNKNOWN_MATERIAL_RATE = "UNKNOWN_MATERIAL"
UNKNOWN = "Unknown"

ORDER_COLUMNS = [
    *PATH, "calendar_day", ORDER, "productid", "bottleneck", "logsheet_number",
]


def from_start_date(
    df: DataFrame, settings: DataFrame | None, day: str = "calendar_day", strictly_after: bool = False
) -> DataFrame:
    """Rows from each site's start date on (``site``, ``start_date``); sites without one use the default."""
    default = F.lit(DEFAULT_START).cast("date")
    if settings is None:
        start, out = default, df
    else:
        start, out = F.coalesce(F.col("__start"), default), df.join(
            settings.select("site", F.col("start_date").alias("__start")), "site", "left"
        )
    kept = out.filter(F.col(day) > start if strictly_after else F.col(day) >= start)
    return kept.select(*df.columns)


def with_row_key(df: DataFrame) -> DataFrame:
    """The nine-part key that links the result tables; null when any part is null."""
    return df.withColumn("key", joined_key(*PATH, "calendar_day", ORDER, "bottleneck", "productid"))


def with_order_key(df: DataFrame) -> DataFrame:
    return df.withColumn("po_key", joined_key(ORDER, "unit"))


def movement_orders(movements: DataFrame) -> DataFrame:
    """Raw movements with the order number stripped of its leading zeros."""
    return movements.withColumn(ORDER, without_leading_zeros(F.col("aufnr")))

