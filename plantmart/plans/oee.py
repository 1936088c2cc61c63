"""OEE table, order and step summaries, calendar keys, output measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import calendar_columns, stamp_from_parts
from ..functions.units import KG_PER_LB, kg_to_ton, lb_to_ton, to_kg, to_lb
from .common import ORDER, PATH, with_order_key, with_row_key

# The columns of each published table, in order.
PUBLISHED = {
    "availability": (
        "oee_category enterprise site plant process_cell unit event_time process_order_number target_prod_rate shift running_state "
        "reason reason_group_desc_2 duration_s explanation category reason_group_desc_1 calendar_day mpc runtime_loss available "
        "non_impactable impactable running_potential availability_loss unknown_loss external_loss maintenance_loss operations_loss "
        "productid material_grade material_color key target_duration bottleneck logsheet_number iscosted costed lost_capacity_ton "
        "non_costed step_number duration_hrs default_bottleneck step_description"
    ),
    "mseg": (
        "enterprise site plant process_cell process_order_number productid bwart matnr werks charg menge meins erfmg erfme aufnr "
        "pbamg kzbew kzvbr kzzug weunb po_key unit budat_mkpf cpudt_mkpf cputm_mkpf usnam_mkpf entry_ts xauto shkzg umcha "
        "bottleneck logsheet_number calendar_day lgort ummat umwrk umlgo mblnr zeile menge_lb menge_kg"
    ),
    "mseg_q1": (
        "enterprise site plant process_cell unit calendar_day process_order_number productid bottleneck logsheet_number mblnr zeile "
        "bwart xauto matnr werks lgort charg shkzg menge meins erfmg erfme aufnr pbamg ummat umwrk umlgo umcha kzbew kzvbr kzzug "
        "weunb budat_mkpf cpudt_mkpf cputm_mkpf usnam_mkpf first_booking_date menge_s in_q1_time quantity_prod_erp "
        "quantity_q1_good_erp quantity_q1_bad_erp po_key quantity_q1_erp"
    ),
    "oee": (
        "enterprise site plant process_cell unit calendar_day process_order_number productid material_grade material_color "
        "sum_runtime_loss sum_available sum_non_impactable sum_impactable sum_running_potential sum_availability_loss "
        "sum_unknown_loss sum_external_loss sum_maintenance_loss sum_operations_loss sum_capacity sum_quantity_prod "
        "sum_quantity_ftr sum_runtime_sec sum_downtime_sec sum_quantity_non_ftr sum_rate_gap key bottleneck sum_costed "
        "sum_non_costed sum_quantity_non_q1 sum_quantity_q1"
    ),
    "opn": (
        "enterprise site plant process_cell unit kop hourstartts eventtype process_order_number interval data_refresh_dt "
        "calendar_day productid material_grade material_color bottleneck logsheet_number key event_timestamp kop_activated "
        "alarm_duration alarm_text"
    ),
    "po": (
        "enterprise site plant process_cell unit process_order_number productid quantity_prod target_prod_rate actual_start_time "
        "actual_end_time material_grade material_color quantity_required quantity_prod_erp ftr_erp raw_materials_erp blocked_erp "
        "rework_erp scrap_erp obsolete_erp intra_material_erp free_for_use_erp target_rate target_availability target_quality "
        "target_setup_time default_values_used calendar_day bottleneck logsheet_number key batch_duration_min "
        "target_batch_duration po_key quantity_prod_ton ftr_pct"
    ),
    "rt_ftr": (
        "productid material_grade material_color enterprise site plant process_cell unit process_order_number capacity "
        "quantity_prod quantity_good target_prod_rate runtime_sec downtime_sec calendar_day quantity_ftr key bottleneck "
        "logsheet_number default_bottleneck ftr_pct start_ts"
    ),
    "ve": (
        "enterprise site plant process_cell unit process_order_number materialnumber ve_quantityproduced ve_dosedscanned ve_check "
        "ve_explanation ve_remark data_refresh_dt productid bottleneck logsheet_number key calendar_day bwart meins booked_in_sap "
        "unit/feedpoint material_description bom_quantity dcs_measurement"
    ),
}
# Columns that say where a row came from; a table that has them keeps them behind the published ones.
ORIGIN = ["source_site", "source_status"]

EVENT_KEYS = [*PATH, "calendar_day", ORDER, "productid", "material_grade", "material_color", "bottleneck"]
RATE_KEYS = [*PATH, "calendar_day", ORDER]
EVENT_SUMS = [
    "runtime_loss", "available", "non_impactable", "impactable", "running_potential", "availability_loss",
    "unknown_loss", "external_loss", "maintenance_loss", "operations_loss", "costed", "non_costed",
]
RATE_SUMS = ["capacity", "quantity_prod", "quantity_ftr", "runtime_sec", "downtime_sec"]


def oee_table(availability: DataFrame, rates: DataFrame, capacity_from_events: bool, within: Sequence[str] = ()) -> DataFrame:
    """Daily losses per order next to what was produced.

    Rates are grouped by exactly the join key, so an order made in two products does not double its losses.
    ``capacity_from_events`` (line plants) takes capacity as running potential less external delay; otherwise the
    capacity of the rate samples is kept (batch plants). ``within`` names columns that the events are dealt out by already: they are
    added up there first, and their few sums go to the rates at once.
    """
    sums = [*EVENT_SUMS, "delay_ext_loss"] if capacity_from_events else EVENT_SUMS
    status = [c for c in ("source_status",) if c in availability.columns]
    events = availability
    if within:
        events = events.groupBy(*status, *within, *EVENT_KEYS).agg(*[F.sum(c).alias(c) for c in sums]).repartition(*status, *RATE_KEYS)
    events = events.groupBy(*status, *EVENT_KEYS).agg(*[F.sum(c).alias(f"sum_{c}") for c in sums])
    produced = rates.groupBy(*status, *RATE_KEYS).agg(*[F.sum(c).alias(f"sum_{c}") for c in RATE_SUMS])
    joined = events.join(produced, [*status, *RATE_KEYS], "left").fillna(0, subset=[f"sum_{c}" for c in RATE_SUMS])
    gap = F.col("sum_runtime_loss")
    for c in ("quantity_prod", "operations_loss", "maintenance_loss", "external_loss", "unknown_loss"):
        gap = gap - F.col(f"sum_{c}")
    out = joined.withColumns(
        {
            "sum_quantity_non_ftr": F.col("sum_quantity_prod") - F.col("sum_quantity_ftr"),
            "sum_rate_gap": gap,
        }
    )
    if capacity_from_events:
        capacity = F.col("sum_running_potential") - F.col("sum_delay_ext_loss")
        out = out.withColumn("sum_capacity", capacity).drop("sum_delay_ext_loss")
    return out


def with_quality_split(oee: DataFrame, q1_summary: DataFrame) -> DataFrame:
    """Produced quantity split by the order's seven-day quality; all good when there is none."""
    joined = with_row_key(oee).join(q1_summary.select(ORDER, "q1"), ORDER, "left")
    q1, produced = F.col("q1"), F.col("sum_quantity_prod")
    return joined.withColumns(
        {
            "sum_quantity_non_q1": F.when(q1.isNull(), F.lit(0.0)).otherwise((1 - q1) * produced),
            "sum_quantity_q1": F.when(q1.isNull(), produced).otherwise(q1 * produced),
        }
    ).drop("q1")


def order_summary(oee: DataFrame) -> DataFrame:
    sums = oee.groupBy(ORDER, "unit").agg(
        F.sum("sum_available").alias("sum_available"), F.sum("sum_quantity_ftr").alias("sum_quantity_ftr")
    )
    return with_order_key(sums)


def step_summary(availability: DataFrame) -> DataFrame:
    """Target and actual time per production step, in minutes and days.

    ``costed`` and ``non_costed`` are the costed seconds in minutes. The usual table fills ``costed`` from the
    target time instead, which is not what its name says.
    """
    steps = availability.groupBy(ORDER, "unit", "productid", "step_number", "step_description").agg(
        F.avg("target_duration").alias("__target"),
        F.sum("duration_s").alias("__actual"),
        F.sum("costed").alias("costed_min"),
        F.sum("non_costed").alias("non_costed_min"),
    )
    timed = steps.withColumns(
        {
            "step_time_target_min": F.col("__target") / 60,
            "step_duration_min": F.col("__actual") / 60,
            "step_duration": F.col("__actual") / 24 / 3600,
            "step_time_target": F.col("__target") / 24 / 3600,
            "costed": F.col("costed_min") / 60,
            "non_costed": F.col("non_costed_min") / 60,
        }
    )
    return with_order_key(timed.drop("__target", "__actual"))


def key_calendar(oee: DataFrame, iso_year: bool = False) -> DataFrame:
    """Distinct result keys with calendar attributes."""
    keys = oee.select(*PATH, "calendar_day", ORDER, "bottleneck", "productid").distinct()
    return with_row_key(keys).withColumns(calendar_columns(F.col("calendar_day"), iso_year))


def published(name: str, df: DataFrame) -> DataFrame:
    """The published columns of a table in their order, then the row's origin; an absent published column is an error."""
    return df.select(*[F.col(f"`{c}`") for c in PUBLISHED[name].split()], *[c for c in ORIGIN if c in df.columns])


def availability_output(availability: DataFrame) -> DataFrame:
    out = with_row_key(availability).withColumns(
        {
            "duration_hrs": F.col("duration_s") / 3600,
            "lost_capacity_ton": lb_to_ton(F.col("runtime_loss")),
        }
    )
    return out.withColumns({c: F.col(c).cast("int") for c in ("available", "non_impactable", "impactable")})


def movement_output(movements: DataFrame) -> DataFrame:
    """Entry time and the quantity in both mass units."""
    return with_order_key(movements).withColumns(
        {
            "entry_ts": stamp_from_parts(F.col("cpudt_mkpf"), F.col("cputm_mkpf")),
            "menge_kg": to_kg(F.col("menge"), F.col("meins")).cast("float"),
            "menge_lb": to_lb(F.col("menge"), F.col("meins")).cast("float"),
            "menge": F.col("menge").cast("float"),
        }
    )


def quality_output(rows: DataFrame) -> DataFrame:
    out = with_order_key(rows).withColumn("quantity_q1_erp", F.col("quantity_q1_good_erp"))
    narrow = {c: "float" for c in ("menge", "menge_s", "erfmg", "quantity_prod_erp")} | {"pbamg": "int"}
    return out.withColumns({c: F.col(c).cast(t) for c, t in narrow.items() if c in out.columns})


def alarm_output(alarms: DataFrame) -> DataFrame:
    return with_row_key(alarms).withColumnRenamed("eventts", "event_timestamp")


def order_output(orders: DataFrame) -> DataFrame:
    seconds = F.unix_timestamp("actual_end_time") - F.unix_timestamp("actual_start_time")
    out = with_order_key(with_row_key(orders)).withColumns(
        {
            "batch_duration_min": seconds / 60,
            "quantity_prod_ton": kg_to_ton(F.col("quantity_prod")),
            "target_batch_duration": F.try_divide(F.col("quantity_required"), F.col("target_prod_rate")) * 3600,
        }
    )
    whole = [
        "quantity_prod", "ftr_erp", "raw_materials_erp", "blocked_erp", "rework_erp", "scrap_erp", "obsolete_erp",
        "intra_material_erp", "free_for_use_erp", "ftr_pct",
    ]
    return out.withColumns({c: F.col(c).cast("int") for c in whole if c in out.columns})


def oee_output(oee: DataFrame) -> DataFrame:
    whole = ["sum_impactable", "sum_runtime_sec", "sum_downtime_sec", "sum_quantity_non_ftr"]
    return oee.withColumns({c: F.col(c).cast("int") for c in whole})


def rate_output(rates: DataFrame) -> DataFrame:
    return with_row_key(rates).withColumns({c: F.col(c).cast("int") for c in ("quantity_good", "ftr_pct")})


def consumption_output(consumption: DataFrame) -> DataFrame:
    """Booked quantity in pounds and the published column names."""
    booked = F.when(F.col("meins") == "LB", F.col("ve_dosedscanned")).otherwise(F.col("ve_dosedscanned") / KG_PER_LB)
    return with_row_key(consumption.withColumn("booked_in_sap", booked.cast("float"))).withColumnsRenamed(
        {
            "ve_machine": "unit/feedpoint",
            "ve_materialdescription": "material_description",
            "ve_bom": "bom_quantity",
            "ve_dosedfeeders": "dcs_measurement",
        }
    )
