"""Line plants: cleaned events, order attribution, losses, rates, alarms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import LINE_DAY_STARTS_AT, cycle_position, production_day
from ..functions.missing import text_or_null
from ..functions.text import first_token
from ..operators import ordered
from ..operators.attribution import barrier_fill
from ..operators.dedup import latest_by, latest_release
from ..operators.joins import left_join_with_defaults
from .common import (
    NO_ORDER,
    ORDER,
    PATH,
    UNIT,
    UNKNOWN,
    UNKNOWN_MATERIAL,
    UNKNOWN_MATERIAL_RATE,
    from_start_date,
)

# States, categories and the shift calendar.
IDLE = "IDLE"
CHANGE_OVER = "CHANGE-OVER"
DELAY = "DELAY"
PRODUCING = ("RUNNING", "RUNNING SLOW", "RUNNING FAST", DELAY)
NON_IMPACTABLE = "Non_impactable"
COSTED = "Costed"
SHIFT_ANCHOR = "2019-10-01"
SHIFT_CYCLE_DAYS = 14


def clean_availability(
    events: DataFrame, ties: Sequence[str] = (), chunk_seconds: int = ordered.CHUNK_SECONDS
) -> DataFrame:
    """Newest release per equipment and production day, one row per event time, with durations.

    The duration is the time to the unit's next event of this load; the unit's last event has none.
    """
    days = events.withColumns(
        {
            "calendar_day": production_day(F.col("event_time"), LINE_DAY_STARTS_AT),
            "explanation": first_token(F.col("explanation"), ["/"]),
        }
    )
    newest = latest_release(days, [*PATH, "calendar_day"], "releasets", ["recid", *ties])
    single = latest_by(newest, [*PATH, "event_time"], ["recid", *ties])
    return with_durations(single, ["event_time", "recid", *ties], chunk_seconds)


def with_durations(
    events: DataFrame, order: Sequence[str] = ("event_time",), chunk_seconds: int = ordered.CHUNK_SECONDS
) -> DataFrame:
    """``duration_s``: whole seconds until the unit's next event."""
    following = ordered.next_value(
        events, "event_time", UNIT, order, ordered.time_chunk("event_time", chunk_seconds), "__next"
    )
    seconds = F.unix_timestamp("__next") - F.unix_timestamp("event_time")
    return following.withColumn("duration_s", seconds.cast("int")).drop("__next")


def attribute_orders(
    events: DataFrame, order: Sequence[str] = ("event_time",), chunk_seconds: int = ordered.CHUNK_SECONDS
) -> DataFrame:
    """Fill order number and target rate; idle time has none, change-overs belong to the next order."""
    blanks = events.withColumn(ORDER, text_or_null(F.col(ORDER), ("",)))
    return barrier_fill(
        blanks,
        [ORDER, "target_prod_rate"],
        stop=F.col("running_state") == IDLE,
        changeover=F.col("running_state") == CHANGE_OVER,
        by=UNIT,
        order=order,
        chunk=ordered.time_chunk("event_time", chunk_seconds),
    )


def loss_columns(delay_label: str = DELAY) -> list[dict[str, Column]]:
    """The duration and loss measures, in two steps (the second uses the first).

    ``delay_ext_loss`` compares the state with ``delay_label``. The usual result tables carry 0 there because the
    label was written ``'Delay'`` while states are upper case; pass that label to get those figures.
    """
    state, duration = F.col("running_state"), F.col("duration_s")
    delayed = state == DELAY
    non_impactable = F.col("category") == NON_IMPACTABLE
    costed = F.col("iscosted") == COSTED
    zero = F.lit(0.0)
    first = {
        "runtime_loss": F.when(F.col(ORDER).isNull(), duration * F.col("mpc") / 3600)
        .when(F.col("target_prod_rate") == 0, zero)
        .otherwise(duration / F.nullif(F.col("target_prod_rate"), zero) / 3600),
        "available": F.when(state.isin(*PRODUCING), duration).otherwise(0),
        "non_impactable": F.when(~delayed & non_impactable, duration).otherwise(0),
        "delay_ext": F.when(delayed & non_impactable, duration).otherwise(0),
        "costed": F.when(delayed & costed, duration).otherwise(0),
        "non_costed": F.when(~delayed | costed, 0).otherwise(duration),
    }
    loss, category = F.col("runtime_loss"), F.col("oee_category")
    running = F.col("available") > 0
    second = {
        "impactable": duration - F.col("available") - F.col("non_impactable"),
        "running_potential": F.when(running, loss).otherwise(zero),
        "availability_loss": F.when(running, zero).otherwise(loss),
        "unknown_loss": F.when(category == "Unknown", loss).otherwise(zero),
        "external_loss": F.when((category == "External") & ~delayed, loss).otherwise(zero),
        "delay_ext_loss": F.when((category == "External") & (state == delay_label), loss).otherwise(zero),
        "maintenance_loss": F.when(category == "Maintenance", loss.try_cast("int")).otherwise(0),
        "operations_loss": F.when(category == "Operations", loss).otherwise(zero),
    }
    return [first, second]


def classify_losses(events: DataFrame, delay_label: str = DELAY) -> DataFrame:
    for step in loss_columns(delay_label):
        events = events.withColumns(step)
    return events


def with_order_details(events: DataFrame, orders: DataFrame, settings: DataFrame | None) -> DataFrame:
    """Product and grade of the attributed order; unknown orders get defaults and the placeholder number."""
    known = from_start_date(orders, settings, strictly_after=True).filter(F.col(ORDER) != NO_ORDER)
    details = known.select(
        *UNIT, ORDER, "productid", "material_grade", "material_color", "bottleneck", "logsheet_number"
    )
    return left_join_with_defaults(
        events,
        details,
        [*UNIT, ORDER],
        {
            "productid": UNKNOWN_MATERIAL,
            "material_grade": UNKNOWN,
            "material_color": UNKNOWN,
            "bottleneck": F.col("default_bottleneck"),
            ORDER: NO_ORDER,
        },
    )


def with_shift(events: DataFrame, pattern: DataFrame) -> DataFrame:
    """Replace the shift slot by the crew letter of the 14-day cycle; slots outside the pattern drop out.

    ``pattern``: shift, shift_modulo, shift_letter, per site when it has a site column.
    """
    positioned = events.withColumn(
        "shift_modulo", cycle_position(SHIFT_ANCHOR, F.col("calendar_day"), SHIFT_CYCLE_DAYS)
    )
    on = [c for c in ("site", "shift", "shift_modulo") if c in pattern.columns]
    crew = pattern.select(*on, "shift_letter")
    return positioned.join(crew, on, "inner").drop("shift").withColumnRenamed("shift_letter", "shift")


def availability_table(
    history: DataFrame,
    orders: DataFrame,
    units: DataFrame,
    categories: DataFrame,
    shifts: DataFrame,
    settings: DataFrame | None = None,
) -> DataFrame:
    """Event table with attributed orders, losses, order details and crew."""
    rows = (
        from_start_date(history, settings)
        .join(units, PATH, "inner")
        .join(
            categories,
            ["enterprise", "site", "reason", "reason_group_desc_1", "reason_group_desc_2"],
            "inner",
        )
    )
    return with_shift(with_order_details(classify_losses(attribute_orders(rows)), orders, settings), shifts)


def rate_table(
    rates: DataFrame, orders: DataFrame, units: DataFrame, settings: DataFrame | None = None
) -> DataFrame:
    """Rate samples with first-time-right quantity; samples of unknown orders count as right."""
    known = from_start_date(orders, settings).filter(F.col(ORDER) != NO_ORDER)
    details = known.select(
        *PATH, ORDER, "productid", "material_grade", "material_color", "ftr_pct", "bottleneck", "logsheet_number"
    )
    rows = from_start_date(rates, settings).join(units.drop("mpc"), PATH, "inner")
    joined = left_join_with_defaults(
        rows.withColumn("quantity_ftr", F.col("quantity_prod")),
        details.withColumn("__share", F.col("ftr_pct") / 100),
        [*PATH, ORDER],
        {
            "productid": UNKNOWN_MATERIAL_RATE,
            "material_grade": UNKNOWN,
            "material_color": UNKNOWN,
            "bottleneck": F.col("default_bottleneck"),
            "ftr_pct": 100.0,
            "__share": 1.0,
            ORDER: NO_ORDER,
        },
    )
    return joined.withColumn("quantity_ftr", F.col("__share") * F.col("quantity_prod")).drop("__share")


def newest_rates(rates: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """Newest release per sample, with its production day."""
    days = rates.withColumn("calendar_day", production_day(F.col("start_ts"), LINE_DAY_STARTS_AT))
    return latest_by(days, [*PATH, ORDER, "start_ts"], ["releasets", *ties])


def newest_orders(
    orders: DataFrame, settings: DataFrame | None = None, ties: Sequence[str] = ()
) -> DataFrame:
    """Newest release per order from the start date on."""
    days = orders.withColumn("calendar_day", production_day(F.col("actual_end_time"), LINE_DAY_STARTS_AT))
    return latest_by(from_start_date(days, settings), [*PATH, ORDER], ["releasets", *ties])


def newest_readings(readings: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """Newest variable-efficiency reading per order and machine."""
    return latest_by(readings, [*PATH, ORDER, "ve_machine"], ["releasets", *ties])


def newest_alarms(alarms: DataFrame, ties: Sequence[str] = ()) -> DataFrame:
    """Newest release per parameter alarm; events without a type are noise."""
    days = alarms.withColumn("calendar_day", production_day(F.col("eventts"), LINE_DAY_STARTS_AT))
    return latest_by(days.filter(F.col("eventtype") != ""), [*PATH, "kop", "eventts"], ["releasets", *ties])


def alarm_table(alarms: DataFrame, orders: DataFrame, settings: DataFrame | None = None) -> DataFrame:
    """Alarms of known orders with their product."""
    details = orders.select(
        *UNIT, ORDER, "productid", "material_grade", "material_color", "bottleneck", "logsheet_number"
    )
    return from_start_date(alarms, settings).join(details, [*UNIT, ORDER], "inner")
