"""Dates, production days, shifts and calendar keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

STAMP_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm:ss.SSS")
LINE_DAY_STARTS_AT = 6
BATCH_DAY_STARTS_AT = 7

# Month short names and their numbers.
MONTH_NUMBERS = {
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "may": 5, "jun": 6,
    "jul": 7, "aug": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12,
}


def parse_stamp(column: Column, formats: Sequence[str] = STAMP_FORMATS) -> Column:
    """Timestamp by the first format that fits, whole seconds; null when none fits."""
    return F.date_trunc("second", F.coalesce(*[F.try_to_timestamp(column, F.lit(f)) for f in formats]))


def production_day(ts: Column, starts_at: int) -> Column:
    """Calendar day of a timestamp when the day begins at ``starts_at`` o'clock."""
    return F.to_date(ts - F.make_dt_interval(hours=F.lit(starts_at)))


def shift_code(ts: Column) -> Column:
    """Early 6-14 (OD), late 14-22 (MD), night 22-6 (ND)."""
    hour = F.hour(ts)
    return F.when((hour >= 6) & (hour < 14), "OD").when((hour >= 14) & (hour < 22), "MD").otherwise("ND")


def cycle_position(anchor: str, day: Column, length: int, signed: bool = True) -> Column:
    """Days from ``day`` to ``anchor`` modulo the cycle length.

    The signed form is negative for days after the anchor; shift tables are keyed that way.
    """
    days = F.date_diff(F.to_date(F.lit(anchor)), day)
    return days % length if signed else F.pmod(days, F.lit(length))


def calendar_columns(day: Column, iso_year: bool = False) -> dict[str, Column]:
    """Calendar attributes of a day. The week label pairs the calendar year with the ISO week unless ``iso_year``."""
    year = F.extract(F.lit("YEAROFWEEK"), day) if iso_year else F.year(day)
    return {
        "calendar_week": F.concat(year.cast("string"), F.lit(" W"), F.weekofyear(day).cast("string")),
        "calendar_month": F.date_format(day, "MMM yyyy"),
        "calendar_year": F.year(day),
        "indexMonth": F.year(day) * 100 + F.month(day),
        "weeknum": F.weekofyear(day),
    }


def from_inverted(column: Column) -> Column:
    """Date stored as 99999999 - yyyymmdd."""
    return F.to_date((F.lit(99999999) - column.cast("int")).cast("string"), "yyyyMMdd")


def month_number(name: Column) -> Column:
    """1..12 for a short month name in any case, 0 for anything else."""
    table = F.create_map(*[F.lit(x) for pair in MONTH_NUMBERS.items() for x in pair])
    return F.coalesce(F.try_element_at(table, F.lower(name)), F.lit(0))


def period_start(year: Column, month: Column) -> Column:
    """First day of a fiscal year and period; null for a period that is no month."""
    return F.try_to_date(F.concat_ws("-", year.cast("string"), month.cast("int").cast("string"), F.lit("1")), "y-M-d")


def trailing_year_start(as_of: Column) -> Column:
    """First day of the month one year before ``as_of``."""
    return F.add_months(F.trunc(as_of, "MM"), -12)


def months_since(as_of: Column, day: Column) -> Column:
    """Months between, rounded to whole months."""
    return F.round(F.months_between(as_of, day))


def validity_state(start: Column, end: Column, as_of: Column) -> Column:
    """Future, Past or Current."""
    return (
        F.when((start > as_of) & (end > as_of), "Future")
        .when((start < as_of) & (end < as_of), "Past")
        .otherwise("Current")
    )


def stamp_from_parts(day: Column, time_text: Column) -> Column:
    """Timestamp from a date and a HH:mm:ss text."""
    return F.try_to_timestamp(F.concat_ws(" ", day.cast("string"), time_text), F.lit("yyyy-MM-dd HH:mm:ss"))


def plus_minutes(ts: Column, minutes: Column) -> Column:
    return F.timestamp_seconds(F.unix_timestamp(ts) + minutes * 60)
