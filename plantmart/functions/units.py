"""Mass units and unit factors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
KG_PER_LB = 0.45359237
TON_PER_LB = 0.00045359237
TON_PER_KG = 0.001


def to_kg(quantity: Column, unit: Column) -> Column:
    """Kilograms; anything not in LB is taken as kilograms."""
    return F.when(unit == "LB", quantity * KG_PER_LB).otherwise(quantity)


def to_lb(quantity: Column, unit: Column) -> Column:
    """Pounds; anything not in LB is taken as kilograms."""
    return F.when(unit == "LB", quantity).otherwise(quantity / KG_PER_LB)


def lb_to_ton(quantity: Column) -> Column:
    return quantity * TON_PER_LB


def kg_to_ton(quantity: Column) -> Column:
    return quantity * TON_PER_KG


def unit_factor(numerator: Column, denominator: Column, exponent: Column) -> Column:
    """numerator / denominator * 10 ^ exponent."""
    return F.try_divide(numerator, denominator) * F.pow(F.lit(10.0), exponent)


def signed_rate(rate: Column) -> Column:
    """A negative rate is quoted the other way round: |1 / rate|."""
    value = rate.cast("double")
    return F.when(value >= 0, value).otherwise(F.abs(F.try_divide(F.lit(1.0), value)))
