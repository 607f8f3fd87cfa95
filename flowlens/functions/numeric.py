"""Numeric cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: clipping range of numeric features.
CLIP = 1e6
INFINITY = float("inf")


def to_number(value: Column) -> Column:
    """Double value of a column; text that is no number becomes null."""
    return value.try_cast("double")


def missing_if_not_finite(value: Column) -> Column:
    """NaN and both infinities become null."""
    number = value.cast("double")
    return F.when((F.abs(number) < INFINITY) & ~F.isnan(number), number)


def sanitise(value: Column, bound: float = CLIP) -> Column:
    """NaN and null become 0, everything else is clipped to [-bound, bound]."""
    number = F.coalesce(F.nanvl(value.cast("double"), F.lit(0.0)), F.lit(0.0))
    return clamp(number, -bound, bound)


def clamp(value: Column, low: float, high: float) -> Column:
    """Null stays null, unlike a bare least/greatest."""
    return F.when(value.isNotNull(), F.least(F.lit(high), F.greatest(F.lit(low), value)))


def hundred_percent(value: Column, places: int = 2) -> Column:
    return F.round(value * 100, places)


def number_or(value: Column, default: float) -> Column:
    """Parsed number; zero, non-numeric, NaN and missing give the default."""
    parsed = to_number(value)
    return F.when((parsed != 0) & (F.abs(parsed) < INFINITY), parsed).otherwise(F.lit(default))
