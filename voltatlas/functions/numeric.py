"""Rounding and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, digits: int) -> Column:
    """Decimal rounding, half away from zero, returned as double.

    Going through seven decimals first absorbs the noise of a floating sum, so
    the order in which partial sums arrive cannot flip the last digit.
    """
    return F.round(value.cast("decimal(28,7)"), digits).cast("double")


def whole_number(text: Column) -> Column:
    """Text as an int, decimals rounded half away from zero; NULL where it is no number or too large."""
    return F.round(text.try_cast("decimal(28,7)"), 0).try_cast("int")


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, NULL when whole is 0."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))


def percentage(part: Column, whole: Column, digits: int) -> Column:
    """100 * part / whole, rounded; NULL when whole is 0."""
    return round_half_up(ratio(F.lit(100.0) * part.cast("double"), whole), digits)
