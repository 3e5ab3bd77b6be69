"""Licence plates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plate pattern, first year of its bucket range, number of years in the range.
PLATE_YEARS = (
    ("^[0-9]{2}[A-Z]{3}[0-9]$", 2020, 6),
    ("^[0-9][A-Z]{3}[0-9]{2}$", 2015, 5),
    ("^[A-Z]{2}[0-9]{3}[A-Z]$", 2010, 5),
)
OTHER_PLATE_YEARS = (2015, 11)


def plate_hash(plate: Column) -> Column:
    """Non-negative number from the plate, the same on every engine (first 32 bits of MD5)."""
    return F.conv(F.substring(F.md5(plate), 1, 8), 16, 10).cast("bigint")


def bucketed_year(plate: Column) -> Column:
    """A pseudo registration year: the plate class gives the range, a hash the year in it.

    It is a stable spread for trend models, not the true year of registration.
    """
    number = plate_hash(plate)

    def pick(first: int, span: int) -> Column:
        return (F.lit(first) + number % span).cast("int")

    known = reduce(
        lambda case, rule: case.when(plate.rlike(rule[0]), pick(rule[1], rule[2])),
        PLATE_YEARS[1:],
        F.when(plate.rlike(PLATE_YEARS[0][0]), pick(*PLATE_YEARS[0][1:])),
    )
    return known.otherwise(pick(*OTHER_PLATE_YEARS))
