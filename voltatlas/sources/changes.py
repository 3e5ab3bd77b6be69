"""Changes of a table as signed rows: each row with how many times it comes (+) or goes (-)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

#: Column that says how many times a row comes, or goes if it is negative.
TIMES = "times"


def with_times(rows: DataFrame) -> DataFrame:
    """Rows that say nothing about it come once."""
    return rows if TIMES in rows.columns else rows.withColumn(TIMES, F.lit(1).cast("bigint"))


def difference(old: DataFrame | None, new: DataFrame | None) -> DataFrame:
    """What makes one version of a table the other, as signed rows; rows that both hold as often are not in it.

    Rows are compared by all their columns, raw records by their canonical text.
    Each task adds up what it reads before the one shuffle, so a row that comes on a
    third of all lines costs no more than any other.
    """
    sides = [with_times(rows).withColumn(TIMES, F.col(TIMES) * sign)
             for rows, sign in ((old, -1), (new, 1)) if rows is not None]
    both = reduce(DataFrame.unionByName, sides)
    records = {field.name for field in both.schema if isinstance(field.dataType, VariantType)}
    names = [name for name in both.columns if name != TIMES]
    comparable = both.select(*[F.to_json(name).alias(name) if name in records else name for name in names], TIMES)
    changed = comparable.groupBy(*names).agg(F.sum(TIMES).alias(TIMES)).where(F.col(TIMES) != 0)
    return changed.select(*[F.parse_json(name).alias(name) if name in records else name for name in names], TIMES)


def counted(rows: DataFrame) -> DataFrame:
    """Signed rows as a multiset: each distinct row once with its count, without those that have all gone."""
    return difference(None, rows)
