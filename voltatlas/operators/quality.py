"""Data-quality metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Metric rows (table_name, column_name, metric, value): NULLs per column, one pass for all columns."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return counts.unpivot([], columns, "column_name", "value").select(
        F.lit(table).alias("table_name"), "column_name", F.lit("null_count").alias("metric"), "value"
    )


def latest_metrics(history: DataFrame) -> DataFrame:
    """Recorded metrics, newest first."""
    return history.orderBy(F.col("measured_at").desc(), "table_name", "column_name")
