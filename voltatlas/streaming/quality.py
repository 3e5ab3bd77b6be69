"""Quality metrics taken on every change of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from voltatlas.operators.quality import latest_metrics, null_counts
from voltatlas.streaming.sink import batch_ids, put_batch, read_batches, run


def record_null_counts(
    new_rows: DataFrame, table: str, columns: list[str], history: str, checkpoint: str,
    trigger: dict[str, object] | None = None,
) -> StreamingQuery:
    """Appends the NULL counts of each micro-batch to the history; a replayed batch keeps the time it was first measured."""

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        first = F.current_timestamp()
        if batch_id in batch_ids(spark, history):
            first = F.lit(spark.read.parquet(f"{history}/batch_id={batch_id}").agg(F.min("measured_at")).first()[0])
        put_batch(null_counts(batch, table, columns).withColumn("measured_at", first), history, batch_id)

    return run(new_rows, each_batch, checkpoint, trigger=trigger)


def write_observed(
    new_rows: DataFrame, table: str, columns: list[str], target: str, history: str, checkpoint: str,
    trigger: dict[str, object] | None = None,
) -> StreamingQuery:
    """Writes each micro-batch to the target and records its NULL counts in the same pass.

    The counts are observed while the rows are written, so nothing is read
    twice. A replayed batch replaces its rows and its counts, and keeps the time it was
    first measured. Rows of a batch count in the history once both are written.
    """

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = Observation()
        nulls = [F.count_if(F.col(name).isNull()).alias(f"column_{n}") for n, name in enumerate(columns)]
        put_batch(batch.observe(seen, F.count(F.lit(1)).alias("rows"), *nulls), target, batch_id)
        found = seen.get
        first = F.current_timestamp()
        if batch_id in batch_ids(spark, history):
            first = F.lit(spark.read.parquet(f"{history}/batch_id={batch_id}").agg(F.min("measured_at")).first()[0])
        metrics = [(table, name, "null_count", found.get(f"column_{n}", 0)) for n, name in enumerate(columns)]
        metrics.append((table, None, "row_count", found.get("rows", 0)))
        put_batch(spark.createDataFrame(metrics, METRICS).coalesce(1).withColumn("measured_at", first), history, batch_id)

    return run(new_rows, each_batch, checkpoint, trigger=trigger)


METRICS = "table_name string, column_name string, metric string, value bigint"


def read_history(spark: SparkSession, history: str) -> DataFrame:
    """The metric of the whole table after each change, newest first: a column's NULLs up to and with a batch.

    The window runs over one row per batch and column.
    """
    upto = Window.partitionBy("table_name", "column_name", "metric").orderBy("batch_id")
    return latest_metrics(read_batches(spark, history).withColumn("value", F.sum("value").over(upto)))
