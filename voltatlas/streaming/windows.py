"""Fleet status from Spark's own windowed state: hours per vehicle behind a watermark, kept in RocksDB.

The state holds the hours that events may still fall into; older ones leave it,
so it stays as small as the fleet times the lateness that is allowed. Each batch
hands on the hours it has changed with their totals so far; the row with the most
events of an hour is the last one, whatever the order in which batches are read.
Events later than the watermark are dropped by Spark. How many is reported:
those that arrived, taken from the query's progress, less those that the hours hold.

Use ``streaming.fleet`` where no event may be dropped and state on disk is no concern.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from voltatlas.operators.fleet import event_order, status_partials
from voltatlas.streaming.fleet import STATE, in_utc, status_of
from voltatlas.streaming.sink import FOLD_EVERY, BatchLog, put_batch, read_batches, run

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ARRIVED = "arrived"


def _latest(rows: DataFrame) -> DataFrame:
    """Of each hour of a vehicle the row that has seen the most events."""
    names = (*STATE, "n_events")
    return rows.groupBy("vin", "bucket_end", "day").agg(F.max_by(F.struct(*names), "n_events").alias("row")).select(
        "vin", "bucket_end", "day", *[F.col(f"row.{name}").alias(name) for name in names]).hint("rebalance", "day")


def window_log(spark: SparkSession, state: str) -> BatchLog:
    return BatchLog(spark, f"{state}/windows", _latest, ("day",))


def refresh_windows(
    telemetry: DataFrame, state: str, checkpoint: str, lateness: str = "24 hours", bucket_seconds: int = 3600,
    tie_break: str | None = None, trigger: dict[str, object] | None = None, fold_every: int = FOLD_EVERY,
) -> StreamingQuery:
    """Keeps the hours per vehicle; a window holds its end and not its start, as the model's cut is exclusive."""
    spark = telemetry.sparkSession
    in_utc(spark)
    shifted = F.col("event_timestamp").cast("timestamp") - F.expr("interval 1 microsecond")
    hours = (
        telemetry.observe(ARRIVED, F.count(F.lit(1)).alias("n_events"))
        .withColumn("shifted", shifted)
        .withWatermark("shifted", lateness)
        .groupBy(F.window("shifted", f"{bucket_seconds} seconds").alias("bucket"), "vin")
        .agg(*status_partials(event_order(tie_break)), F.count(F.lit(1)).alias("n_events"))
        .select("vin", F.col("bucket.end").cast("timestamp_ntz").alias("bucket_end"), *STATE, "n_events")
        .withColumn("day", F.to_date("bucket_end"))
    )

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        log = window_log(batch.sparkSession, state)
        log.put(batch.hint("rebalance", "day"), batch_id)
        log.fold_now_and_then(batch_id, fold_every)

    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, ROCKSDB)  # a query takes it from the session when it starts
    try:
        return run(hours, each_batch, checkpoint, mode="update", trigger=trigger)
    finally:
        spark.conf.set(key, before)


PROGRESS = "n_arrived bigint, watermark string, state_rows bigint"


def record_progress(spark: SparkSession, query: StreamingQuery, state: str) -> None:
    """Keeps what the query says about its batches, each once: events arrived, watermark, rows in the state.

    Call it when a run is over, and from time to time while one goes on: Spark remembers the last hundred batches.
    """
    for progress in query.recentProgress:
        seen = (progress["observedMetrics"] or {}).get(ARRIVED)
        if seen is None:  # a batch without new events, which only lets old state go
            continue
        row = (seen["n_events"], (progress["eventTime"] or {}).get("watermark"),
               sum(operator["numRowsTotal"] for operator in progress["stateOperators"]))
        put_batch(spark.createDataFrame([row], PROGRESS), f"{state}/progress", progress["batchId"])


def late_events(spark: SparkSession, state: str) -> int:
    """Events that came after the watermark had passed their hour and are in no status."""
    arrived = read_batches(spark, f"{state}/progress").agg(F.sum("n_arrived")).first()[0]
    log = window_log(spark, state)
    return arrived - (log.fold(log.read()).agg(F.sum("n_events")).first()[0] or 0)


def windowed_status(
    spark: SparkSession, state: str, as_of: datetime, raw: DataFrame | None = None, hours: int = 24,
    bucket_seconds: int = 3600, tie_break: str | None = None,
) -> DataFrame:
    """Status per vehicle from the windows, as ``fleet.current_status`` gives it from its own state."""
    in_utc(spark)
    log = window_log(spark, state)
    rows = log.read()
    if rows is None:
        raise LookupError(f"no batch has been written to {state}")
    return status_of(log.fold(rows), as_of, raw, hours, bucket_seconds, tie_break)
