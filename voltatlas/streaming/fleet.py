"""Latest status per vehicle from a stream of telemetry.

Each micro-batch is reduced to one partial result per vehicle and hour. These
merge in any order, so no watermark is needed: a late event counts whenever it
comes, and a vehicle with a wrong clock harms no other. A status for the last
24 hours merges the whole hours after the cut with the events between the cut
and the next full hour, read from the raw table. That equals the batch model.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from voltatlas.functions import timestamp
from voltatlas.operators.fleet import LATEST, event_order, merged_partials, status_from_partials, status_partials
from voltatlas.sources import versions
from voltatlas.streaming.sink import FOLD_EVERY, BatchLog, batch_ids, run

STATE = ("last_seen", "latest", *LATEST, "speed_sum", "speed_count")
#: Hours a status may look back. The state keeps the days these hours lie in, and reads beyond them are refused.
KEEP_HOURS = 48


def in_utc(spark: SparkSession) -> None:
    """Times carry no zone; in another session zone the clock change would fold two hours into one."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z"):
        raise ValueError(f"the session must run in UTC, not in {zone}")


def bucket_partials(telemetry: DataFrame, bucket_seconds: int = 3600, tie_break: str | None = None) -> DataFrame:
    """Mergeable results per vehicle and bucket.

    The model's cut is exclusive (later than ``as_of - 24 h``), so a bucket
    holds its end and not its start: windows run over the time less one
    microsecond.
    """
    shifted = F.col("event_timestamp").cast("timestamp") - F.expr("interval 1 microsecond")
    return (
        telemetry.withColumn("shifted", shifted)
        .groupBy("vin", F.window("shifted", f"{bucket_seconds} seconds").alias("bucket"))
        .agg(*status_partials(event_order(tie_break)))
        .select("vin", F.col("bucket.end").cast("timestamp_ntz").alias("bucket_end"), *STATE)
        .withColumn("day", F.to_date("bucket_end"))
    )


def _merged(partials: DataFrame) -> DataFrame:
    """One row per vehicle and bucket, which merges on as its parts would have."""
    return partials.groupBy("vin", "bucket_end", "day").agg(
        *merged_partials(), F.max("latest").alias("latest")).hint("rebalance", "day")


def status_log(spark: SparkSession, state: str) -> BatchLog:
    return BatchLog(spark, state, _merged, ("day",))


def refresh_status(
    telemetry: DataFrame,
    state: str,
    checkpoint: str,
    bucket_seconds: int = 3600,
    tie_break: str | None = None,
    trigger: dict[str, object] | None = None,
    fold_every: int = FOLD_EVERY,
    keep_hours: int | None = None,
    after_batch: Callable[[SparkSession, int], None] | None = None,
) -> StreamingQuery:
    """Writes the partial results of each micro-batch; run it with a one-minute trigger in production.

    Results are kept by day, so a read touches the days of its window only. A
    replayed batch replaces its own folder. With ``keep_hours`` a fold leaves
    out days that ended longer ago, counted from the clock of the job.
    ``after_batch`` runs when a batch is written, for example to publish.
    """
    in_utc(telemetry.sparkSession)

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        log = status_log(spark, state)
        log.put(bucket_partials(batch, bucket_seconds, tie_break).hint("rebalance", "day"), batch_id)
        if keep_hours is None:
            log.fold_now_and_then(batch_id, fold_every)
        elif fold_every and batch_id and batch_id % fold_every == 0:
            expire(spark, state, datetime.now(timezone.utc).replace(tzinfo=None) - timedelta(hours=keep_hours), batch_id - 1)
        if after_batch:
            after_batch(spark, batch_id)

    return run(telemetry, each_batch, checkpoint, trigger=trigger)


def expire(spark: SparkSession, state: str, before: datetime, upto: int | None = None) -> None:
    """Folds the batches and leaves out days before a moment; from then on no status may look back beyond it."""
    log = status_log(spark, state)
    first = max(kept_from(spark, state) or date.min, before.date())
    versions.put(spark.range(1).select(F.lit(first.isoformat()).alias("first_day")), f"{state}/kept")
    last = upto if upto is not None else max(batch_ids(spark, log.batches), default=-1)
    log.fold_upto(last, keep=lambda rows: rows.where(F.col("day") >= F.lit(first)))


def kept_from(spark: SparkSession, state: str) -> date | None:
    """First day the state still holds; None if none has been left out."""
    if versions.current(spark, f"{state}/kept") is None:
        return None
    return date.fromisoformat(versions.read(spark, f"{state}/kept").first()[0])


def current_status(
    spark: SparkSession,
    state: str,
    as_of: datetime,
    raw: DataFrame | None = None,
    hours: int = 24,
    bucket_seconds: int = 3600,
    tie_break: str | None = None,
) -> DataFrame:
    """Status per vehicle over the events after ``as_of - hours``.

    ``raw`` is the telemetry table; it is needed unless the cut lies on a
    bucket's edge, and then read for that one bucket only.
    """
    in_utc(spark)
    first = kept_from(spark, state)
    _, edge = cut_and_edge(as_of, hours, bucket_seconds)
    if first and edge.date() < first:
        raise ValueError(f"the state holds days from {first} on; a status since {as_of - timedelta(hours=hours)} would miss events")
    rows = status_log(spark, state).read()
    if rows is None:
        raise LookupError(f"no batch has been written to {state}")
    return status_of(rows, as_of, raw, hours, bucket_seconds, tie_break)


def cut_and_edge(as_of: datetime, hours: int, bucket_seconds: int) -> tuple[datetime, datetime]:
    """When a status begins, and the end of the bucket that moment lies in (itself, if it is one)."""
    cut = as_of - timedelta(hours=hours)
    into_bucket = timedelta(microseconds=(cut - datetime(1970, 1, 1)) // timedelta(microseconds=1) % (bucket_seconds * 10**6))
    return cut, cut - into_bucket + timedelta(seconds=bucket_seconds) if into_bucket else cut


def status_of(
    rows: DataFrame, as_of: datetime, raw: DataFrame | None, hours: int, bucket_seconds: int, tie_break: str | None,
) -> DataFrame:
    """Status per vehicle from partial results by bucket, and from raw events for the part of a bucket after the cut."""
    cut, edge = cut_and_edge(as_of, hours, bucket_seconds)
    partials = rows.where((F.col("day") >= F.lit(edge.date())) & (F.col("bucket_end") > timestamp(edge))).select("vin", *STATE)
    if edge != cut:
        if raw is None:
            raise ValueError("as_of lies within a bucket: pass the raw telemetry for the part after the cut")
        moment = F.col("event_timestamp")
        part = raw.where((moment > timestamp(cut)) & (moment <= timestamp(edge)))
        if "event_date" in raw.columns:
            part = part.where(F.col("event_date").between(F.lit(cut.date()), F.lit(edge.date())))
        partials = partials.unionByName(part.groupBy("vin").agg(*status_partials(event_order(tie_break))))
    return status_from_partials(partials.groupBy("vin").agg(*merged_partials()))
