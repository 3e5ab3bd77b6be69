"""Activity, usage, budget and freshness reports over log tables."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltatlas.functions import before, percentage, ratio, round_half_up

# Budget thresholds in percent.
BUDGET_THRESHOLDS = (50, 75, 90, 100, 110)


def recent_activity(query_log: DataFrame, as_of: datetime, database: str, hours: int = 1, limit: int = 10) -> DataFrame:
    """Newest queries on one database within the last hours, run time in seconds."""
    return (
        query_log.where((F.col("database_name") == database) & (F.col("start_time") > before(as_of, hours=hours)))
        .orderBy(F.col("start_time").desc(), F.col("query_id").desc())
        .limit(limit)
        .select(
            "query_id", "user_name", "role_name", "warehouse_name", "query_type", "execution_status",
            (F.col("total_elapsed_time") / 1000).alias("seconds"), "query_text",
        )
    )


def usage_by_resource(usage: DataFrame, as_of: datetime, days: int = 7) -> DataFrame:
    """Credits, queries and credits per query of each resource over the last days."""
    return (
        usage.where(F.col("start_time") > before(as_of, days=days))
        .groupBy("warehouse_name")
        .agg(
            F.sum("credits_used").cast("double").alias("total_credits"),
            F.count("*").alias("query_count"),
            round_half_up(ratio(F.sum("credits_used"), F.count("*")), 4).alias("credits_per_query"),
        )
    )


def budget_use(usage: DataFrame, quota: float) -> DataFrame:
    """Used part of the monthly quota."""
    used = F.sum("credits_used")
    return usage.groupBy(F.trunc("start_time", "MM").alias("month")).agg(
        used.cast("double").alias("credits_used"),
        F.lit(float(quota)).alias("credit_quota"),
        (F.lit(float(quota)) - used.cast("double")).alias("credits_remaining"),
        percentage(used, F.lit(quota), 2).alias("pct_used"),
    )


def budget_crossings(
    usage: DataFrame, quota: float, thresholds: tuple[int, ...] = BUDGET_THRESHOLDS
) -> DataFrame:
    """First moment in each month at which each threshold of the quota is reached.

    A running sum over all rows of a month would put the month into one task.
    Credits never fall, so it is enough to sum by second, find the second in
    which a threshold is passed, and add up single moments within that second
    only. A month has at most 2.7 million seconds and a second at most a
    million moments, whatever the number of rows.
    """
    moments = usage.select(
        F.trunc("start_time", "MM").alias("month"),
        F.date_trunc("second", "start_time").cast("timestamp_ntz").alias("second"),
        "start_time",
        "credits_used",
    )
    limits = F.array(*[
        F.struct(
            F.lit(pct).alias("threshold_pct"),
            F.lit(Decimal(str(quota)) * pct / 100).cast("decimal(28,4)").alias("credit_limit"),
        )
        for pct in thresholds
    ])

    def is_passed(limit: Column) -> Column:
        return (F.col("base") < limit["credit_limit"]) & (F.col("upto") >= limit["credit_limit"])

    by_second = Window.partitionBy("month").orderBy("second").rowsBetween(Window.unboundedPreceding, 0)
    running = (
        moments.groupBy("month", "second")
        .agg(F.sum("credits_used").alias("used"))
        .withColumn("upto", F.sum("used").over(by_second))
        .withColumn("base", F.col("upto") - F.col("used"))
    )
    # At most one row per month and threshold comes out of this, so broadcasting it is safe.
    crossed = (
        running.withColumn("limit", F.explode(F.filter(limits, is_passed)))
        .select("month", "second", "limit.*", "base")
    )
    moment = Window.partitionBy("month", "threshold_pct").orderBy("start_time").rowsBetween(
        Window.unboundedPreceding, 0)
    return (
        moments.join(F.broadcast(crossed), ["month", "second"])
        .groupBy("month", "threshold_pct", "credit_limit", "base", "start_time")
        .agg(F.sum("credits_used").alias("used"))
        .withColumn("upto", F.col("base") + F.sum("used").over(moment))
        .where(F.col("upto") >= F.col("credit_limit"))
        .groupBy("month", "threshold_pct")
        .agg(F.min("start_time").alias("first_crossed"))
    )


def freshness(refresh_log: DataFrame, targets: DataFrame, as_of: datetime) -> DataFrame:
    """Last refresh of each model against its target lag in seconds."""
    last = refresh_log.groupBy("model").agg(F.max("refreshed_at").alias("last_refresh"))
    lag = F.timestamp_diff("SECOND", F.col("last_refresh"), before(as_of))
    return targets.join(last, "model", "left").select(
        "model", "target_lag_seconds", "last_refresh",
        lag.alias("lag_seconds"),
        F.coalesce(lag > F.col("target_lag_seconds"), F.lit(True)).alias("is_late"),
    )
