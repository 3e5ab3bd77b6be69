"""Fleet telemetry: latest status per vehicle and summaries by brand."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltatlas.functions import before, round_half_up

LOW_BATTERY_BELOW = 20
LATEST = ("battery_pct", "latitude", "longitude", "charging")


def event_order(tie_break: str | None) -> Column:
    """What orders a vehicle's events: the event time, then ``tie_break`` where the table has such a whole-number column.

    Without it, two events of one vehicle at the same microsecond leave open
    which one is shown. Both form one number of fixed width, so that Spark can
    update it in place and aggregate by hash. A NULL tie-break comes first. The
    session must run in UTC, as times carry no zone.
    """
    if tie_break is None:
        return F.col("event_timestamp")
    micros = F.unix_micros(F.col("event_timestamp").cast("timestamp")).cast("decimal(18,0)")
    second = F.coalesce(F.col(tie_break).cast("long"), F.expr("bigint('-9223372036854775808')")).cast("decimal(20,0)")
    # Twice 10^19 exceeds the distance between any two long values.
    return (micros * F.lit(str(2 * 10 ** 19)).cast("decimal(20,0)") + second).cast("decimal(38,0)")


def status_partials(order: Column) -> list[Column]:
    """Mergeable state of a group of events: the latest values and the sum and count of speeds."""
    return [
        F.max("event_timestamp").alias("last_seen"),
        F.max(order).alias("latest"),
        *[F.max_by(name, order).alias(name) for name in LATEST],
        F.sum("speed_kmh").alias("speed_sum"),
        F.count("speed_kmh").alias("speed_count"),
    ]


def merged_partials() -> list[Column]:
    return [
        F.max("last_seen").alias("last_seen"),
        *[F.max_by(name, F.col("latest")).alias(name) for name in LATEST],
        F.sum("speed_sum").alias("speed_sum"),
        F.sum("speed_count").alias("speed_count"),
    ]


def status_from_partials(per_vehicle: DataFrame) -> DataFrame:
    """Status row per vehicle; a low battery wins over charging."""
    battery = F.col("battery_pct")
    return per_vehicle.select(
        "vin",
        F.split_part("vin", F.lit("-"), F.lit(1)).alias("brand"),
        "last_seen",
        battery.alias("current_battery"),
        F.col("latitude").alias("current_lat"),
        F.col("longitude").alias("current_lon"),
        round_half_up(F.try_divide(F.col("speed_sum").cast("double"), "speed_count"), 1).alias("avg_speed_kmh"),
        F.when(battery < LOW_BATTERY_BELOW, "LOW_BATTERY")
        .when(F.col("charging"), "CHARGING")
        .otherwise("ACTIVE")
        .alias("status"),
    )


def vehicle_status(
    telemetry: DataFrame, as_of: datetime, hours: int = 24, tie_break: str | None = None
) -> DataFrame:
    """Latest status of each vehicle over the events after ``as_of - hours``.

    Each task reduces its events to one row per vehicle before the shuffle,
    so a vehicle with a third of all events costs no more than any other. Where
    the table is kept by day, only the days of the window are read.
    """
    recent = telemetry.where(F.col("event_timestamp") > before(as_of, hours=hours))
    if "event_date" in telemetry.columns:
        recent = recent.where(F.col("event_date") >= F.lit((as_of - timedelta(hours=hours)).date()))
    return status_from_partials(recent.groupBy("vin").agg(*status_partials(event_order(tie_break))))


def _status_count(status: str) -> Column:
    return F.count_if(F.col("status") == status)


def fleet_alerts(status: DataFrame) -> DataFrame:
    """Fleet by brand with all three states, battery as whole percent."""
    return status.groupBy("brand").agg(
        F.count("*").alias("total_vehicles"),
        _status_count("LOW_BATTERY").alias("low_battery_count"),
        _status_count("CHARGING").alias("charging_count"),
        _status_count("ACTIVE").alias("active_count"),
        round_half_up(F.avg("current_battery"), 0).alias("avg_battery_pct"),
        round_half_up(F.avg("avg_speed_kmh"), 1).alias("avg_fleet_speed"),
    )


def fleet_summary(status: DataFrame) -> DataFrame:
    """Shorter variant: no active count, averages to one decimal."""
    return status.groupBy("brand").agg(
        F.count("*").alias("total_vehicles"),
        _status_count("LOW_BATTERY").alias("low_battery_count"),
        _status_count("CHARGING").alias("charging_count"),
        round_half_up(F.avg("current_battery"), 1).alias("avg_battery"),
        round_half_up(F.avg("avg_speed_kmh"), 1).alias("avg_speed"),
    )
