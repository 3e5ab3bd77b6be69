"""Curated layer: typed, classified and first-level aggregated tables.

Models that are sums or counts come in three parts, ``*_rows`` (what each raw row
brings), ``*_sums`` (mergeable partials per key) and ``*_from_sums`` (ratios on
top). A full run composes them; the incremental refresh adds rows up with their sign, and merges across batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltatlas.functions import area_of, bucketed_year, fuel_category, is_ev_or_hybrid, percentage, whole_number

PASSENGER_CAR = "Personenauto"


def added_up(rows: DataFrame, *keys: str) -> DataFrame:
    """Sums of all other columns per key."""
    return rows.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in rows.columns if name not in keys])


def region_rows(vehicles_by_postcode: DataFrame, *carry: str) -> DataFrame:
    """What each passenger-car row brings to its two-digit area: electric, petrol, diesel, plug-in, all; ``carry`` stays."""

    def vehicles_where(condition: Column) -> Column:
        return F.when(condition, F.col("aantal")).otherwise(0)

    return vehicles_by_postcode.where(F.col("voertuigsoort") == PASSENGER_CAR).select(
        area_of(F.col("postcode")).alias("postal_area"),
        vehicles_where(F.col("brandstof") == "E").alias("electric_vehicles"),
        vehicles_where(F.col("brandstof") == "B").alias("petrol_vehicles"),
        vehicles_where(F.col("brandstof") == "D").alias("diesel_vehicles"),
        vehicles_where(F.col("extern_oplaadbaar") == "J").alias("plugin_hybrids"),
        F.col("aantal").alias("total_vehicles"),
        *carry,
    )


def region_sums(vehicles_by_postcode: DataFrame) -> DataFrame:
    return added_up(region_rows(vehicles_by_postcode), "postal_area")


def region_from_sums(sums: DataFrame) -> DataFrame:
    return sums.select(
        "postal_area", "electric_vehicles", "petrol_vehicles", "diesel_vehicles", "plugin_hybrids", "total_vehicles",
        percentage(F.col("electric_vehicles"), F.col("total_vehicles"), 2).alias("ev_percentage"),
    )


def ev_by_region(vehicles_by_postcode: DataFrame) -> DataFrame:
    """Electric adoption per postal area. Partial sums leave about ninety rows per task to shuffle."""
    return region_from_sums(region_sums(vehicles_by_postcode))


def charging_rows(charging_capacity: DataFrame, *carry: str) -> DataFrame:
    return charging_capacity.select(
        F.col("areamanagerid").alias("area_manager_id"), F.lit(1).alias("num_parking_areas"),
        whole_number(F.col("chargingpointcapacity")).alias("total_charging_points"), *carry)


def charging_by_area(charging_capacity: DataFrame) -> DataFrame:
    """Parking areas and charging points per area manager; text that is no number counts as NULL, decimals are rounded."""
    return added_up(charging_rows(charging_capacity), "area_manager_id")


def vehicles_with_fuel(vehicles_fuel: DataFrame, *carry: str) -> DataFrame:
    """One classified row per fuel record; a narrow map without a shuffle. ``carry`` names further columns to keep."""
    fuel = F.col("brandstof_omschrijving")
    return vehicles_fuel.select(
        "kenteken",
        bucketed_year(F.col("kenteken")).alias("registration_year"),
        fuel.alias("fuel_type"),
        fuel_category(fuel).alias("fuel_category"),
        is_ev_or_hybrid(fuel).alias("is_ev_or_hybrid"),
        *carry,
    )
