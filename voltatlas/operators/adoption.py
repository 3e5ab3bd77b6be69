"""Analytics layer: national figures, trends, fuel mix and charging infrastructure."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltatlas.functions import area_of, fuel_label, percentage, ratio, registry_fuel_label, round_half_up, whole_number
from voltatlas.functions.fuel import FUEL_LABELS
from voltatlas.operators.curated import PASSENGER_CAR, added_up


def national_ev_summary(ev_by_region: DataFrame, min_total: int = 1000) -> DataFrame:
    """One row over the areas with more than ``min_total`` cars."""
    return (
        ev_by_region.where(F.col("total_vehicles") > min_total)
        .agg(
            F.sum("electric_vehicles").alias("total_evs"),
            F.sum("total_vehicles").alias("total_vehicles"),
            percentage(F.sum("electric_vehicles"), F.sum("total_vehicles"), 2).alias("national_ev_percentage"),
            F.count_distinct("postal_area").alias("regions_analyzed"),
            F.max("ev_percentage").alias("highest_regional_ev_pct"),
            F.min("ev_percentage").alias("lowest_regional_ev_pct"),
        )
        .select(F.lit("Netherlands").alias("country"), "*")
    )


def growth_rows(vehicles_with_fuel: DataFrame, first_year: int = 2015, *carry: str) -> DataFrame:
    return vehicles_with_fuel.where(F.col("registration_year") >= first_year).select(
        "registration_year", "fuel_category", F.lit(1).alias("vehicle_count"),
        F.when(F.col("is_ev_or_hybrid"), 1).otherwise(0).alias("ev_hybrid_count"), *carry)


def growth_sums(vehicles_with_fuel: DataFrame, first_year: int = 2015) -> DataFrame:
    """Vehicles and low-carbon vehicles per year and category."""
    return added_up(growth_rows(vehicles_with_fuel, first_year), "registration_year", "fuel_category")


def growth_from_sums(sums: DataFrame) -> DataFrame:
    return sums.select(
        "registration_year", "fuel_category", "vehicle_count", "ev_hybrid_count",
        percentage(F.col("ev_hybrid_count"), F.col("vehicle_count"), 2).alias("ev_percentage"),
    )


def ev_growth_trends(vehicles_with_fuel: DataFrame, first_year: int = 2015) -> DataFrame:
    return growth_from_sums(growth_sums(vehicles_with_fuel, first_year))


def ev_yoy_growth(vehicles_with_fuel: DataFrame, first_year: int = 2015) -> DataFrame:
    return yoy_from_sums(growth_sums(vehicles_with_fuel, first_year))


def yoy_from_sums(sums: DataFrame) -> DataFrame:
    """Yearly totals with growth against the year before, from the sums per year and category (or the trends).

    The one-partition window runs over one row per year, after the aggregation.
    """
    yearly = sums.groupBy("registration_year").agg(
        F.sum("vehicle_count").alias("total_vehicles"), F.sum("ev_hybrid_count").alias("ev_count"))
    previous = F.col("prev_year_ev_count")
    growth = percentage(F.col("ev_count") - previous, previous, 1)
    return yearly.withColumn(
        "prev_year_ev_count", F.lag("ev_count").over(Window.orderBy("registration_year"))
    ).select(
        "registration_year", "total_vehicles", "ev_count",
        percentage(F.col("ev_count"), F.col("total_vehicles"), 2).alias("ev_share_percent"),
        "prev_year_ev_count",
        F.when(previous > 0, growth).alias("yoy_growth_percent"),
    )


def plate_month_rows(vehicles: DataFrame, first_year: int = 2015, *carry: str) -> DataFrame:
    """Plate and month of each registration.

    The text comparison repeats the date filter in a form the scan can use:
    eight-digit dates sort as text.
    """
    text = F.col("datum_eerste_tenaamstelling_in_nederland")
    day = F.try_to_date(text, "yyyyMMdd")
    return vehicles.where((text >= f"{first_year}0101") & (day >= F.lit(f"{first_year}-01-01").cast("date"))).select(
        "kenteken", F.trunc(day, "MM").alias("datum"), F.lit(1).alias("registrations"), *carry)


def plate_months(vehicles: DataFrame, first_year: int = 2015) -> DataFrame:
    """Registrations per plate and month."""
    return added_up(plate_month_rows(vehicles, first_year), "kenteken", "datum")


def plate_fuel_rows(vehicles_fuel: DataFrame, *carry: str) -> DataFrame:
    labelled = vehicles_fuel.select("kenteken", fuel_label(F.col("brandstof_omschrijving")).alias("label"), *carry)
    return labelled.select(
        "kenteken", *[F.when(F.col("label") == name, 1).otherwise(0).alias(name) for name in FUEL_LABELS], *carry)


def plate_fuels(vehicles_fuel: DataFrame) -> DataFrame:
    """Fuel records per plate, one column per label: at most one row per plate."""
    return added_up(plate_fuel_rows(vehicles_fuel), "kenteken")


def month_fuel_sums(months: DataFrame, fuels: DataFrame) -> DataFrame:
    """Pairs of registration and fuel record per month, one column per label.

    Both sides arrive counted per plate, so the product of counts replaces the
    pairs: a plate that holds a third of all rows costs a handful of rows here.
    """
    return (
        months.join(fuels, "kenteken")
        .groupBy("datum")
        .agg(*[F.sum(F.col("registrations") * F.col(name)).alias(name) for name in FUEL_LABELS])
    )


def fuel_rows(wide: DataFrame) -> DataFrame:
    return wide.unpivot(["datum"], list(FUEL_LABELS), "brandstof", "aantal").where(F.col("aantal") > 0)


def fuel_per_month(vehicles: DataFrame, vehicles_fuel: DataFrame, first_year: int = 2015) -> DataFrame:
    """Registrations by month and fuel label; plates join many to many."""
    return fuel_rows(month_fuel_sums(plate_months(vehicles, first_year), plate_fuels(vehicles_fuel)))


def capacity_rows(charging_capacity: DataFrame, *carry: str) -> DataFrame:
    points = whole_number(F.col("chargingpointcapacity"))
    return charging_capacity.where(points > 0).select("areamanagerid", points.alias("points"), *carry)


def manager_capacity(charging_capacity: DataFrame) -> DataFrame:
    """Charging points per area manager, counting positive numbers only."""
    return added_up(capacity_rows(charging_capacity), "areamanagerid")


def address_rows(parking_address: DataFrame, *carry: str) -> DataFrame:
    return parking_address.where((F.col("parkingaddresstype") == "F") & (F.col("zipcode") != "")).select(
        F.variant_get("raw_json", "$.parkingaddressreference", "string").alias("areamanagerid"),
        F.left("zipcode", F.lit(4)).alias("postcode"), F.lit(1).alias("addresses"), *carry)


def facility_addresses(parking_address: DataFrame) -> DataFrame:
    """Facility addresses per manager reference (kept in the raw record) and postcode."""
    return added_up(address_rows(parking_address), "areamanagerid", "postcode")


def postcode_charger_sums(addresses: DataFrame, capacity: DataFrame) -> DataFrame:
    return (
        addresses.join(capacity, "areamanagerid")
        .groupBy("postcode")
        .agg(F.sum(F.col("addresses") * F.col("points")).alias("aantal"))
    )


def chargers_per_postcode(parking_address: DataFrame, charging_capacity: DataFrame) -> DataFrame:
    """Charging points per four-character postcode.

    The join is many to many and stays so: every address of a manager counts
    the manager's whole capacity. Counting each side per manager first gives
    the same sums without emitting the pairs.
    """
    return postcode_charger_sums(facility_addresses(parking_address), manager_capacity(charging_capacity))


def postcode_fuel_rows(vehicles_by_postcode: DataFrame, *carry: str) -> DataFrame:
    return vehicles_by_postcode.where((F.col("voertuigsoort") == PASSENGER_CAR) & F.col("postcode").isNotNull()).select(
        F.left("postcode", F.lit(4)).alias("postcode"),
        registry_fuel_label(F.col("brandstof"), F.col("extern_oplaadbaar")).alias("brandstof"), "aantal", *carry)


def fuel_per_postcode(vehicles_by_postcode: DataFrame) -> DataFrame:
    """Passenger cars per four-character postcode and fuel label."""
    return added_up(postcode_fuel_rows(vehicles_by_postcode), "postcode", "brandstof")


def ev_infrastructure(ev_by_region: DataFrame, chargers: DataFrame, min_total: int = 5000) -> DataFrame:
    """Adoption against charging points per area.

    An area without chargers keeps 0 points and a NULL ratio.
    """
    per_area = chargers.groupBy(area_of(F.col("postcode")).alias("postal_area")).agg(F.sum("aantal").alias("points"))
    points = F.col("points")
    return (
        ev_by_region.where(F.col("total_vehicles") > min_total)
        .join(per_area, "postal_area", "left")
        .select(
            "postal_area", "electric_vehicles", "ev_percentage",
            F.coalesce(points, F.lit(0)).alias("charging_points"),
            F.when(points > 0, round_half_up(ratio(F.col("electric_vehicles"), points), 0))
            .alias("evs_per_charging_point"),
        )
    )
