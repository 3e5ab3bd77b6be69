"""Weather and emissions beside adoption."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltatlas.functions import (
    climate_region_of_area, climate_region_of_station, percentage, ratio, round_half_up, rows_since,
)
from voltatlas.operators.curated import region_sums

# Keys of the emissions series.
HOME_COUNTRY = "country/NLD"
TRANSPORT_CO2 = "transportation_co2_climate_watch"
TOTAL_CO2 = "total_excluding_lulucf_co2_climate_watch"


def hours_below(degrees: float) -> Column:
    return F.count_if(F.col("temp") < degrees)


def weather_yearly(weather: DataFrame) -> DataFrame:
    return weather.groupBy(F.year("time").alias("year")).agg(
        round_half_up(F.avg("temp"), 1).alias("avg_temp_celsius"),
        hours_below(0).alias("freezing_hours"),
        round_half_up(F.sum(F.coalesce("precip_hour", F.lit(0.0))), 0).alias("total_precip_mm"),
    )


def weather_monthly(weather: DataFrame, first_year: int = 2020) -> DataFrame:
    """Seasonal pattern over all years from ``first_year``; rain is scaled to a month of thirty."""
    return rows_since(weather, first_year).groupBy(F.month("time").alias("month")).agg(
        round_half_up(F.avg("temp"), 1).alias("avg_temp_c"),
        percentage(hours_below(0), F.count("*"), 1).alias("pct_freezing"),
        round_half_up(F.avg(F.coalesce("precip_hour", F.lit(0.0))) * 30, 0).alias("avg_monthly_precip_mm"),
    )


def emissions_in_megatonnes(
    emissions: DataFrame, variable: str, name: str, first_year: int = 2010, geo: str = HOME_COUNTRY
) -> DataFrame:
    """One series in millions of tonnes, one row per year."""
    return emissions.where(
        (F.col("geo_id") == geo) & (F.col("variable") == variable)
        & (F.col("date") >= F.lit(f"{first_year}-01-01").cast("date"))
    ).select(F.year("date").alias("year"), round_half_up(F.col("value") / 1000000, 1).alias(name))


def transport_emissions(emissions: DataFrame, first_year: int = 2010) -> DataFrame:
    return emissions_in_megatonnes(emissions, TRANSPORT_CO2, "transport_co2_mt", first_year)


def total_emissions(emissions: DataFrame, first_year: int = 2010) -> DataFrame:
    return emissions_in_megatonnes(emissions, TOTAL_CO2, "total_co2_mt", first_year)


def climate_by_region(weather: DataFrame) -> DataFrame:
    """Temperatures per climate region.

    Hours are summed per station first, so that station names are searched
    once per station and not once per hour.
    """
    stations = weather.groupBy("stationname").agg(
        F.sum("temp").alias("degrees"),
        F.count("temp").alias("hours"),
        F.min("temp").alias("lowest"),
        hours_below(0).alias("freezing"),
        hours_below(-5).alias("extreme"),
    )
    return stations.groupBy(climate_region_of_station(F.col("stationname")).alias("climate_region")).agg(
        round_half_up(ratio(F.sum("degrees"), F.sum("hours")), 1).alias("mean"),
        round_half_up(F.min("lowest"), 1).alias("lowest"),
        F.sum("freezing").alias("total_freezing_hours"),
        F.sum("extreme").alias("total_extreme_cold_hours"),
    )


def adoption_by_region(areas: DataFrame) -> DataFrame:
    """Electric and all cars per climate region, from sums per postal area."""
    return areas.groupBy(climate_region_of_area(F.col("postal_area")).alias("region")).agg(
        F.sum("electric_vehicles").alias("evs"), F.sum("total_vehicles").alias("total")
    )


def regional_weather_ev(weather: DataFrame, ev_by_region: DataFrame, first_year: int = 2020) -> DataFrame:
    """Recent climate of a region beside its adoption.

    The region's name comes from the adoption side, so a climate region
    without areas keeps its weather under a NULL name.
    """
    climate = climate_by_region(rows_since(weather, first_year))
    adoption = adoption_by_region(ev_by_region)
    return climate.join(adoption, climate.climate_region == adoption.region, "left").select(
        "region", "evs", "total",
        percentage(F.col("evs"), F.col("total"), 2).alias("ev_share_pct"),
        F.col("mean").alias("avg_temp"), "total_freezing_hours", "total_extreme_cold_hours",
    )


def regional_climate_extremes(weather: DataFrame, vehicles_by_postcode: DataFrame) -> DataFrame:
    """All years, with the lowest temperature; a region without cars shows zeroes."""
    climate = climate_by_region(weather.where(F.col("temp").isNotNull()))
    adoption = adoption_by_region(region_sums(vehicles_by_postcode))
    evs = F.coalesce("evs", F.lit(0))
    return climate.join(adoption, climate.climate_region == adoption.region, "left").select(
        "climate_region",
        evs.alias("total_evs"),
        F.coalesce("total", F.lit(0)).alias("total_vehicles"),
        percentage(evs, F.col("total"), 1).alias("ev_share_pct"),
        F.col("mean").alias("avg_temp_c"),
        F.col("lowest").alias("coldest_temp_c"),
        "total_freezing_hours", "total_extreme_cold_hours",
    )


def ev_weather_emissions(
    ev_yoy_growth: DataFrame, weather_yearly: DataFrame, transport_emissions: DataFrame, first_year: int = 2015
) -> DataFrame:
    """Growth, weather and emissions by year; every input has one row per year."""
    return (
        ev_yoy_growth.where(F.col("registration_year") >= first_year)
        .withColumnRenamed("registration_year", "year")
        .join(weather_yearly, "year", "left")
        .join(transport_emissions, "year", "left")
        .select(
            "year", F.col("ev_count").alias("total_evs"), "yoy_growth_percent",
            "avg_temp_celsius", "freezing_hours", "transport_co2_mt",
        )
    )
