"""Exploration and verification queries.

Every top-k orders by the key as well, so that equal values give one answer.
Ordered limits run as top-k per task, never as a full sort.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltatlas.functions import round_half_up, rows_since
from voltatlas.operators.climate import HOME_COUNTRY, TOTAL_CO2, hours_below


def row_counts(tables: dict[str, DataFrame], expected: dict[str, int] | None = None) -> DataFrame:
    """Rows of each table, beside the expected number where there is one."""
    expected = expected or {}
    parts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(expected.get(name)).cast("bigint").alias("expected")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def key_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys present in both tables.

    Both sides are reduced to distinct keys first; the join reuses that
    partitioning, and no key is joined more than once.
    """
    both = left.select(key).distinct().join(right.select(key).distinct(), key)
    return both.agg(F.count(key).alias("overlap_count"))


def frequencies(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("count")).orderBy(F.col("count").desc(), column)


def filtered_count(df: DataFrame, condition: Column, name: str) -> DataFrame:
    return df.where(condition).agg(F.count("*").alias(name))


def labelled_count(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.count("*").alias("result")).select(F.lit(label).alias("query"), "result")


def weather_sample(weather: DataFrame, first_year: int = 2024, limit: int = 10) -> DataFrame:
    """First observations from a year on, under readable names."""
    return (
        rows_since(weather, first_year)
        .select(
            "time", "stationname",
            F.col("temp").alias("temperature_celsius"),
            F.col("rel_humidity").alias("humidity_pct"),
            F.col("wind_speed").alias("wind_m_per_s"),
            F.col("precip_hour").alias("precipitation_mm"),
        )
        .orderBy(*[F.col(name).asc_nulls_first() for name in (
            "time", "stationname", "temperature_celsius", "humidity_pct", "wind_m_per_s", "precipitation_mm")])
        .limit(limit)
    )


def stations(weather: DataFrame, with_position: bool = False, limit: int = 20) -> DataFrame:
    columns = ["stationname", "lat", "lon"] if with_position else ["stationname"]
    return weather.select(*columns).distinct().orderBy(*columns).limit(limit)


def weather_by_year(weather: DataFrame, first_year: int = 2015) -> DataFrame:
    return (
        rows_since(weather, first_year)
        .groupBy(F.year("time").alias("year"))
        .agg(
            round_half_up(F.avg("temp"), 1).alias("avg_temp_celsius"),
            hours_below(0).alias("freezing_hours"),
            F.count("*").alias("total_observations"),
        )
        .orderBy("year")
    )


def coldest_stations(weather: DataFrame, first_year: int = 2020, limit: int = 10) -> DataFrame:
    return (
        rows_since(weather, first_year)
        .groupBy("stationname")
        .agg(
            round_half_up(F.avg("temp"), 1).alias("avg_temp"),
            hours_below(0).alias("freezing_hours"),
            round_half_up(F.avg("precip_hour"), 2).alias("avg_precip_mm"),
        )
        .orderBy(F.col("freezing_hours").desc(), "stationname")
        .limit(limit)
    )


def _series(emissions: DataFrame, variable: str, geo: str) -> DataFrame:
    return emissions.where((F.col("geo_id") == geo) & (F.col("variable") == variable))


def emissions_series(emissions: DataFrame, variable: str, geo: str = HOME_COUNTRY, limit: int = 20) -> DataFrame:
    """Newest values of one series as delivered."""
    return (
        _series(emissions, variable, geo)
        .select(F.year("date").alias("year"), "variable_name", F.col("value").alias("emissions_tonnes"), "unit")
        .orderBy(F.col("year").desc())
        .limit(limit)
    )


def emissions_series_mt(emissions: DataFrame, variable: str, geo: str = HOME_COUNTRY, limit: int = 15) -> DataFrame:
    """Newest values of one series in millions of tonnes."""
    return (
        _series(emissions, variable, geo)
        .select(F.year("date").alias("year"), round_half_up(F.col("value") / 1000000, 2).alias("transport_co2_mt"))
        .orderBy(F.col("year").desc())
        .limit(limit)
    )


def emissions_by_year(emissions: DataFrame, variable: str = TOTAL_CO2, geo: str = HOME_COUNTRY, limit: int = 10) -> DataFrame:
    return (
        _series(emissions, variable, geo)
        .groupBy(F.year("date").alias("year"))
        .agg(round_half_up(F.sum("value") / 1000000, 2).alias("emissions_mt_co2e"))
        .orderBy(F.col("year").desc())
        .limit(limit)
    )


def category_year_mix(vehicles_with_fuel: DataFrame, first_year: int = 2020) -> DataFrame:
    """Counts by category and year beside the category's mean and the year's total.

    The windows see one row per category and year, not the vehicles.
    """
    return (
        vehicles_with_fuel.where(F.col("registration_year") >= first_year)
        .groupBy("fuel_category", "registration_year")
        .agg(F.count("*").alias("vehicle_count"))
        .withColumn("avg_per_category", F.avg("vehicle_count").over(Window.partitionBy("fuel_category")))
        .withColumn("total_that_year", F.sum("vehicle_count").over(Window.partitionBy("registration_year")))
        .orderBy("registration_year", F.col("vehicle_count").desc(), "fuel_category")
    )


def top(df: DataFrame, column: str, limit: int, *ties: str) -> DataFrame:
    """Rows with the largest values, NULLs last."""
    return df.orderBy(F.col(column).desc_nulls_last(), *ties).limit(limit)


def fleet_metrics(status: DataFrame) -> DataFrame:
    """Four figures as (metric, value) rows from one pass over the status table."""
    figures = status.agg(
        F.count("*").cast("string").alias("Total Vehicles"),
        F.count_if(F.col("status") == "LOW_BATTERY").cast("string").alias("Low Battery Alerts"),
        F.count_if(F.col("status") == "CHARGING").cast("string").alias("Currently Charging"),
        round_half_up(F.avg("current_battery"), 0).cast("int").cast("string").alias("Average Battery %"),
    )
    return figures.unpivot([], figures.columns, "metric", "value")


def needing_attention(status: DataFrame, states: tuple[str, ...] = ("LOW_BATTERY", "CHARGING")) -> DataFrame:
    return (
        status.where(F.col("status").isin(*states))
        .select("vin", "brand", "current_battery", "status")
        .orderBy("current_battery", "vin")
    )


def last_seen(status: DataFrame, limit: int = 20) -> DataFrame:
    return status.orderBy(F.col("last_seen").desc(), "vin").limit(limit)
