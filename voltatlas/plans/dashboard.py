"""Dashboard queries: thin reads over models that are already small."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltatlas.functions import month_label, percentage, ratio, round_half_up, with_region_name
from voltatlas.plans.explore import top


def kpis(ev_by_region: DataFrame) -> DataFrame:
    evs, total = F.sum("electric_vehicles"), F.sum("total_vehicles")
    return ev_by_region.agg(
        evs.alias("total_evs"),
        total.alias("total_vehicles"),
        percentage(evs, total, 1).alias("ev_share"),
        F.count_distinct("postal_area").alias("regions"),
        F.max("ev_percentage").alias("top_region_pct"),
    )


def charging_points(charging_by_area: DataFrame) -> DataFrame:
    return charging_by_area.agg(F.coalesce(F.sum("total_charging_points"), F.lit(0)).alias("points"))


def leading_areas(ev_by_region: DataFrame, min_total: int = 10000, limit: int = 10) -> DataFrame:
    large = ev_by_region.where(F.col("total_vehicles") > min_total)
    return top(
        large.select("postal_area", "ev_percentage", "electric_vehicles", "total_vehicles"),
        "ev_percentage", limit, "postal_area",
    )


def named_areas(ev_by_region: DataFrame) -> DataFrame:
    return with_region_name(ev_by_region).select("postal_area", "region_name", "ev_percentage")


def _equipped(ev_infrastructure: DataFrame) -> DataFrame:
    return ev_infrastructure.where(F.col("charging_points") > 0)


def adoption_and_chargers(ev_infrastructure: DataFrame, limit: int = 15) -> DataFrame:
    """Areas with most electric cars; cars in hundreds to share an axis with chargers."""
    rows = top(_equipped(ev_infrastructure), "electric_vehicles", limit, "postal_area")
    return with_region_name(rows).withColumn("electric_vehicles_hundreds", F.col("electric_vehicles") / 100)


def charger_pressure(ev_infrastructure: DataFrame, limit: int = 15) -> DataFrame:
    """Mean cars per charger over those areas, with the worst and the best served one."""
    place = F.row_number().over(Window.orderBy(F.col("electric_vehicles").desc(), "postal_area"))
    rows = adoption_and_chargers(ev_infrastructure, limit).withColumn("place", place)
    load = F.col("evs_per_charging_point")
    # Equal loads go to the area that stands first in the list.
    worst, best = F.struct(load, -F.col("place")), F.struct(load, F.col("place"))
    return rows.agg(
        round_half_up(F.avg(load), 2).alias("avg_evs_per_charger"),
        F.max_by("region_name", worst).alias("most_underserved"),
        F.max_by("evs_per_charging_point", worst).alias("most_underserved_ratio"),
        F.max_by("electric_vehicles", worst).alias("most_underserved_evs"),
        F.max_by("charging_points", worst).alias("most_underserved_points"),
        F.min_by("region_name", best).alias("best_served"),
        F.min_by("evs_per_charging_point", best).alias("best_served_ratio"),
    )


def infrastructure_gaps(ev_infrastructure: DataFrame, limit: int = 20) -> DataFrame:
    rows = top(_equipped(ev_infrastructure), "evs_per_charging_point", limit, "postal_area")
    return with_region_name(rows).select(
        "region_name", "electric_vehicles", "charging_points", "ev_percentage", "evs_per_charging_point"
    )


def share_by_year(ev_yoy_growth: DataFrame, first_year: int = 2015) -> DataFrame:
    return (
        ev_yoy_growth.where(F.col("registration_year") >= first_year)
        .select("registration_year", "ev_share_percent")
        .orderBy("registration_year")
    )


def share_change(ev_yoy_growth: DataFrame, first_year: int = 2020) -> DataFrame:
    """Change of share in percentage points; the first year shown has none."""
    share = F.coalesce("ev_share_percent", F.lit(0.0))
    older = F.lag(share).over(Window.orderBy("registration_year"))
    return (
        ev_yoy_growth.where(F.col("registration_year") >= first_year)
        .select("registration_year", share.alias("ev_share_percent"), round_half_up(share - older, 2).alias("change_pp"))
        .orderBy(F.col("registration_year").desc())
    )


def peak_growth(ev_yoy_growth: DataFrame) -> DataFrame:
    known = ev_yoy_growth.where(F.col("yoy_growth_percent").isNotNull())
    return top(known.select("registration_year", "yoy_growth_percent"), "yoy_growth_percent", 1, "registration_year")


def leader_and_gap(ev_by_region: DataFrame, ev_infrastructure: DataFrame) -> DataFrame:
    """The area with the highest share and the one with the most cars per charger, one row each."""
    leader = with_region_name(top(ev_by_region, "ev_percentage", 1, "postal_area")).select(
        F.lit("top_region").alias("insight"), "region_name", "electric_vehicles",
        F.col("ev_percentage").alias("value"),
    )
    gap = with_region_name(top(_equipped(ev_infrastructure), "evs_per_charging_point", 1, "postal_area")).select(
        F.lit("infrastructure_gap").alias("insight"), "region_name", "electric_vehicles",
        F.col("evs_per_charging_point").alias("value"),
    )
    return leader.unionByName(gap)


def climate_hypothesis(regional_weather_ev: DataFrame) -> DataFrame:
    """Whether the region with the highest share also has the fewest freezing hours."""
    # NULL shares sort last; equal values fall to the region first in the alphabet.
    share, cold = F.coalesce("ev_share_pct", F.lit(-1.0)), F.col("total_freezing_hours")
    name = F.col("region")
    rows = regional_weather_ev.select(
        name, share.alias("share"), cold.alias("cold"),
        F.row_number().over(Window.orderBy(share.desc(), name)).alias("by_share"),
        F.row_number().over(Window.orderBy(cold, share.desc(), name)).alias("by_mild"),
        F.row_number().over(Window.orderBy(cold.desc(), share.desc(), name)).alias("by_harsh"),
    )

    def first(value: str, rank: str) -> Column:
        return F.max(F.when(F.col(rank) == 1, F.col(value)))

    return rows.agg(
        first("region", "by_share").alias("top_region"),
        first("share", "by_share").alias("top_share_pct"),
        first("region", "by_mild").alias("mildest_region"),
        first("cold", "by_mild").alias("mildest_freezing_hours"),
        first("region", "by_harsh").alias("harshest_region"),
        first("cold", "by_harsh").alias("harshest_freezing_hours"),
    ).withColumn("hypothesis_confirmed", F.col("top_region") == F.col("mildest_region"))


def emissions_reduction(transport_emissions: DataFrame) -> DataFrame:
    """Highest and latest yearly emissions and the fall between them in percent."""
    mt, year = F.col("transport_co2_mt"), F.col("year")
    peak_first = F.struct(mt, -year)
    return transport_emissions.agg(
        F.max_by("year", peak_first).alias("peak_year"),
        F.max("transport_co2_mt").alias("peak_mt"),
        F.max("year").alias("latest_year"),
        F.max_by("transport_co2_mt", "year").alias("latest_mt"),
    ).select(
        "*",
        percentage(F.col("peak_mt") - F.col("latest_mt"), F.col("peak_mt"), 1).alias("reduction_pct"),
    )


def monthly_pattern(weather_monthly: DataFrame) -> DataFrame:
    return weather_monthly.select(
        F.col("month").alias("month_num"), month_label(F.col("month")).alias("month"),
        "avg_temp_c", "pct_freezing", "avg_monthly_precip_mm",
    ).orderBy("month_num")


def fuel_shares(ev_by_region: DataFrame, min_total: int = 50000, limit: int = 12) -> DataFrame:
    """Fuel shares of the areas with most electric cars, by electric share."""
    total = F.col("total_vehicles")
    rows = top(ev_by_region.where(total > min_total), "electric_vehicles", limit, "postal_area")
    shares = rows.select(
        "postal_area",
        percentage(F.col("electric_vehicles"), total, 1).alias("electric_pct"),
        percentage(F.col("petrol_vehicles"), total, 1).alias("petrol_pct"),
        percentage(F.col("diesel_vehicles"), total, 1).alias("diesel_pct"),
    )
    return with_region_name(shares).orderBy(F.col("electric_pct").desc(), "postal_area")


def fuel_totals(ev_by_region: DataFrame) -> DataFrame:
    sums = ev_by_region.agg(*[F.sum(f"{name}_vehicles").alias(name) for name in ("electric", "petrol", "diesel", "total")])
    return sums.select("*", *[
        percentage(F.col(name), F.col("total"), 1).alias(f"{name}_pct") for name in ("electric", "petrol", "diesel")
    ])


def emissions_trend(transport_emissions: DataFrame, total_emissions: DataFrame, first_year: int = 2010) -> DataFrame:
    """Both yearly series as (series, year, mt) rows in year order."""
    transport = transport_emissions.select(F.lit("transport").alias("series"), "year", F.col("transport_co2_mt").alias("mt"))
    total = total_emissions.select(F.lit("total").alias("series"), "year", F.col("total_co2_mt").alias("mt"))
    return transport.unionByName(total).where(F.col("year") >= first_year).orderBy("year", "series")


def fleet_kpis(status: DataFrame) -> DataFrame:
    return status.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("status") == "LOW_BATTERY").alias("low_battery"),
        F.count_if(F.col("status") == "CHARGING").alias("charging"),
        round_half_up(F.avg("current_battery"), 0).alias("avg_battery"),
    ).withColumn("health_score", F.lit(100.0) - ratio(F.col("low_battery"), F.col("total")) * 100)


def brand_shares(fleet_alerts: DataFrame) -> DataFrame:
    """Low and charging share per brand; a brand without vehicles shows 0."""
    total = F.greatest("total_vehicles", F.lit(1))
    return fleet_alerts.select(
        "brand", "total_vehicles",
        percentage(F.col("low_battery_count"), total, 1).alias("low_battery_pct"),
        percentage(F.col("charging_count"), total, 1).alias("charging_pct"),
    ).orderBy(F.col("total_vehicles").desc(), "brand")


def vehicle_list(status: DataFrame, limit: int = 20) -> DataFrame:
    """Vehicles by urgency: low battery, then charging, then the rest."""
    urgency = F.when(F.col("status") == "LOW_BATTERY", 1).when(F.col("status") == "CHARGING", 2).otherwise(3)
    return status.orderBy(urgency, "current_battery", "vin").limit(limit).select(
        "vin", "brand", "current_battery", "status",
        F.date_format("last_seen", "yyyy-MM-dd HH:mm").alias("last_seen"),
    )


def alert_rows(fleet_alerts: DataFrame) -> DataFrame:
    """One row per brand and kind of alert that has vehicles."""
    return (
        fleet_alerts.select(
            "brand", F.col("low_battery_count").alias("low_battery"), F.col("charging_count").alias("charging"))
        .unpivot(["brand"], ["low_battery", "charging"], "alert", "vehicles")
        .where(F.col("vehicles") > 0)
    )
