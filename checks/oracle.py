"""The registered queries as DuckDB SQL over the given tables.

Written on its own from the models' definitions: joins emit their pairs, windows
run over whole groups and top-k rows are ranked, where the Spark jobs avoid that.
"""

from __future__ import annotations

import re

from checks.inputs import TABLES, TARGETS, VIEWS
from checks.registry import MIN_TOTAL, MIN_TOTAL_LARGE, QUOTA, EXPECTED_ROWS
from voltatlas.functions.places import AREA_NAMES


def rnd(value: str, digits: int) -> str:
    return f"cast(round(cast({value} AS decimal(28,7)), {digits}) AS double)"


def pct(part: str, whole: str, digits: int) -> str:
    return rnd(f"cast(100 AS double) * cast({part} AS double) / nullif(cast({whole} AS double), 0)", digits)


def named(area: str) -> str:
    return f"coalesce((SELECT an.region_name FROM area_names an WHERE an.code = {area}), 'Area ' || {area})"


def region_of_station(name: str) -> str:
    return (f"CASE WHEN regexp_matches({name}, 'SCHIPHOL|AMSTERDAM|ROTTERDAM|DEN HAAG|UTRECHT|HAARLEM|VALKENBURG|VOORSCHOTEN') "
            f"THEN 'Randstad' WHEN regexp_matches({name}, 'GRONINGEN|LEEUWARDEN|EELDE|HOOGEVEEN') THEN 'Noord' "
            f"WHEN regexp_matches({name}, 'MAASTRICHT|EINDHOVEN|VOLKEL|ARCEN') THEN 'Zuid' ELSE 'Overig' END")


def region_of_area(area: str) -> str:
    return (f"CASE WHEN regexp_full_match({area}, '[123][0-9]') THEN 'Randstad' "
            f"WHEN regexp_full_match({area}, '8[89]|9[0-9]') THEN 'Noord' "
            f"WHEN regexp_full_match({area}, '5[0-9]|6[0-6]') THEN 'Zuid' ELSE 'Overig' END")


PLATE_HASH = "cast('0x' || substr(md5(kenteken), 1, 8) AS bigint)"
LOW_CARBON = "(lower(fuel_type) IN ('elektriciteit', 'elektrisch', 'waterstof') OR lower(fuel_type) LIKE '%hybride%')"
AS_OF = "TIMESTAMP '2024-01-30 12:00:00'"
END_OF_EVENTS = "TIMESTAMP '2024-01-31 00:00:00'"


def status_sql(as_of: str) -> str:
    return f"""
SELECT vin, regexp_extract(vin, '^[^-]*') AS brand, event_timestamp AS last_seen, battery_pct AS current_battery,
       latitude AS current_lat, longitude AS current_lon, avg_speed_kmh,
       CASE WHEN battery_pct < 20 THEN 'LOW_BATTERY' WHEN charging THEN 'CHARGING' ELSE 'ACTIVE' END AS status
FROM (SELECT *, {rnd("avg(speed_kmh) OVER (PARTITION BY vin)", 1)} AS avg_speed_kmh,
             row_number() OVER (PARTITION BY vin ORDER BY event_timestamp DESC, event_id DESC) AS place
      FROM telemetry WHERE event_timestamp > {as_of} - INTERVAL 24 HOUR) t
WHERE place = 1"""


CTES = dict(VIEWS)
CTES |= {
    "area_names": "SELECT * FROM (VALUES " + ", ".join(
        f"('{code}', '{name}')" for code, name in AREA_NAMES.items()) + ") v(code, region_name)",
    "targets": "SELECT * FROM (VALUES " + ", ".join(
        f"('{model}', {lag}::bigint)" for model, lag in TARGETS.items()) + ") v(model, target_lag_seconds)",
    "ev_by_region": f"""
SELECT *, {pct('electric_vehicles', 'total_vehicles', 2)} AS ev_percentage
FROM (SELECT left(postcode, 2) AS postal_area,
             coalesce(sum(aantal) FILTER (brandstof = 'E'), 0)::bigint AS electric_vehicles,
             coalesce(sum(aantal) FILTER (brandstof = 'B'), 0)::bigint AS petrol_vehicles,
             coalesce(sum(aantal) FILTER (brandstof = 'D'), 0)::bigint AS diesel_vehicles,
             coalesce(sum(aantal) FILTER (extern_oplaadbaar = 'J'), 0)::bigint AS plugin_hybrids,
             sum(aantal)::bigint AS total_vehicles
      FROM vehicles_by_postcode WHERE voertuigsoort = 'Personenauto' GROUP BY ALL) s""",
    "charging_by_area": """
SELECT areamanagerid AS area_manager_id, count(*) AS num_parking_areas,
       sum(round(try_cast(trim(chargingpointcapacity) AS decimal(28,7)))::int)::bigint AS total_charging_points
FROM charging_capacity GROUP BY ALL""",
    "vehicles_with_fuel": f"""
SELECT kenteken,
       cast(CASE WHEN regexp_full_match(kenteken, '[0-9]{{2}}[A-Z]{{3}}[0-9]') THEN 2020 + {PLATE_HASH} % 6
                 WHEN regexp_full_match(kenteken, '[0-9][A-Z]{{3}}[0-9]{{2}}') THEN 2015 + {PLATE_HASH} % 5
                 WHEN regexp_full_match(kenteken, '[A-Z]{{2}}[0-9]{{3}}[A-Z]') THEN 2010 + {PLATE_HASH} % 5
                 ELSE 2015 + {PLATE_HASH} % 11 END AS int) AS registration_year,
       fuel_type,
       CASE WHEN lower(fuel_type) LIKE '%hybride%' THEN 'Hybrid'
            ELSE coalesce(map {{'elektriciteit': 'Electric', 'elektrisch': 'Electric', 'waterstof': 'Hydrogen',
                               'benzine': 'Petrol', 'diesel': 'Diesel', 'lpg': 'LPG', 'cng': 'Gas',
                               'lng': 'Gas'}}[lower(fuel_type)],
                          'Other') END AS fuel_category,
       coalesce({LOW_CARBON}, false) AS is_ev_or_hybrid
FROM (SELECT kenteken, brandstof_omschrijving AS fuel_type FROM vehicles_fuel) f""",
    "national_ev_summary": f"""
SELECT 'Netherlands' AS country, sum(electric_vehicles)::bigint AS total_evs, sum(total_vehicles)::bigint AS total_vehicles,
       {pct('sum(electric_vehicles)', 'sum(total_vehicles)', 2)} AS national_ev_percentage,
       count(DISTINCT postal_area) AS regions_analyzed,
       max(ev_percentage) AS highest_regional_ev_pct, min(ev_percentage) AS lowest_regional_ev_pct
FROM ev_by_region WHERE total_vehicles > {MIN_TOTAL}""",
    "ev_growth_trends": f"""
SELECT registration_year, fuel_category, count(*) AS vehicle_count,
       count(*) FILTER (is_ev_or_hybrid) AS ev_hybrid_count,
       {pct('count(*) FILTER (is_ev_or_hybrid)', 'count(*)', 2)} AS ev_percentage
FROM vehicles_with_fuel WHERE registration_year >= 2015 GROUP BY registration_year, fuel_category""",
    "ev_yoy_growth": f"""
SELECT now.registration_year, now.total_vehicles, now.ev_count,
       {pct('now.ev_count', 'now.total_vehicles', 2)} AS ev_share_percent,
       past.ev_count AS prev_year_ev_count,
       CASE WHEN past.ev_count > 0 THEN {pct('(now.ev_count - past.ev_count)', 'past.ev_count', 1)} END AS yoy_growth_percent
FROM yearly now LEFT JOIN yearly past ON past.place = now.place - 1""",
    "yearly": """
SELECT registration_year, count(*) AS total_vehicles, count(*) FILTER (is_ev_or_hybrid) AS ev_count,
       row_number() OVER (ORDER BY registration_year) AS place
FROM vehicles_with_fuel WHERE registration_year >= 2015 GROUP BY registration_year""",
    "fuel_per_month": """
SELECT date_trunc('month', day)::date AS datum, brandstof, count(*) AS aantal
FROM (SELECT kenteken, try_strptime(datum_eerste_tenaamstelling_in_nederland, '%Y%m%d')::date AS day FROM vehicles) v
JOIN (SELECT kenteken, CASE WHEN lower(brandstof_omschrijving) IN ('elektriciteit', 'elektrisch') THEN 'Elektrisch'
                            WHEN lower(brandstof_omschrijving) LIKE '%hybride%' THEN 'Hybride'
                            WHEN lower(brandstof_omschrijving) = 'benzine' THEN 'Benzine'
                            WHEN lower(brandstof_omschrijving) = 'diesel' THEN 'Diesel' ELSE 'Overig' END AS brandstof
      FROM vehicles_fuel) f USING (kenteken)
WHERE day >= DATE '2015-01-01' GROUP BY ALL""",
    "chargers_per_postcode": """
SELECT left(zipcode, 4) AS postcode, sum(points)::bigint AS aantal
FROM (SELECT areamanagerid, round(try_cast(trim(chargingpointcapacity) AS decimal(28,7)))::int AS points FROM charging_capacity) c
JOIN parking_address p ON p.parkingaddressreference = c.areamanagerid
WHERE parkingaddresstype = 'F' AND zipcode <> '' AND points > 0 GROUP BY ALL""",
    "fuel_per_postcode": """
SELECT left(postcode, 4) AS postcode,
       coalesce(map {'E': 'Elektrisch', 'B': 'Benzine', 'D': 'Diesel'}[brandstof],
                if(extern_oplaadbaar = 'J', 'Hybride', 'Overig')) AS brandstof,
       sum(aantal)::bigint AS aantal
FROM vehicles_by_postcode vp WHERE voertuigsoort = 'Personenauto' AND postcode IS NOT NULL GROUP BY ALL""",
    "ev_infrastructure": f"""
SELECT e.postal_area, any_value(electric_vehicles) AS electric_vehicles, any_value(ev_percentage) AS ev_percentage,
       coalesce(sum(c.aantal), 0)::bigint AS charging_points,
       {rnd('any_value(electric_vehicles)::double / nullif(sum(c.aantal), 0)::double', 0)} AS evs_per_charging_point
FROM ev_by_region e LEFT JOIN chargers_per_postcode c ON left(c.postcode, 2) = e.postal_area
WHERE e.total_vehicles > {MIN_TOTAL} GROUP BY e.postal_area""",
    "weather_yearly": f"""
SELECT year(time)::int AS year, {rnd('avg(temp)', 1)} AS avg_temp_celsius, count(*) FILTER (temp < 0) AS freezing_hours,
       {rnd('coalesce(sum(precip_hour), 0)', 0)} AS total_precip_mm
FROM weather_hourly GROUP BY ALL""",
    "weather_monthly": f"""
SELECT month(time)::int AS month, {rnd('avg(temp)', 1)} AS avg_temp_c,
       {pct('count(*) FILTER (temp < 0)', 'count(*)', 1)} AS pct_freezing,
       {rnd('avg(coalesce(precip_hour, 0)) * 30', 0)} AS avg_monthly_precip_mm
FROM weather_hourly WHERE year(time) >= 2020 GROUP BY 1""",
    "transport_emissions": f"""
SELECT year(date)::int AS year, {rnd('value / 1000000', 1)} AS transport_co2_mt FROM emissions
WHERE geo_id = 'country/NLD' AND variable = 'transportation_co2_climate_watch' AND year(date) >= 2010""",
    "total_emissions": f"""
SELECT year(date)::int AS year, {rnd('value / 1000000', 1)} AS total_co2_mt FROM emissions
WHERE geo_id = 'country/NLD' AND variable = 'total_excluding_lulucf_co2_climate_watch' AND year(date) >= 2010""",
    "regional_weather_ev": f"""
SELECT region, evs, total, ev_share_pct, avg_temp, total_freezing_hours, total_extreme_cold_hours
FROM (SELECT {region_of_station('stationname')} AS climate_region, {rnd('avg(temp)', 1)} AS avg_temp,
             count(*) FILTER (temp < 0) AS total_freezing_hours, count(*) FILTER (temp < -5) AS total_extreme_cold_hours
      FROM weather_hourly WHERE year(time) >= 2020 GROUP BY 1) w
LEFT JOIN (SELECT {region_of_area('postal_area')} AS region, sum(electric_vehicles)::bigint AS evs,
                  sum(total_vehicles)::bigint AS total,
                  {pct('sum(electric_vehicles)', 'sum(total_vehicles)', 2)} AS ev_share_pct
           FROM ev_by_region GROUP BY 1) e ON region = climate_region""",
    "ev_weather_emissions": """
SELECT g.registration_year AS year, g.ev_count AS total_evs, g.yoy_growth_percent,
       w.avg_temp_celsius, w.freezing_hours, t.transport_co2_mt
FROM ev_yoy_growth g LEFT JOIN weather_yearly w ON w.year = g.registration_year
LEFT JOIN transport_emissions t ON t.year = g.registration_year WHERE g.registration_year >= 2015""",
    "vehicle_status": status_sql(AS_OF),
    "fleet_alerts": f"""
SELECT brand, count(*) AS total_vehicles, count(*) FILTER (status = 'LOW_BATTERY') AS low_battery_count,
       count(*) FILTER (status = 'CHARGING') AS charging_count, count(*) FILTER (status = 'ACTIVE') AS active_count,
       {rnd('avg(current_battery)', 0)} AS avg_battery_pct, {rnd('avg(avg_speed_kmh)', 1)} AS avg_fleet_speed
FROM vehicle_status GROUP BY brand""",
    "equipped": "SELECT * FROM ev_infrastructure WHERE charging_points > 0",
    "adoption_and_chargers": f"""
SELECT *, {named('postal_area')} AS region_name, electric_vehicles::double / 100 AS electric_vehicles_hundreds
FROM equipped ORDER BY electric_vehicles DESC, postal_area LIMIT 15""",
    "month_spend": """
SELECT *, date_trunc('month', start_time)::date AS month,
       sum(credits_used) OVER (PARTITION BY date_trunc('month', start_time) ORDER BY start_time, event_id
                               ROWS UNBOUNDED PRECEDING) AS spent
FROM usage_log""",
}

READS: dict[str, str] = {
    name: f"SELECT * FROM {name}" for name in (
        "ev_by_region", "charging_by_area", "vehicles_with_fuel", "national_ev_summary", "ev_growth_trends",
        "ev_yoy_growth", "fuel_per_month", "chargers_per_postcode", "fuel_per_postcode", "ev_infrastructure",
        "weather_yearly", "weather_monthly", "transport_emissions", "total_emissions", "regional_weather_ev",
        "ev_weather_emissions", "vehicle_status", "fleet_alerts",
    )
}
READS |= {
    "regional_climate_extremes": f"""
SELECT climate_region, coalesce(evs, 0)::bigint AS total_evs, coalesce(total, 0)::bigint AS total_vehicles,
       {pct('coalesce(evs, 0)', 'total', 1)} AS ev_share_pct,
       {rnd('mean', 1)} AS avg_temp_c, {rnd('lowest', 1)} AS coldest_temp_c,
       total_freezing_hours, total_extreme_cold_hours
FROM (SELECT {region_of_station('stationname')} AS climate_region, avg(temp) AS mean, min(temp) AS lowest,
             count(*) FILTER (temp < 0) AS total_freezing_hours, count(*) FILTER (temp < -5) AS total_extreme_cold_hours
      FROM weather_hourly WHERE temp IS NOT NULL GROUP BY 1) w
LEFT JOIN (SELECT {region_of_area('left(postcode, 2)')} AS region,
                  sum(aantal) FILTER (brandstof = 'E') AS evs, sum(aantal) AS total
           FROM vehicles_by_postcode WHERE voertuigsoort = 'Personenauto' GROUP BY 1) e ON region = climate_region""",
    "fleet_summary": f"""
SELECT brand, count(*) AS total_vehicles, count(*) FILTER (status = 'LOW_BATTERY') AS low_battery_count,
       count(*) FILTER (status = 'CHARGING') AS charging_count,
       {rnd('avg(current_battery)', 1)} AS avg_battery, {rnd('avg(avg_speed_kmh)', 1)} AS avg_speed
FROM vehicle_status GROUP BY brand""",
    "page_offsets": "SELECT DISTINCT ((place - 1) // 1000 * 1000)::bigint AS page_offset FROM "
                    "(SELECT row_number() OVER () AS place FROM orders) o",
    "json_fields": "SELECT event_id, cast(json_extract_string(props, '$.k') AS int) AS k FROM events",
    "late_json_field": "SELECT event_id, json_extract_string(props, '$.k') AS k, "
                       "json_extract_string(props, '$.new_field') AS new_field FROM events",
    "ingest_vehicles": "SELECT * FROM vehicles",
    "ingest_vehicles_fuel": "SELECT * FROM vehicles_fuel",
    "ingest_parking_address":
        "SELECT areaid, areamanagerid, parkingaddresstype, zipcode FROM parking_address WHERE parkingaddresstype = 'F'",
    "ingest_charging_capacity": "SELECT * FROM charging_capacity",
    "ingest_vehicles_by_postcode": "SELECT * FROM vehicles_by_postcode",
    "scan_weather": "SELECT time, stationname, temp, precip_hour FROM weather_hourly",
    "scan_emissions": "SELECT date, geo_id, variable, value FROM emissions",
    "row_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, {n}::bigint AS expected FROM {name}"
        for name, n in EXPECTED_ROWS.items()),
    "view_row_counts": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, NULL::bigint AS expected FROM {name}"
        for name in ("weather_yearly", "weather_monthly", "transport_emissions", "total_emissions",
                     "ev_weather_emissions", "regional_weather_ev")),
    "vehicle_count": "SELECT 'Count all vehicles' AS query, count(*) AS result FROM vehicles",
    "classified_count": "SELECT 'Join vehicles + fuel' AS query, count(*) AS result FROM vehicles_with_fuel",
    "telemetry_payload": "SELECT event_id, vin, battery_pct AS battery, latitude AS lat FROM telemetry",
    "plate_overlap": "SELECT count(DISTINCT v.kenteken) AS overlap_count FROM vehicles v "
                     "JOIN vehicles_fuel f ON f.kenteken = v.kenteken",
    "fuel_frequencies": "SELECT brandstof_omschrijving, count(*) AS count FROM vehicles_fuel GROUP BY ALL",
    "category_frequencies": "SELECT fuel_category, count(*) AS count FROM vehicles_with_fuel GROUP BY ALL",
    "recent_weather_count": "SELECT count(*) AS observation_count FROM weather_hourly WHERE year(time) >= 2020",
    "home_emissions_count": "SELECT count(*) AS emissions_records FROM emissions WHERE geo_id = 'country/NLD'",
    "weather_sample": """
SELECT time, stationname, temp AS temperature_celsius, rel_humidity AS humidity_pct, wind_speed AS wind_m_per_s,
       precip_hour AS precipitation_mm
FROM weather_hourly WHERE time >= TIMESTAMP '2020-01-01'
ORDER BY time, stationname, temp NULLS FIRST, rel_humidity, wind_speed, precip_hour NULLS FIRST LIMIT 10""",
    "weather_stations": "SELECT DISTINCT stationname FROM weather_hourly ORDER BY 1 LIMIT 20",
    "weather_station_positions": "SELECT DISTINCT stationname, lat, lon FROM weather_hourly ORDER BY 1, 2, 3 LIMIT 20",
    "weather_by_year": f"""
SELECT year(time)::int AS year, {rnd('avg(temp)', 1)} AS avg_temp_celsius, count(*) FILTER (temp < 0) AS freezing_hours,
       count(*) AS total_observations
FROM weather_hourly WHERE year(time) >= 2015 GROUP BY 1""",
    "coldest_stations": f"""
SELECT stationname, {rnd('avg(temp)', 1)} AS avg_temp, count(*) FILTER (temp < 0) AS freezing_hours,
       {rnd('avg(precip_hour)', 2)} AS avg_precip_mm
FROM weather_hourly WHERE year(time) >= 2020 GROUP BY 1 ORDER BY freezing_hours DESC, stationname LIMIT 10""",
    "emissions_series": """
SELECT year(date)::int AS year, variable_name, value AS emissions_tonnes, unit FROM emissions
WHERE geo_id = 'country/NLD' AND variable = 'transportation_co2_climate_watch' ORDER BY year DESC LIMIT 20""",
    "emissions_series_mt": f"""
SELECT year(date)::int AS year, {rnd('value / 1000000', 2)} AS transport_co2_mt FROM emissions
WHERE geo_id = 'country/NLD' AND variable = 'transportation_co2_climate_watch' ORDER BY year DESC LIMIT 15""",
    "emissions_by_year": f"""
SELECT year(date)::int AS year, {rnd('sum(value) / 1000000', 2)} AS emissions_mt_co2e FROM emissions
WHERE geo_id = 'country/NLD' AND variable = 'total_excluding_lulucf_co2_climate_watch' GROUP BY 1 ORDER BY 1 DESC LIMIT 10""",
    "category_year_mix": """
SELECT fuel_category, registration_year, vehicle_count,
       avg(vehicle_count) OVER (PARTITION BY fuel_category) AS avg_per_category,
       (sum(vehicle_count) OVER (PARTITION BY registration_year))::bigint AS total_that_year
FROM (SELECT fuel_category, registration_year, count(*) AS vehicle_count FROM vehicles_with_fuel
      WHERE registration_year >= 2020 GROUP BY ALL) c""",
    "top_regions": "SELECT * FROM ev_by_region ORDER BY ev_percentage DESC NULLS LAST, postal_area LIMIT 10",
    "top_charger_postcodes": "SELECT * FROM chargers_per_postcode ORDER BY aantal DESC NULLS LAST, postcode LIMIT 10",
    "top_infrastructure_gaps":
        "SELECT * FROM ev_infrastructure ORDER BY evs_per_charging_point DESC NULLS LAST, postal_area LIMIT 10",
    "first_fuel_postcodes": "SELECT * FROM fuel_per_postcode ORDER BY postcode, brandstof LIMIT 20",
    "fleet_metrics": f"""
SELECT 'Total Vehicles' AS metric, count(*)::varchar AS value FROM vehicle_status
UNION ALL SELECT 'Low Battery Alerts', count(*)::varchar FROM vehicle_status WHERE status = 'LOW_BATTERY'
UNION ALL SELECT 'Currently Charging', count(*)::varchar FROM vehicle_status WHERE status = 'CHARGING'
UNION ALL SELECT 'Average Battery %', {rnd('avg(current_battery)', 0)}::int::varchar FROM vehicle_status""",
    "vehicles_needing_attention":
        "SELECT vin, brand, current_battery, status FROM vehicle_status WHERE status <> 'ACTIVE'",
    "vehicles_low_battery":
        "SELECT vin, brand, current_battery, status FROM vehicle_status WHERE status = 'LOW_BATTERY'",
    "vehicles_last_seen": "SELECT * FROM vehicle_status ORDER BY last_seen DESC, vin LIMIT 20",
    "dashboard_kpis": f"""
SELECT sum(electric_vehicles)::bigint AS total_evs, sum(total_vehicles)::bigint AS total_vehicles,
       {pct('sum(electric_vehicles)', 'sum(total_vehicles)', 1)} AS ev_share, count(DISTINCT postal_area) AS regions,
       max(ev_percentage) AS top_region_pct
FROM ev_by_region""",
    "dashboard_charging_points": "SELECT coalesce(sum(total_charging_points), 0)::bigint AS points FROM charging_by_area",
    "dashboard_leading_areas": f"""
SELECT postal_area, ev_percentage, electric_vehicles, total_vehicles FROM ev_by_region
WHERE total_vehicles > {MIN_TOTAL_LARGE} ORDER BY ev_percentage DESC NULLS LAST, postal_area LIMIT 10""",
    "dashboard_top_five": f"""
SELECT postal_area, ev_percentage, electric_vehicles, total_vehicles FROM ev_by_region
WHERE total_vehicles > {MIN_TOTAL_LARGE} ORDER BY ev_percentage DESC NULLS LAST, postal_area LIMIT 5""",
    "dashboard_named_areas": f"SELECT postal_area, {named('postal_area')} AS region_name, ev_percentage FROM ev_by_region",
    "dashboard_adoption_and_chargers": "SELECT * FROM adoption_and_chargers",
    "dashboard_charger_pressure": f"""
SELECT {rnd('avg(evs_per_charging_point)', 2)} AS avg_evs_per_charger,
       first(region_name ORDER BY evs_per_charging_point DESC, electric_vehicles DESC, postal_area) AS most_underserved,
       max(evs_per_charging_point) AS most_underserved_ratio,
       first(electric_vehicles ORDER BY evs_per_charging_point DESC, electric_vehicles DESC, postal_area)
           AS most_underserved_evs,
       first(charging_points ORDER BY evs_per_charging_point DESC, electric_vehicles DESC, postal_area)
           AS most_underserved_points,
       first(region_name ORDER BY evs_per_charging_point, electric_vehicles DESC, postal_area) AS best_served,
       min(evs_per_charging_point) AS best_served_ratio
FROM adoption_and_chargers""",
    "dashboard_infrastructure_gaps": f"""
SELECT {named('postal_area')} AS region_name, electric_vehicles, charging_points, ev_percentage, evs_per_charging_point
FROM equipped ORDER BY evs_per_charging_point DESC, postal_area LIMIT 20""",
    "dashboard_share_by_year": "SELECT registration_year, ev_share_percent FROM ev_yoy_growth WHERE registration_year >= 2015",
    "dashboard_share_change": f"""
SELECT registration_year, coalesce(ev_share_percent, 0) AS ev_share_percent,
       {rnd('coalesce(ev_share_percent, 0) - lag(coalesce(ev_share_percent, 0)) OVER (ORDER BY registration_year)', 2)} AS change_pp
FROM ev_yoy_growth WHERE registration_year >= 2020""",
    "dashboard_peak_growth": """
SELECT registration_year, yoy_growth_percent FROM ev_yoy_growth WHERE yoy_growth_percent IS NOT NULL
ORDER BY yoy_growth_percent DESC, registration_year LIMIT 1""",
    "dashboard_leader_and_gap": f"""
(SELECT 'top_region' AS insight, {named('postal_area')} AS region_name, electric_vehicles, ev_percentage AS value
 FROM ev_by_region ORDER BY ev_percentage DESC NULLS LAST, postal_area LIMIT 1)
UNION ALL
(SELECT 'infrastructure_gap', {named('postal_area')}, electric_vehicles, evs_per_charging_point
 FROM equipped ORDER BY evs_per_charging_point DESC, postal_area LIMIT 1)""",
    "dashboard_climate_hypothesis": """
SELECT *, top_region = mildest_region AS hypothesis_confirmed
FROM (SELECT first(region ORDER BY ev_share_pct DESC NULLS LAST, region) AS top_region,
             max(ev_share_pct) AS top_share_pct,
             first(region ORDER BY total_freezing_hours, ev_share_pct DESC NULLS LAST, region) AS mildest_region,
             min(total_freezing_hours) AS mildest_freezing_hours,
             first(region ORDER BY total_freezing_hours DESC, ev_share_pct DESC NULLS LAST, region) AS harshest_region,
             max(total_freezing_hours) AS harshest_freezing_hours
      FROM regional_weather_ev) r""",
    "dashboard_emissions_reduction": f"""
SELECT peak_year, peak_mt, latest_year, latest_mt, {pct('(peak_mt - latest_mt)', 'peak_mt', 1)} AS reduction_pct
FROM (SELECT year AS peak_year, transport_co2_mt AS peak_mt FROM transport_emissions
      ORDER BY transport_co2_mt DESC, year LIMIT 1) p,
     (SELECT year AS latest_year, transport_co2_mt AS latest_mt FROM transport_emissions
      WHERE year = (SELECT max(year) FROM transport_emissions)) l""",
    "dashboard_monthly_pattern": """
SELECT month AS month_num, strftime(make_date(2000, month, 1), '%m-%b') AS month, avg_temp_c, pct_freezing, avg_monthly_precip_mm
FROM weather_monthly wm""",
    "dashboard_fuel_shares": f"""
SELECT postal_area, {pct('electric_vehicles', 'total_vehicles', 1)} AS electric_pct,
       {pct('petrol_vehicles', 'total_vehicles', 1)} AS petrol_pct, {pct('diesel_vehicles', 'total_vehicles', 1)} AS diesel_pct,
       {named('postal_area')} AS region_name
FROM ev_by_region WHERE total_vehicles > {MIN_TOTAL} ORDER BY electric_vehicles DESC, postal_area LIMIT 12""",
    "dashboard_fuel_totals": f"""
SELECT *, {pct('electric', 'total', 1)} AS electric_pct, {pct('petrol', 'total', 1)} AS petrol_pct,
       {pct('diesel', 'total', 1)} AS diesel_pct
FROM (SELECT sum(electric_vehicles)::bigint AS electric, sum(petrol_vehicles)::bigint AS petrol,
             sum(diesel_vehicles)::bigint AS diesel, sum(total_vehicles)::bigint AS total FROM ev_by_region) s""",
    "dashboard_emissions_trend": """
SELECT 'transport' AS series, year, transport_co2_mt AS mt FROM transport_emissions
UNION ALL SELECT 'total', year, total_co2_mt FROM total_emissions""",
    "dashboard_fleet_kpis": f"""
SELECT *, 100 - low_battery::double / nullif(total, 0)::double * 100 AS health_score
FROM (SELECT count(*) AS total, count(*) FILTER (status = 'LOW_BATTERY') AS low_battery,
             count(*) FILTER (status = 'CHARGING') AS charging, {rnd('avg(current_battery)', 0)} AS avg_battery
      FROM vehicle_status) s""",
    "dashboard_brand_shares": f"""
SELECT brand, total_vehicles, {pct('low_battery_count', 'greatest(total_vehicles, 1)', 1)} AS low_battery_pct,
       {pct('charging_count', 'greatest(total_vehicles, 1)', 1)} AS charging_pct FROM fleet_alerts""",
    "dashboard_vehicle_list": """
SELECT vin, brand, current_battery, status, strftime(last_seen, '%Y-%m-%d %H:%M') AS last_seen FROM vehicle_status
ORDER BY list_position(['LOW_BATTERY', 'CHARGING', 'ACTIVE'], status), current_battery, vin LIMIT 20""",
    "dashboard_alert_rows": """
SELECT brand, 'low_battery' AS alert, low_battery_count AS vehicles FROM fleet_alerts WHERE low_battery_count > 0
UNION ALL SELECT brand, 'charging', charging_count FROM fleet_alerts WHERE charging_count > 0""",
    "null_counts": " UNION ALL ".join(
        f"SELECT 'weather_hourly' AS table_name, '{name}' AS column_name, 'null_count' AS metric, "
        f"count(*) - count({name}) AS value FROM weather_hourly" for name in ("time", "stationname", "temp", "precip_hour")),
    "visible_rows": "SELECT * FROM fuel_per_postcode WHERE left(postcode, 2) IN "
                    "(SELECT allowed_region FROM permissions WHERE principal = 'dealer3')",
    "masked_plates": "SELECT * REPLACE ('****' AS kenteken) FROM vehicles_with_fuel",
    "unmasked_plates": "SELECT * FROM vehicles_with_fuel",
    "dealer_extract": f"""
SELECT *, map {{'Noord': 'north', 'Zuid': 'south'}}[{region_of_area('postal_area')}] AS dealer_group
FROM ev_infrastructure WHERE {region_of_area('postal_area')} IN ('Noord', 'Zuid')""",
    "manufacturer_extract": """
SELECT fuel_category, sum(vehicle_count)::bigint AS vehicle_count, sum(ev_hybrid_count)::bigint AS ev_hybrid_count
FROM ev_growth_trends GROUP BY 1""",
    "recent_activity": f"""
SELECT query_id, user_name, role_name, warehouse_name, query_type, execution_status,
       total_elapsed_time::double / 1000 AS seconds, query_text
FROM query_log WHERE database_name = 'VOLT_MODELS' AND start_time > {AS_OF} - INTERVAL 1 HOUR
ORDER BY start_time DESC, query_id DESC LIMIT 10""",
    "usage_by_resource": f"""
SELECT warehouse_name, sum(credits_used)::double AS total_credits, count(*) AS query_count,
       {rnd('sum(credits_used)::double / count(*)', 4)} AS credits_per_query
FROM usage_log WHERE start_time > {AS_OF} - INTERVAL 7 DAY GROUP BY 1""",
    "budget_use": f"""
SELECT date_trunc('month', start_time)::date AS month, sum(credits_used)::double AS credits_used,
       {QUOTA}::double AS credit_quota, {QUOTA}::double - sum(credits_used)::double AS credits_remaining,
       {pct('sum(credits_used)', str(QUOTA), 2)} AS pct_used
FROM usage_log GROUP BY 1""",
    "budget_crossings": f"""
SELECT month, threshold_pct, min(start_time) AS first_crossed
FROM month_spend, (VALUES (50), (75), (90), (100), (110)) th(threshold_pct)
WHERE spent >= {QUOTA} * threshold_pct / 100 GROUP BY ALL""",
    "freshness": f"""
SELECT model, target_lag_seconds, last_refresh, date_sub('second', last_refresh, {END_OF_EVENTS}) AS lag_seconds,
       coalesce(date_sub('second', last_refresh, {END_OF_EVENTS}) > target_lag_seconds, true) AS is_late
FROM targets LEFT JOIN (SELECT model, max(refreshed_at) AS last_refresh FROM refresh_log GROUP BY 1) r USING (model)""",
    "stream_vehicle_status": status_sql("TIMESTAMP '2024-01-31 00:10:30'"),
}
READS |= {f"stream_{name}": READS[name] for name in (
    "ev_by_region", "charging_by_area", "ev_growth_trends", "fuel_per_postcode", "fuel_per_month",
    "chargers_per_postcode", "null_counts")}
READS["published_groups"] = READS["dealer_extract"]
READS["published_models"] = " UNION ALL ".join(
    f"SELECT '{model}' AS table_name, count(*) AS row_count FROM {cte}" for model, cte in (
        ("ev_growth_trends", "ev_growth_trends"), ("ev_yoy_growth", "ev_yoy_growth"),
        ("ev_infrastructure_correlation", "ev_infrastructure")))
READS["full_refresh"] = " UNION ALL ".join(
    f"SELECT '{model}' AS table_name, count(*) AS row_count FROM {cte}" for model, cte in (
        ("ev_by_region", "ev_by_region"), ("charging_by_area", "charging_by_area"),
        ("vehicles_with_fuel", "vehicles_with_fuel"), ("national_ev_summary", "national_ev_summary"),
        ("ev_growth_trends", "ev_growth_trends"), ("ev_yoy_growth", "ev_yoy_growth"),
        ("brandstof_per_postcode_datum", "fuel_per_month"), ("laadpalen_per_postcode", "chargers_per_postcode"),
        ("brandstof_per_postcode", "fuel_per_postcode"), ("ev_infrastructure_correlation", "ev_infrastructure"),
        ("nl_weather_yearly", "weather_yearly"), ("nl_monthly_weather", "weather_monthly"),
        ("nl_transport_emissions", "transport_emissions"), ("nl_total_emissions", "total_emissions"),
        ("regional_weather_ev_correlation", "regional_weather_ev"), ("ev_weather_emissions", "ev_weather_emissions"),
        ("vehicle_status", "vehicle_status"), ("fleet_alerts", "fleet_alerts")))
READS["stream_national_summary"] = READS["national_ev_summary"]


# Models over corrected loads: the same definitions over the corrected tables.


def over(text: str, **instead: str) -> str:
    for name, other in instead.items():
        text = re.sub(rf"\b{name}\b", other, text)
    return text


CTES["corrected_regions"] = over(CTES["ev_by_region"], vehicles_by_postcode="vehicles_by_postcode_corrected")
CTES["corrected_classes"] = over(CTES["vehicles_with_fuel"], vehicles_fuel="vehicles_fuel_corrected")
CTES["corrected_years"] = over(CTES["yearly"], vehicles_with_fuel="corrected_classes")
READS |= {
    "corrected_ev_by_region": "SELECT * FROM corrected_regions",
    "corrected_national_summary": over(CTES["national_ev_summary"], ev_by_region="corrected_regions"),
    "corrected_yoy_growth": over(CTES["ev_yoy_growth"], yearly="corrected_years"),
    "corrected_fuel_per_month": over(CTES["fuel_per_month"], vehicles_fuel="vehicles_fuel_corrected"),
    "replaced_load": "SELECT * FROM vehicles_by_postcode UNION ALL SELECT * FROM vehicles_by_postcode_corrected",
    "refreshed_infrastructure": READS["ev_infrastructure"], "published_infrastructure": READS["ev_infrastructure"],
    "refreshed_weather_emissions": READS["ev_weather_emissions"],
}

READS["visible_folders"], READS["weather_by_month_folders"] = READS["visible_rows"], READS["weather_monthly"]
READS["stream_windowed_status"] = READS["stream_vehicle_status"]
READS["observed_null_counts"] = READS["null_counts"] + """
UNION ALL SELECT 'weather_hourly', NULL, 'row_count', count(*) FROM weather_hourly"""
READS["field_inventory"] = """
SELECT load_id, field, kind, count(*) AS n_records, load_id = min(load_id) OVER (PARTITION BY field) AS is_new
FROM (SELECT load_id, field, CASE json_type(record::JSON, '$.' || field)
        WHEN 'NULL' THEN 'null' WHEN 'VARCHAR' THEN 'text' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'UBIGINT' THEN 'integer'
        WHEN 'BIGINT' THEN 'integer' WHEN 'DOUBLE' THEN 'decimal' WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' END AS kind
      FROM (SELECT load_id, record, unnest(json_keys(record::JSON)) AS field FROM event_records) k) f
GROUP BY load_id, field, kind"""

READS["paged_fetch"] = READS["paged_fetch_ordered"] = "SELECT * FROM charging_capacity WHERE areaid::int // 200 <> 1"
READS["paged_failures"] = "SELECT 'capacity' AS dataset, 1::int AS part, 200::bigint AS page_offset"
READS["stream_growing_pages"] = "SELECT * FROM charging_capacity"


def _needed(text: str) -> list[str]:
    """Names of the common tables a text reads, each after the ones it reads itself."""
    ordered: list[str] = []
    for name in CTES:
        if re.search(rf"\b{name}\b", text):
            for inner in _needed(CTES[name].replace(f"AS {name}", "")) if name not in VIEWS else []:
                if inner not in ordered and inner != name:
                    ordered.append(inner)
            if name not in ordered:
                ordered.append(name)
    return ordered


def oracle_sql() -> dict[str, str]:
    given = {table: table for table in TABLES}
    texts = {}
    for name, read in READS.items():
        parts = [
            f"{cte} AS ({CTES[cte].format(**given) if cte in VIEWS else CTES[cte]})" for cte in _needed(read)
        ]
        texts[name] = (f"WITH {', '.join(parts)} " if parts else "") + read.strip()
    return texts
