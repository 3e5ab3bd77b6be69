"""One runnable query per operator, over the whole of the given tables.

The models' absolute thresholds do not fit every scale of the given tables, so
the checks pass their own; the defaults in the library are the real ones.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.inputs import AS_OF, Inputs
from voltatlas.functions import since_year
from voltatlas.operators import access, adoption, climate, curated, fleet, quality, usage
from voltatlas.operators.climate import HOME_COUNTRY, TOTAL_CO2, TRANSPORT_CO2
from voltatlas.plans import dashboard, explore, refresh
from voltatlas.session import work_folder
from voltatlas.sources import landing, versions
from voltatlas.sources.lake import Lake, read_weather, write_weather
from voltatlas.sources.paged import read_pages, stream_pages
from voltatlas.sources.schemas import RAW_TABLES
from voltatlas.streaming import incremental, windows
from voltatlas.streaming import fleet as fleet_stream
from voltatlas.streaming import quality as quality_stream
from voltatlas.streaming.sink import put_batch, read_batches, run

Query = Callable[[SparkSession, str], DataFrame]

MIN_TOTAL = 7000
MIN_TOTAL_LARGE = 8000
QUOTA = 4000
END_OF_EVENTS = datetime(2024, 1, 31)
AFTER_EVENTS = datetime(2024, 1, 31, 0, 10, 30)

_QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Callable[[Inputs], DataFrame]], Callable[[Inputs], DataFrame]]:
    def register(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        _QUERIES[name] = lambda spark, folder: build(Inputs(spark, folder))
        return build

    return register


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- models the other queries read -------------------------------------------------


def regions(t: Inputs) -> DataFrame:
    return curated.ev_by_region(t.vehicles_by_postcode)


def classified(t: Inputs) -> DataFrame:
    return curated.vehicles_with_fuel(t.vehicles_fuel)


def growth(t: Inputs) -> DataFrame:
    return adoption.ev_yoy_growth(classified(t))


def chargers(t: Inputs) -> DataFrame:
    return adoption.chargers_per_postcode(t.parking_address_raw, t.charging_capacity)


def infrastructure(t: Inputs, min_total: int = MIN_TOTAL) -> DataFrame:
    return adoption.ev_infrastructure(regions(t), chargers(t), min_total)


def transport(t: Inputs) -> DataFrame:
    return climate.transport_emissions(t.emissions)


def status(t: Inputs) -> DataFrame:
    return fleet.vehicle_status(t.telemetry, AS_OF, tie_break="event_id")


def alerts(t: Inputs) -> DataFrame:
    return fleet.fleet_alerts(status(t))


# --- curated and analytics models --------------------------------------------------

query("ev_by_region")(regions)
query("charging_by_area")(lambda t: curated.charging_by_area(t.charging_capacity))
query("vehicles_with_fuel")(classified)
query("national_ev_summary")(lambda t: adoption.national_ev_summary(regions(t), MIN_TOTAL))
query("ev_growth_trends")(lambda t: adoption.ev_growth_trends(classified(t)))
query("ev_yoy_growth")(growth)
query("fuel_per_month")(lambda t: adoption.fuel_per_month(t.vehicles, t.vehicles_fuel))
query("chargers_per_postcode")(chargers)
query("fuel_per_postcode")(lambda t: adoption.fuel_per_postcode(t.vehicles_by_postcode))
query("ev_infrastructure")(infrastructure)
query("weather_yearly")(lambda t: climate.weather_yearly(t.weather_hourly))
query("weather_monthly")(lambda t: climate.weather_monthly(t.weather_hourly))
query("transport_emissions")(transport)
query("total_emissions")(lambda t: climate.total_emissions(t.emissions))
query("regional_weather_ev")(lambda t: climate.regional_weather_ev(t.weather_hourly, regions(t)))
query("regional_climate_extremes")(
    lambda t: climate.regional_climate_extremes(t.weather_hourly, t.vehicles_by_postcode))
query("ev_weather_emissions")(
    lambda t: climate.ev_weather_emissions(growth(t), climate.weather_yearly(t.weather_hourly), transport(t)))
query("vehicle_status")(status)
query("fleet_alerts")(alerts)
query("fleet_summary")(lambda t: fleet.fleet_summary(status(t)))

# --- ingestion ---------------------------------------------------------------------

query("page_offsets")(lambda t: landing.offsets_covering(t.given("orders")))
query("json_fields")(lambda t: t.given("events").select(
    "event_id", landing.field(F.parse_json("props"), "k", "int").alias("k")))
query("late_json_field")(lambda t: t.given("events").select(
    "event_id",
    landing.late_field(F.parse_json("props"), "k").alias("k"),
    landing.late_field(F.parse_json("props"), "new_field").alias("new_field")))

query("telemetry_payload")(lambda t: t.telemetry.select("event_id", landing.telemetry_payload().alias("raw_json")).select(
    "event_id",
    landing.field(F.col("raw_json"), "vin").alias("vin"),
    landing.field(F.col("raw_json"), "battery", "int").alias("battery"),
    landing.field(F.col("raw_json"), "location.lat", "double").alias("lat")))


def ingested(t: Inputs, view: str, table: str) -> DataFrame:
    return landing.rows_of(t.pages(view), table).drop("raw_json")


query("ingest_vehicles")(lambda t: ingested(t, "vehicles", "vehicles_raw"))
query("ingest_vehicles_fuel")(lambda t: ingested(t, "vehicles_fuel", "vehicles_fuel_raw"))
query("ingest_parking_address")(lambda t: ingested(t, "parking_address", "parking_address_raw"))
query("ingest_charging_capacity")(lambda t: ingested(t, "charging_capacity", "charging_capacity_raw"))
query("ingest_vehicles_by_postcode")(lambda t: ingested(t, "vehicles_by_postcode", "vehicles_by_postcode_raw"))
query("scan_weather")(lambda t: t.weather_hourly.select("time", "stationname", "temp", "precip_hour"))
query("scan_emissions")(lambda t: t.emissions.select("date", "geo_id", "variable", "value"))

# --- exploration and verification ----------------------------------------------------

# Expected rows of the raw tables.
EXPECTED_ROWS = {"vehicles_by_postcode": 46645, "charging_capacity": 3139, "vehicles_fuel": 50000,
                 "parking_address": 3382, "vehicles": 50000}

query("row_counts")(lambda t: explore.row_counts({name: t.view(name) for name in EXPECTED_ROWS}, EXPECTED_ROWS))


@query("view_row_counts")
def view_row_counts(t: Inputs) -> DataFrame:
    yearly = climate.weather_yearly(t.weather_hourly)
    return explore.row_counts({
        "weather_yearly": yearly,
        "weather_monthly": climate.weather_monthly(t.weather_hourly),
        "transport_emissions": transport(t),
        "total_emissions": climate.total_emissions(t.emissions),
        "ev_weather_emissions": climate.ev_weather_emissions(growth(t), yearly, transport(t)),
        "regional_weather_ev": climate.regional_weather_ev(t.weather_hourly, regions(t)),
    })


query("vehicle_count")(lambda t: explore.labelled_count(t.vehicles, "Count all vehicles"))
query("classified_count")(lambda t: explore.labelled_count(classified(t), "Join vehicles + fuel"))
query("plate_overlap")(lambda t: explore.key_overlap(t.vehicles, t.vehicles_fuel, "kenteken"))
query("fuel_frequencies")(lambda t: explore.frequencies(t.vehicles_fuel, "brandstof_omschrijving"))
query("category_frequencies")(lambda t: explore.frequencies(classified(t), "fuel_category"))
query("recent_weather_count")(lambda t: explore.filtered_count(
    t.weather_hourly, since_year(F.col("time"), 2020), "observation_count"))
query("home_emissions_count")(lambda t: explore.filtered_count(
    t.emissions, F.col("geo_id") == HOME_COUNTRY, "emissions_records"))
query("weather_sample")(lambda t: explore.weather_sample(t.weather_hourly, 2020))
query("weather_stations")(lambda t: explore.stations(t.weather_hourly))
query("weather_station_positions")(lambda t: explore.stations(t.weather_hourly, with_position=True))
query("weather_by_year")(lambda t: explore.weather_by_year(t.weather_hourly))
query("coldest_stations")(lambda t: explore.coldest_stations(t.weather_hourly))
query("emissions_series")(lambda t: explore.emissions_series(t.emissions, TRANSPORT_CO2))
query("emissions_series_mt")(lambda t: explore.emissions_series_mt(t.emissions, TRANSPORT_CO2))
query("emissions_by_year")(lambda t: explore.emissions_by_year(t.emissions, TOTAL_CO2))
query("category_year_mix")(lambda t: explore.category_year_mix(classified(t)))
query("top_regions")(lambda t: explore.top(regions(t), "ev_percentage", 10, "postal_area"))
query("top_charger_postcodes")(lambda t: explore.top(chargers(t), "aantal", 10, "postcode"))
query("top_infrastructure_gaps")(
    lambda t: explore.top(infrastructure(t), "evs_per_charging_point", 10, "postal_area"))
query("first_fuel_postcodes")(lambda t: adoption.fuel_per_postcode(t.vehicles_by_postcode).orderBy(
    "postcode", "brandstof").limit(20))
query("fleet_metrics")(lambda t: explore.fleet_metrics(status(t)))
query("vehicles_needing_attention")(lambda t: explore.needing_attention(status(t)))
query("vehicles_low_battery")(lambda t: explore.needing_attention(status(t), ("LOW_BATTERY",)))
query("vehicles_last_seen")(lambda t: explore.last_seen(status(t)))

# --- dashboard -------------------------------------------------------------------------

query("dashboard_kpis")(lambda t: dashboard.kpis(regions(t)))
query("dashboard_charging_points")(lambda t: dashboard.charging_points(curated.charging_by_area(t.charging_capacity)))
query("dashboard_leading_areas")(lambda t: dashboard.leading_areas(regions(t), MIN_TOTAL_LARGE))
query("dashboard_top_five")(lambda t: dashboard.leading_areas(regions(t), MIN_TOTAL_LARGE, 5))
query("dashboard_named_areas")(lambda t: dashboard.named_areas(regions(t)))
query("dashboard_adoption_and_chargers")(lambda t: dashboard.adoption_and_chargers(infrastructure(t)))
query("dashboard_charger_pressure")(lambda t: dashboard.charger_pressure(infrastructure(t)))
query("dashboard_infrastructure_gaps")(lambda t: dashboard.infrastructure_gaps(infrastructure(t)))
query("dashboard_share_by_year")(lambda t: dashboard.share_by_year(growth(t)))
query("dashboard_share_change")(lambda t: dashboard.share_change(growth(t)))
query("dashboard_peak_growth")(lambda t: dashboard.peak_growth(growth(t)))
query("dashboard_leader_and_gap")(lambda t: dashboard.leader_and_gap(regions(t), infrastructure(t)))
query("dashboard_climate_hypothesis")(
    lambda t: dashboard.climate_hypothesis(climate.regional_weather_ev(t.weather_hourly, regions(t))))
query("dashboard_emissions_reduction")(lambda t: dashboard.emissions_reduction(transport(t)))
query("dashboard_monthly_pattern")(lambda t: dashboard.monthly_pattern(climate.weather_monthly(t.weather_hourly)))
query("dashboard_fuel_shares")(lambda t: dashboard.fuel_shares(regions(t), MIN_TOTAL))
query("dashboard_fuel_totals")(lambda t: dashboard.fuel_totals(regions(t)))
query("dashboard_emissions_trend")(
    lambda t: dashboard.emissions_trend(transport(t), climate.total_emissions(t.emissions)))
query("dashboard_fleet_kpis")(lambda t: dashboard.fleet_kpis(status(t)))
query("dashboard_brand_shares")(lambda t: dashboard.brand_shares(alerts(t)))
query("dashboard_vehicle_list")(lambda t: dashboard.vehicle_list(status(t)))
query("dashboard_alert_rows")(lambda t: dashboard.alert_rows(alerts(t)))

# --- quality, access, usage ----------------------------------------------------------

WEATHER_CHECKED = ["time", "stationname", "temp", "precip_hour"]

query("null_counts")(lambda t: quality.null_counts(t.weather_hourly, "weather_hourly", WEATHER_CHECKED))
query("visible_rows")(lambda t: access.visible_rows(
    adoption.fuel_per_postcode(t.vehicles_by_postcode), F.left("postcode", F.lit(2)), t.permissions, "dealer3"))
@query("visible_folders")
def visible_folders(t: Inputs) -> DataFrame:
    """The same rows from a table kept in folders by region."""
    postcodes, folder = adoption.fuel_per_postcode(t.vehicles_by_postcode), work_folder(t.spark, "regions")
    access.write_by_region(postcodes, F.left("postcode", F.lit(2)), folder)
    kept = t.spark.read.schema(postcodes.schema.add(access.REGION, "string")).parquet(folder)
    return access.visible_in_folders(kept, t.permissions, "dealer3")


@query("weather_by_month_folders")
def weather_by_month_folders(t: Inputs) -> DataFrame:
    """The monthly pattern from weather kept in folders by month."""
    folder = work_folder(t.spark, "weather")
    write_weather(t.weather_hourly, folder)
    return climate.weather_monthly(read_weather(t.spark, folder))


query("masked_plates")(lambda t: access.masked(classified(t), "kenteken", is_admin=False))
query("unmasked_plates")(lambda t: access.masked(classified(t), "kenteken", is_admin=True))
query("dealer_extract")(lambda t: access.dealer_extract(infrastructure(t)))
query("manufacturer_extract")(lambda t: access.manufacturer_extract(adoption.ev_growth_trends(classified(t))))
query("recent_activity")(lambda t: usage.recent_activity(t.query_log, AS_OF, "VOLT_MODELS"))
query("usage_by_resource")(lambda t: usage.usage_by_resource(t.usage_log, AS_OF))
query("budget_use")(lambda t: usage.budget_use(t.usage_log, QUOTA))
query("budget_crossings")(lambda t: usage.budget_crossings(t.usage_log, QUOTA))
query("freshness")(lambda t: usage.freshness(t.refresh_log, t.targets(), END_OF_EVENTS))

# --- written tables --------------------------------------------------------------------


@query("full_refresh")
def full_refresh(t: Inputs) -> DataFrame:
    """Loads the raw tables, runs the full refresh and counts the rows of every written model."""
    lake = Lake(t.spark, work_folder(t.spark, "lake"))
    lake.create_missing()
    for table, df in t.raw_tables().items():
        lake.append(df, table)
    refresh.refresh_all(
        lake, {"weather_hourly": t.weather_hourly, "emissions": t.emissions},
        as_of=AS_OF, min_total_summary=MIN_TOTAL, min_total_infrastructure=MIN_TOTAL)
    return explore.row_counts({model.name: lake.read(model.layer, model.name) for model in refresh.MODELS}).drop("expected")


@query("published_models")
def published_models(t: Inputs) -> DataFrame:
    folder = work_folder(t.spark, "share")
    models = {"ev_growth_trends": adoption.ev_growth_trends(classified(t)), "ev_yoy_growth": growth(t),
              "ev_infrastructure_correlation": infrastructure(t), "vehicles_with_fuel": classified(t)}
    names = access.publish(models, folder)
    return explore.row_counts({name: versions.read(t.spark, f"{folder}/{name}") for name in names}).drop("expected")


@query("published_groups")
def published_groups(t: Inputs) -> DataFrame:
    folder = work_folder(t.spark, "dealers")
    extract = access.dealer_extract(infrastructure(t))
    access.publish_by_group(extract, folder)
    north, south = (versions.read(t.spark, f"{folder}/{group}") for group in access.DEALER_GROUPS.values())
    return north.unionByName(south)


# --- incremental refresh ---------------------------------------------------------------


def streamed(t: Inputs) -> Inputs:
    return Inputs(t.spark, t.folder, stream=True)


def summed(t: Inputs, view: str, name: str) -> DataFrame:
    work, model = work_folder(t.spark, name), incremental.SUM_MODELS[name]
    incremental.refresh_sums(
        streamed(t).view(view), model, f"{work}/state", f"{work}/checkpoint").awaitTermination()
    return incremental.read_sums(t.spark, model, f"{work}/state")


def joined(t: Inputs, left: DataFrame, right: DataFrame, name: str) -> DataFrame:
    work, model = work_folder(t.spark, name), incremental.JOIN_MODELS[name]
    incremental.refresh_join(left, right, model, f"{work}/state", f"{work}/checkpoint").awaitTermination()
    return incremental.read_join(t.spark, model, f"{work}/state")


query("stream_ev_by_region")(lambda t: summed(t, "vehicles_by_postcode", "ev_by_region"))
query("stream_charging_by_area")(lambda t: summed(t, "charging_capacity", "charging_by_area"))
query("stream_ev_growth_trends")(lambda t: summed(t, "vehicles_fuel", "ev_growth_trends"))
query("stream_fuel_per_postcode")(lambda t: summed(t, "vehicles_by_postcode", "brandstof_per_postcode"))
query("stream_fuel_per_month")(lambda t: joined(
    t, streamed(t).vehicles, streamed(t).vehicles_fuel, "brandstof_per_postcode_datum"))
query("stream_chargers_per_postcode")(lambda t: joined(
    t, streamed(t).parking_address_raw, streamed(t).charging_capacity, "laadpalen_per_postcode"))
query("stream_national_summary")(lambda t: adoption.national_ev_summary(
    summed(t, "vehicles_by_postcode", "ev_by_region"), MIN_TOTAL))


@query("stream_vehicle_status")
def stream_vehicle_status(t: Inputs) -> DataFrame:
    work = work_folder(t.spark, "vehicle_status")
    fleet_stream.refresh_status(
        streamed(t).telemetry, f"{work}/state", f"{work}/checkpoint", tie_break="event_id").awaitTermination()
    return fleet_stream.current_status(t.spark, f"{work}/state", AFTER_EVENTS, t.telemetry, tie_break="event_id")


@query("stream_windowed_status")
def stream_windowed_status(t: Inputs) -> DataFrame:
    """The same status from Spark's windowed state behind a watermark."""
    work = work_folder(t.spark, "windowed_status")
    windows.refresh_windows(
        streamed(t).telemetry, f"{work}/state", f"{work}/checkpoint", lateness="60 days", tie_break="event_id").awaitTermination()
    return windows.windowed_status(t.spark, f"{work}/state", AFTER_EVENTS, t.telemetry, tie_break="event_id")


@query("stream_null_counts")
def stream_null_counts(t: Inputs) -> DataFrame:
    """Metric history added up over the batches, so the result does not depend on how files fell into batches."""
    work = work_folder(t.spark, "null_counts")
    quality_stream.record_null_counts(
        streamed(t).weather_hourly, "weather_hourly", WEATHER_CHECKED, f"{work}/history", f"{work}/checkpoint",
    ).awaitTermination()
    return read_batches(t.spark, f"{work}/history").groupBy("table_name", "column_name", "metric").agg(
        F.sum("value").alias("value"))


# --- corrected loads ---------------------------------------------------------------------


def after_correction(t: Inputs, name: str, table: str, view: str) -> tuple[str, dict]:
    """Refreshes a sum model from a load, replaces the load by its corrected form, and refreshes it from what has changed."""
    work, model = work_folder(t.spark, f"corrected-{name}"), incremental.SUM_MODELS[name]
    lake = Lake(t.spark, f"{work}/lake")
    above = {key: counted for key, counted in {
        **incremental.COUNTED_MODELS, "national_ev_summary": incremental.national_model(MIN_TOTAL)}.items() if counted.source == name}
    for source in (view, f"{view}_corrected"):
        lake.put_load(t.raw(source), table, "all")
        incremental.refresh_sums(
            lake.stream(table), model, f"{work}/state", f"{work}/checkpoint", counted_models=above).awaitTermination()
    return f"{work}/state", above


@query("corrected_ev_by_region")
def corrected_ev_by_region(t: Inputs) -> DataFrame:
    state, _ = after_correction(t, "ev_by_region", "vehicles_by_postcode_raw", "vehicles_by_postcode")
    return incremental.read_sums(t.spark, incremental.SUM_MODELS["ev_by_region"], state)


@query("corrected_national_summary")
def corrected_national_summary(t: Inputs) -> DataFrame:
    state, above = after_correction(t, "ev_by_region", "vehicles_by_postcode_raw", "vehicles_by_postcode")
    return incremental.read_counted(t.spark, state, "national_ev_summary", above["national_ev_summary"])


@query("corrected_yoy_growth")
def corrected_yoy_growth(t: Inputs) -> DataFrame:
    state, above = after_correction(t, "ev_growth_trends", "vehicles_fuel_raw", "vehicles_fuel")
    return incremental.read_counted(t.spark, state, "ev_yoy_growth", above["ev_yoy_growth"])


@query("corrected_fuel_per_month")
def corrected_fuel_per_month(t: Inputs) -> DataFrame:
    """The join of two loads after one of them was replaced: only the pairs that change are joined again."""
    work, model = work_folder(t.spark, "corrected-join"), incremental.JOIN_MODELS["brandstof_per_postcode_datum"]
    lake = Lake(t.spark, f"{work}/lake")
    lake.put_load(t.raw("vehicles"), "vehicles_raw", "all")
    for source in ("vehicles_fuel", "vehicles_fuel_corrected"):
        lake.put_load(t.raw(source), "vehicles_fuel_raw", "all")
        incremental.refresh_join(lake.stream("vehicles_raw"), lake.stream("vehicles_fuel_raw"), model, f"{work}/state",
                                 f"{work}/checkpoint").awaitTermination()
    return incremental.read_join(t.spark, model, f"{work}/state")


@query("replaced_load")
def replaced_load(t: Inputs) -> DataFrame:
    """Contents of a raw table after a load was appended, another put in, and that one replaced."""
    lake, table = Lake(t.spark, work_folder(t.spark, "replaced")), "vehicles_by_postcode_raw"
    lake.create_missing({table: RAW_TABLES[table]})
    lake.append(t.raw("vehicles_by_postcode"), table)
    for source in ("vehicles_by_postcode", "vehicles_by_postcode_corrected"):
        lake.put_load(t.raw(source), table, "again")
    return lake.read("raw", table).drop("raw_json")


def refreshed(t: Inputs) -> Lake:
    """A lake after the loads and a full refresh."""
    lake = Lake(t.spark, work_folder(t.spark, "lake"))
    for table, df in t.raw_tables().items():
        lake.append(df, table)
    refresh.refresh_all(
        lake, {"weather_hourly": t.weather_hourly, "emissions": t.emissions},
        as_of=AS_OF, min_total_summary=MIN_TOTAL, min_total_infrastructure=MIN_TOTAL)
    return lake


query("refreshed_infrastructure")(lambda t: refreshed(t).read("analytics", "ev_infrastructure_correlation"))
query("refreshed_weather_emissions")(lambda t: refreshed(t).read("analytics", "ev_weather_emissions"))


@query("published_infrastructure")
def published_infrastructure(t: Inputs) -> DataFrame:
    """Contents of a published model."""
    folder = work_folder(t.spark, "share")
    access.publish({"ev_growth_trends": adoption.ev_growth_trends(classified(t)), "ev_yoy_growth": growth(t),
                    "ev_infrastructure_correlation": infrastructure(t)}, folder)
    return versions.read(t.spark, f"{folder}/ev_infrastructure_correlation")


# --- metrics while writing, fields of raw records ----------------------------------------


@query("observed_null_counts")
def observed_null_counts(t: Inputs) -> DataFrame:
    """Metrics taken while the rows are written, added up over the batches."""
    work = work_folder(t.spark, "observed")
    quality_stream.write_observed(
        streamed(t).weather_hourly, "weather_hourly", WEATHER_CHECKED, f"{work}/rows", f"{work}/history", f"{work}/checkpoint",
    ).awaitTermination()
    return read_batches(t.spark, f"{work}/history").groupBy("table_name", "column_name", "metric").agg(
        F.sum("value").alias("value"))


def event_records(t: Inputs) -> DataFrame:
    return t.event_records.select("load_id", F.parse_json("record").alias("raw_json"))


query("field_inventory")(lambda t: landing.field_inventory(event_records(t), "load_id"))


# --- fetched pages -------------------------------------------------------------------------


def plain_path(folder: str) -> str:
    """A folder of the shared file system as Python opens it."""
    return folder.removeprefix("file://").removeprefix("file:")


def write_pages(pages: DataFrame, folder: str, name: str) -> None:
    """Pages (page_offset, body) as files ``<name>-<offset>.json``, written where they are made."""

    def task(rows) -> None:
        os.makedirs(folder, exist_ok=True)
        for row in rows:
            with open(f"{folder}/{name}-{row.page_offset}.json", "w", encoding="utf-8") as file:
                file.write(row.body)

    pages.foreachPartition(task)


PAGE = 200


def capacity_pages(t: Inputs) -> DataFrame:
    """Pages in the order of the area's number."""
    records = t.charging_capacity.select(
        (F.floor(F.col("areaid").cast("int") / PAGE) * PAGE).alias("page_offset"), F.to_json(F.struct("*")).alias("record"))
    return records.groupBy("page_offset").agg(
        F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list("record")), ","), F.lit("]")).alias("body"))


def fetched(t: Inputs, order: str) -> DataFrame:
    """Pages through the data source; the second one is missing."""
    folder = plain_path(work_folder(t.spark, "pages"))
    pages = capacity_pages(t)
    write_pages(pages.where(f"page_offset <> {PAGE}"), f"{folder}/capacity", order or "default")
    last = pages.agg(F.max("page_offset")).first()[0]
    return read_pages(t.spark, "capacity", base=folder, limit=PAGE, pages=last // PAGE + 1, on_error="report", **(
        {"order": order} if order else {}))


query("paged_fetch")(lambda t: landing.rows_of(fetched(t, ""), "charging_capacity_raw").drop("raw_json"))
query("paged_fetch_ordered")(lambda t: landing.rows_of(fetched(t, "areaid"), "charging_capacity_raw").drop("raw_json"))
query("paged_failures")(lambda t: landing.failed_pages(fetched(t, "areaid")).select("dataset", "part", "page_offset"))


@query("stream_growing_pages")
def stream_growing_pages(t: Inputs) -> DataFrame:
    """A dataset that grows between two runs of the stream: each record arrives once."""
    work = work_folder(t.spark, "growing")
    base = plain_path(work)
    for keys in ("areaid < '5'", "areaid >= '5'"):
        found = t.charging_capacity.where(keys).select(
            F.floor(F.col("areaid").cast("int") / PAGE).alias("page_offset"), F.to_json(F.struct("*")).alias("record"))
        write_pages(found.groupBy("page_offset").agg(
            F.concat(F.lit("["), F.array_join(F.collect_list("record"), ","), F.lit("]")).alias("body")), f"{base}/capacity", keys[7])
        pages = stream_pages(t.spark, "capacity", base=base, limit=PAGE, key="areaid", splits="2,4,7")
        run(pages, lambda batch, batch_id: put_batch(
            landing.rows_of(batch, "charging_capacity_raw").drop("raw_json"), f"{work}/rows", batch_id),
            f"{work}/checkpoint").awaitTermination()
    return read_batches(t.spark, f"{work}/rows").drop("batch_id")
