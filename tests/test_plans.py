"""Physical plans: what must reach the scan and what must not appear."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from checks.inputs import Inputs
from tests.conftest import GIVEN, rows
from voltatlas.operators import access, adoption, climate, curated, fleet
from voltatlas.plans import explore
from voltatlas.sources.lake import read_weather, write_weather

FOLDER = f"{GIVEN}/sf0.001"
BATCH = sorted(name for name in queries() if not name.startswith("stream_"))


def plan(df, mode: str = "formatted") -> str:
    return df.sparkSession.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """The raw tables as files, as the jobs find them in production."""
    folder, given = tmp_path_factory.mktemp("raw"), Inputs(spark, FOLDER)
    tables = {}
    for name in ("vehicles_by_postcode", "vehicles", "vehicles_fuel", "weather_hourly", "emissions", "telemetry",
                 "charging_capacity", "parking_address_raw"):
        getattr(given, name).write.parquet(str(folder / name))
        tables[name] = spark.read.parquet(str(folder / name))
    return tables


@pytest.mark.parametrize("name", BATCH)
def test_no_pairwise_joins_and_no_python(spark, name):
    text = plan(queries()[name](spark, FOLDER))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert bad not in text


def scan(df) -> str:
    text = plan(df)
    return "\n".join(line for line in text.splitlines() if line.startswith(("PushedFilters", "ReadSchema")))


def test_filters_and_columns_reach_the_scan(stored):
    regions = scan(curated.ev_by_region(stored["vehicles_by_postcode"]))
    assert "EqualTo(voertuigsoort,Personenauto)" in regions
    assert "struct<postcode:string,voertuigsoort:string,brandstof:string,extern_oplaadbaar:string,aantal:int>" in regions
    monthly = scan(climate.weather_monthly(stored["weather_hourly"]))
    assert "GreaterThanOrEqual(time,2020-01-01T00:00)" in monthly
    assert "ReadSchema: struct<time:timestamp_ntz,temp:double,precip_hour:double>" in monthly
    assert "struct<time:timestamp_ntz>" in scan(
        explore.filtered_count(stored["weather_hourly"], F.col("time") >= F.lit("2020-01-01").cast("timestamp_ntz"), "n"))
    emissions = scan(climate.transport_emissions(stored["emissions"]))
    assert "EqualTo(geo_id,country/NLD)" in emissions and "GreaterThanOrEqual(date,2010-01-01)" in emissions
    status = scan(fleet.vehicle_status(stored["telemetry"], datetime(2024, 1, 30, 12)))
    assert "GreaterThan(event_timestamp,2024-01-29T12:00)" in status and "event_id" not in status
    months = scan(adoption.plate_months(stored["vehicles"]))
    assert "GreaterThanOrEqual(datum_eerste_tenaamstelling_in_nederland,20150101)" in months
    assert "ReadSchema: struct<kenteken:string,datum_eerste_tenaamstelling_in_nederland:string>" in months
    chargers = scan(adoption.chargers_per_postcode(stored["parking_address_raw"], stored["charging_capacity"]))
    assert "EqualTo(parkingaddresstype,F)" in chargers and "areaid" not in chargers


def test_shuffles(stored):
    """One shuffle for a grouped model, none for a row-wise one, four for the plate join."""

    def exchanges(df) -> int:
        return plan(df, "simple").count("Exchange hashpartitioning")

    assert exchanges(curated.vehicles_with_fuel(stored["vehicles_fuel"])) == 0
    assert exchanges(curated.ev_by_region(stored["vehicles_by_postcode"])) == 1
    assert exchanges(adoption.fuel_per_postcode(stored["vehicles_by_postcode"])) == 1
    assert exchanges(fleet.vehicle_status(stored["telemetry"], datetime(2024, 1, 30, 12))) == 1
    assert exchanges(adoption.fuel_per_month(stored["vehicles"], stored["vehicles_fuel"])) <= 4


def test_latest_status_is_hashed_not_sorted(stored):
    status = plan(fleet.vehicle_status(stored["telemetry"], datetime(2024, 1, 30, 12)))
    assert "HashAggregate" in status and "SortAggregate" not in status
    settled = plan(fleet.vehicle_status(stored["telemetry"], datetime(2024, 1, 30, 12), tie_break="event_id"))
    assert "HashAggregate" in settled and "SortAggregate" not in settled


def test_limits_do_not_sort_everything(spark):
    for name in ("top_regions", "top_charger_postcodes", "vehicles_last_seen", "recent_activity", "dashboard_vehicle_list"):
        assert "TakeOrderedAndProject" in plan(queries()[name](spark, FOLDER))


def test_plates_join_by_shuffle_when_neither_side_is_small(spark, stored):
    keep = {key: spark.conf.get(key, None) for key in
            ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for key in keep:
            spark.conf.set(key, "-1")
        text = plan(adoption.fuel_per_month(stored["vehicles"], stored["vehicles_fuel"]))
        assert "SortMergeJoin" in text and "Broadcast" not in text
    finally:
        for key, value in keep.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def folders(df) -> str:
    return "\n".join(line for line in plan(df).splitlines() if line.startswith("PartitionFilters"))


def test_weather_by_month_reads_the_folders_asked_for(spark, stored, tmp_path):
    write_weather(stored["weather_hourly"], str(tmp_path / "w"))
    kept = read_weather(spark, str(tmp_path / "w"))
    for model, year in ((climate.weather_monthly, 2020), (explore.weather_sample, 2024), (explore.weather_by_year, 2015)):
        assert "time_month#" in folders(model(kept)) and f"{year}-01-01" in folders(model(kept))
        assert rows(model(kept)) == rows(model(stored["weather_hourly"]))


def test_permissions_prune_folders(spark, stored, tmp_path):
    table = adoption.fuel_per_postcode(stored["vehicles_by_postcode"])
    access.write_by_region(table, F.left("postcode", F.lit(2)), str(tmp_path / "r"))
    kept = spark.read.schema(table.schema.add("region", "string")).parquet(str(tmp_path / "r"))
    spark.createDataFrame([("d", "10"), ("d", "33"), ("e", "40")], "principal string, allowed_region string").write.parquet(
        str(tmp_path / "p"))
    permissions = spark.read.parquet(str(tmp_path / "p"))
    seen = access.visible_in_folders(kept, permissions, "d")
    assert "dynamicpruning" in folders(seen)
    assert rows(seen) == rows(access.visible_rows(table, F.left("postcode", F.lit(2)), permissions, "d")) != []
