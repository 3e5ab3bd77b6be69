"""The full refresh: order, written tables, log, and SQL over the mounted layers."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks.inputs import Inputs
from tests.conftest import GIVEN, rows
from voltatlas.operators import adoption, curated, fleet, usage
from voltatlas.plans.refresh import MODELS, refresh_all, refresh_targets
from voltatlas.sources.lake import Lake
from voltatlas.sources.schemas import RAW_TABLES

AS_OF = datetime(2024, 1, 30, 12)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    lake = Lake(spark, str(tmp_path_factory.mktemp("lake")))
    given = Inputs(spark, f"{GIVEN}/sf0.001")
    lake.create_missing()
    for table, df in given.raw_tables().items():
        lake.append(df, table)
    external = {"weather_hourly": given.weather_hourly, "emissions": given.emissions}
    for _ in range(2):  # a second run replaces everything
        names = refresh_all(lake, external, as_of=AS_OF, min_total_summary=100, min_total_infrastructure=100)
    return lake, given, names


def test_all_models_in_order(lake):
    lake, _, names = lake
    assert names == [model.name for model in MODELS]
    assert len({model.layer for model in MODELS} | {"raw"}) == 3
    for model in MODELS:
        upstream = [name for name in model.inputs if name in names]
        assert all(names.index(name) < names.index(model.name) for name in upstream)
        assert lake.read(model.layer, model.name).count() > 0


def test_written_tables_equal_the_models(lake):
    lake, given, _ = lake
    regions = curated.ev_by_region(given.vehicles_by_postcode)
    chargers = adoption.chargers_per_postcode(given.parking_address_raw, given.charging_capacity)
    assert rows(lake.read("analytics", "ev_infrastructure_correlation")) == rows(
        adoption.ev_infrastructure(regions, chargers, 100))
    assert rows(lake.read("curated", "vehicle_status")) == rows(fleet.vehicle_status(given.telemetry, AS_OF))


def test_status_reads_the_days_of_its_window(lake):
    lake, _, _ = lake
    df = fleet.vehicle_status(lake.read("raw", "telemetry_raw"), AS_OF)
    text = df.sparkSession.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "event_date#" in text and ">= 2024-01-29" in text.split("PartitionFilters")[1].splitlines()[0]


def test_invariants(lake):
    lake, _, _ = lake
    regions = lake.read("curated", "ev_by_region")
    by_postcode = lake.read("analytics", "brandstof_per_postcode")
    assert by_postcode.agg(F.sum("aantal")).first()[0] == regions.agg(F.sum("total_vehicles")).first()[0]
    assert regions.where("ev_percentage not between 0 and 100").count() == 0
    kept = lake.read("analytics", "ev_infrastructure_correlation").select("postal_area")
    assert rows(kept) == rows(regions.where("total_vehicles > 100").select("postal_area"))


def test_refresh_log_feeds_the_freshness_report(spark, lake):
    lake, _, names = lake
    log = lake.read("analytics", "refresh_log")
    assert log.count() == 2 * len(names)
    report = usage.freshness(log, refresh_targets(lake), datetime(2100, 1, 1))
    assert report.count() == len(MODELS)
    assert report.where("not is_late").count() == 0


def test_models_without_inputs_are_left_out(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.create_missing({"charging_capacity_raw": RAW_TABLES["charging_capacity_raw"]})
    with pytest.raises(LookupError):
        refresh_all(lake)
    assert refresh_all(lake, skip_missing=True) == ["charging_by_area"]


def test_sql_over_the_layers(spark, lake):
    lake, _, _ = lake
    assert "analytics.ev_yoy_growth" in lake.mount()
    assert "raw.vehicles_raw" in lake.mount()
    top = spark.sql("SELECT * FROM CURATED.EV_BY_REGION ORDER BY ev_percentage DESC LIMIT 10")
    assert top.count() == 10
    share = spark.sql("SELECT registration_year, ev_share_percent FROM ANALYTICS.EV_YOY_GROWTH WHERE registration_year >= 2015")
    assert share.count() == 11
    events = spark.sql("SELECT count(*) FROM raw.telemetry_raw WHERE event_date >= DATE '2024-01-15'").first()[0]
    assert 0 < events < lake.read("raw", "telemetry_raw").count()
    field = spark.sql("SELECT DISTINCT raw_json:merk::string AS merk FROM raw.vehicles_raw")
    assert field.count() == 4
