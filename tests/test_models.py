"""Models on hand-made rows: missing values, empty groups, ties and hot keys."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from checks.inputs import AS_OF, Inputs
from tests.conftest import GIVEN, rows
from voltatlas.operators import access, adoption, climate, curated, fleet, quality, usage
from voltatlas.plans import dashboard, explore
from voltatlas.sources import versions

POSTCODE = "postcode string, voertuigsoort string, brandstof string, extern_oplaadbaar string, aantal int"


def test_region_with_missing_values(spark):
    df = spark.createDataFrame(
        [("1011", "Personenauto", "E", "N", 3), ("1099", "Personenauto", "B", "J", 1), ("1011", "Bedrijfsauto", "E", "N", 99),
         (None, "Personenauto", "D", "N", 5), ("2011", "Personenauto", "E", "J", 0), ("3011", "Personenauto", "E", "J", None)],
        POSTCODE)
    assert rows(curated.ev_by_region(df)) == [
        ("10", 3, 1, 0, 1, 4, 75.0),
        ("20", 0, 0, 0, 0, 0, None),        # total of 0 gives no percentage
        ("30", None, 0, 0, None, None, None),
        (None, 0, 0, 5, 0, 5, 0.0),         # a missing postcode is its own group here
    ]


def test_fuel_per_postcode_leaves_out_missing_postcodes(spark):
    df = spark.createDataFrame(
        [("10111", "Personenauto", "W", "J", 3), ("1011", "Personenauto", "W", "N", 1), (None, "Personenauto", "E", "N", 5)],
        POSTCODE)
    assert rows(adoption.fuel_per_postcode(df)) == [("1011", "Hybride", 3), ("1011", "Overig", 1)]


def test_capacity_text(spark):
    df = spark.createDataFrame(
        [("a", "m", "5"), ("b", "m", "n/a"), ("c", "m", "0"), ("d", "m", None), ("e", "k", "x")],
        "areaid string, areamanagerid string, chargingpointcapacity string")
    assert rows(curated.charging_by_area(df)) == [("k", 1, None), ("m", 4, 5)]
    assert rows(adoption.manager_capacity(df)) == [("m", 5)]


def parking(spark, data):
    df = spark.createDataFrame(data, "ref string, parkingaddresstype string, zipcode string")
    record = F.when(F.col("ref").isNotNull(), F.to_json(F.struct(F.col("ref").alias("parkingaddressreference")))).otherwise("{}")
    return df.withColumn("raw_json", F.parse_json(record))


def test_chargers_fan_out(spark):
    capacity = spark.createDataFrame(
        [("a", "m", "5"), ("b", "m", "7"), ("c", "m", "0"), ("d", "k", "2")],
        "areaid string, areamanagerid string, chargingpointcapacity string")
    addresses = parking(spark, [
        ("m", "F", "1011AB"), ("m", "F", "1011AC"), ("m", "F", "2000AA"), ("m", "B", "1011AB"), ("k", "F", ""),
        ("k", "F", None), (None, "F", "3000AA"), ("z", "F", "4000AA")])
    assert rows(adoption.chargers_per_postcode(addresses, capacity)) == [("1011", 24), ("2000", 12)]


def test_infrastructure_keeps_areas_without_chargers(spark):
    regions = spark.createDataFrame(
        [("10", 100, 50.0, 6000), ("20", 30, 1.0, 6000), ("30", 9, 1.0, 5000), (None, 5, 1.0, 7000)],
        "postal_area string, electric_vehicles bigint, ev_percentage double, total_vehicles bigint")
    chargers = spark.createDataFrame([("1011", 3), ("1099", 5), ("3000", 5)], "postcode string, aantal bigint")
    assert rows(adoption.ev_infrastructure(regions, chargers)) == [
        ("10", 100, 50.0, 8, 13.0), ("20", 30, 1.0, 0, None), (None, 5, 1.0, 0, None)]


def classified(spark, data):
    return spark.createDataFrame(data, "registration_year int, fuel_category string, is_ev_or_hybrid boolean")


def test_growth_of_first_year_and_after_zero(spark):
    df = classified(spark, [(2015, "Petrol", False), (2016, "Electric", True), (2016, "Petrol", False),
                            (2018, "Electric", True), (2018, "Hybrid", True), (2018, "Hydrogen", True), (2014, "Electric", True),
                            (None, "Electric", True)])
    assert rows(adoption.ev_yoy_growth(df)) == [
        (2015, 1, 0, 0.0, None, None), (2016, 2, 1, 50.0, 0, None), (2018, 3, 3, 100.0, 1, 200.0)]
    assert rows(adoption.ev_growth_trends(df.where("registration_year = 2016"))) == [
        (2016, "Electric", 1, 1, 100.0), (2016, "Petrol", 1, 0, 0.0)]


def test_national_summary_of_nothing(spark):
    regions = spark.createDataFrame([("10", 1, 5, 20.0)],
                                    "postal_area string, electric_vehicles bigint, total_vehicles bigint, ev_percentage double")
    assert rows(adoption.national_ev_summary(regions)) == [("Netherlands", None, None, None, 0, None, None)]


def test_fuel_per_month_against_pairs_with_a_hot_plate(spark):
    """One plate holds a third of the rows on both sides; the result equals the emitted pairs."""
    rng = random.Random(7)
    texts = ["20150101", "20150131", "20141231", "20160229", "20150230", "garbage", "", None, "20201105", "99991231"]
    fuels = ["Elektriciteit", "Benzine", "diesel", "X-hybride", "LPG", None]
    vehicles = [("HOT" if i % 3 == 0 else f"P{rng.randrange(40)}", rng.choice(texts)) for i in range(300)] + [(None, "20200101")]
    records = [("HOT" if i % 3 == 0 else f"P{rng.randrange(60)}", rng.choice(fuels)) for i in range(300)] + [(None, "LPG")]
    label = {"Elektriciteit": "Elektrisch", "Benzine": "Benzine", "diesel": "Diesel", "X-hybride": "Hybride"}
    expected: Counter = Counter()
    for plate, text in vehicles:
        try:
            day = datetime.strptime(text or "", "%Y%m%d").date()
        except ValueError:
            continue
        for other, fuel in records:
            if plate is not None and plate == other and day >= date(2015, 1, 1):
                expected[(day.replace(day=1), label.get(fuel, "Overig"))] += 1
    found = adoption.fuel_per_month(
        spark.createDataFrame(vehicles, "kenteken string, datum_eerste_tenaamstelling_in_nederland string"),
        spark.createDataFrame(records, "kenteken string, brandstof_omschrijving string"))
    assert {(r.datum, r.brandstof): r.aantal for r in found.collect()} == dict(expected)


def weather(spark, data):
    return spark.createDataFrame(data, "time timestamp_ntz, stationname string, temp double, precip_hour double")


def test_weather_with_missing_values(spark):
    df = weather(spark, [
        (datetime(2019, 12, 31, 23), "SCHIPHOL", -1.0, None), (datetime(2020, 1, 1), "SCHIPHOL", -6.0, 0.5),
        (datetime(2020, 1, 2), "EELDE", None, 0.5), (datetime(2020, 2, 1), "EELDE", 0.0, None)])
    assert rows(climate.weather_yearly(df)) == [(2019, -1.0, 1, 0.0), (2020, -3.0, 1, 1.0)]
    assert rows(climate.weather_monthly(df)) == [(1, -6.0, 50.0, 15.0), (2, 0.0, 0.0, 0.0)]


def test_climate_region_without_areas(spark):
    df = weather(spark, [(datetime(2020, 1, 1), "EELDE", -6.0, 0.0), (datetime(2020, 1, 1), "SCHIPHOL", 5.0, 0.0)])
    regions = spark.createDataFrame([("10", 1, 4)], "postal_area string, electric_vehicles bigint, total_vehicles bigint")
    assert rows(climate.regional_weather_ev(df, regions)) == [
        ("Randstad", 1, 4, 25.0, 5.0, 0, 0), (None, None, None, None, -6.0, 1, 1)]
    cars = spark.createDataFrame([("1000", "Personenauto", "E", "N", 1), ("ab12", "Personenauto", "B", "N", 3)], POSTCODE)
    assert rows(climate.regional_climate_extremes(df, cars)) == [
        ("Noord", 0, 0, None, -6.0, -6.0, 1, 1), ("Randstad", 1, 1, 100.0, 5.0, 5.0, 0, 0)]


TELEMETRY = ("event_id bigint, vin string, event_timestamp timestamp_ntz, battery_pct int, latitude double, longitude double, "
             "speed_kmh int, charging boolean")
NOON = datetime(2024, 1, 2, 12)


def test_vehicle_status_edges(spark):
    day_ago = NOON - timedelta(hours=24)
    df = spark.createDataFrame([
        (1, "VW-EV-1", NOON - timedelta(hours=1), 50, 51.0, 4.0, 10, True),
        (2, "VW-EV-1", NOON - timedelta(hours=1), 19, 52.0, 4.0, 20, True),    # same moment, later id wins; low beats charging
        (3, "VW-EV-1", NOON - timedelta(hours=5), 99, 53.0, 4.0, None, False),  # arrives late, is older
        (4, "BMW-EV-2", day_ago, 5, 51.0, 4.0, 50, False),                      # on the edge: outside
        (5, "BMW-EV-3", day_ago + timedelta(microseconds=1), 20, 51.0, 4.0, 50, None),
        (6, "TESLA-4", NOON, 80, 51.0, 4.0, 1, True),
    ], TELEMETRY)
    found = fleet.vehicle_status(df, NOON, tie_break="event_id")
    assert rows(found, "vin", "brand", "current_battery", "current_lat", "avg_speed_kmh", "status") == [
        ("BMW-EV-3", "BMW", 20, 51.0, 50.0, "ACTIVE"), ("TESLA-4", "TESLA", 80, 51.0, 1.0, "CHARGING"),
        ("VW-EV-1", "VW", 19, 52.0, 15.0, "LOW_BATTERY")]
    without_ties = df.where("event_id <> 1")
    assert rows(fleet.vehicle_status(without_ties, NOON)) == rows(fleet.vehicle_status(without_ties, NOON, tie_break="event_id"))
    assert rows(fleet.fleet_alerts(found), "brand", "total_vehicles", "low_battery_count", "charging_count", "active_count") == [
        ("BMW", 1, 0, 0, 1), ("TESLA", 1, 0, 1, 0), ("VW", 1, 1, 0, 0)]


def test_null_counts(spark):
    df = spark.createDataFrame([(None, 1), ("a", None), (None, None)], "postcode string, n int")
    assert rows(quality.null_counts(df, "t", ["postcode", "n"])) == [
        ("t", "n", "null_count", 2), ("t", "postcode", "null_count", 2)]


def test_row_and_column_access(spark):
    df = spark.createDataFrame([("10", "AB12"), ("20", "CD34"), (None, "EF56")], "region string, kenteken string")
    permissions = spark.createDataFrame(
        [("north", "10"), ("north", "10"), ("south", "20"), ("south", None)], "principal string, allowed_region string")
    assert rows(access.visible_rows(df, F.col("region"), permissions, "north")) == [("10", "AB12")]
    assert rows(access.visible_rows(df, F.col("region"), permissions, "nobody")) == []
    assert rows(access.masked(df, "kenteken", False), "kenteken") == [("****",)] * 3
    assert access.masked(df, "kenteken", True) is df


@pytest.mark.parametrize("quota", [2, 400])
def test_budget_crossings_against_running_sums(spark, quota):
    """A third of all rows at one moment, months that end in between, thresholds passed within one second."""
    rng = random.Random(3)
    start = datetime(2024, 1, 31, 23, 59, 0)
    data = []
    for i in range(900):
        hot = i % 3 == 0
        moment = start + timedelta(seconds=60) if hot else start + timedelta(
            seconds=rng.randrange(120), microseconds=rng.randrange(4))
        data.append((i, moment, rng.randrange(0, 300) / 100))
    data += [(10**6 + i, datetime(2024, 3, 1) + timedelta(days=i), 0.5) for i in range(3)]
    expected = {}
    by_month = defaultdict(list)
    for number, moment, credits in data:
        by_month[moment.date().replace(day=1)].append((moment, number, round(credits * 100)))
    for month, entries in by_month.items():
        spent = 0
        for moment, _, cents in sorted(entries):
            spent += cents
            for pct in (50, 75, 90, 100, 110):
                if spent >= quota * pct and (month, pct) not in expected:
                    expected[(month, pct)] = moment
    df = spark.createDataFrame(data, "event_id bigint, start_time timestamp_ntz, credits double").withColumn(
        "credits_used", F.col("credits").cast("decimal(18,4)"))
    found = usage.budget_crossings(df, quota)
    assert {(r.month, r.threshold_pct): r.first_crossed for r in found.collect()} == expected
    assert len(expected) == {2: 12, 400: 10}[quota]


def test_freshness(spark):
    log = spark.createDataFrame([("a", NOON - timedelta(seconds=61)), ("a", NOON - timedelta(hours=9)),
                                 ("b", NOON - timedelta(seconds=60))], "model string, refreshed_at timestamp_ntz")
    targets = spark.createDataFrame([("a", 60), ("b", 60), ("c", 60)], "model string, target_lag_seconds bigint")
    assert rows(usage.freshness(log, targets, NOON), "model", "lag_seconds", "is_late") == [
        ("a", 61, True), ("b", 60, False), ("c", None, True)]


def test_top_puts_missing_values_last(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0), ("c", 2.0), ("d", 2.0)], "k string, x double")
    assert [r.k for r in explore.top(df, "x", 4, "k").collect()] == ["c", "d", "b", "a"]


def test_row_counts_with_and_without_expectation(spark):
    found = explore.row_counts({"a": spark.range(3), "b": spark.range(0)}, {"a": 5})
    assert rows(found) == [("a", 3, 5), ("b", 0, None)]


def test_published_models(spark, tmp_path):
    models = {"ev_growth_trends": spark.range(3), "vehicles_with_fuel": spark.range(9)}
    for _ in range(2):
        assert access.publish(models, str(tmp_path), ("ev_growth_trends",)) == ["ev_growth_trends"]
    assert versions.read(spark, str(tmp_path / "ev_growth_trends")).count() == 3
    assert not (tmp_path / "vehicles_with_fuel").exists()


def test_published_groups(spark, tmp_path):
    extract = access.dealer_extract(spark.createDataFrame(
        [("88", 1), ("50", 2), ("10", 3), (None, 4)], "postal_area string, n int"))
    access.publish_by_group(extract, str(tmp_path / "dealers"))
    assert rows(versions.read(spark, str(tmp_path / "dealers" / "north")), "postal_area") == [("88",)]
    assert rows(versions.read(spark, str(tmp_path / "dealers" / "south")), "postal_area") == [("50",)]
    assert sorted(p.name for p in (tmp_path / "dealers").iterdir()) == ["north", "south"]


@pytest.mark.parametrize("text,points", [("12.7", 13), ("3", 3), ("0.4", 0), (" 12 ", 12), ("12x", None), ("n/a", None), ("", None),
                                         (None, None), ("2.5", 3), ("-0.5", -1), ("1e3", 1000), ("99999999999", None)])
def test_capacity_text(spark, text, points):
    df = spark.createDataFrame([("a", "m", text)], "areaid string, areamanagerid string, chargingpointcapacity string")
    assert curated.charging_by_area(df).first().total_charging_points == points
    assert rows(adoption.manager_capacity(df)) == ([("m", points)] if points and points > 0 else [])


def test_shares_that_are_published(spark, tmp_path):
    trends = spark.createDataFrame([(2020, "Electric", 5, 5, 100.0)],
                                   "registration_year int, fuel_category string, vehicle_count bigint, ev_hybrid_count bigint, "
                                   "ev_percentage double")
    with pytest.raises(LookupError):
        access.publish({"ev_growth_trends": trends}, str(tmp_path))
    assert list(tmp_path.iterdir()) == []
    access.publish_totals(trends, str(tmp_path))
    assert rows(versions.read(spark, str(tmp_path / "manufacturer_totals"))) == [("Electric", 5, 5)]
    access.publish_by_group(spark.createDataFrame([("97", "north")], "postal_area string, dealer_group string"), str(tmp_path))
    assert [versions.read(spark, str(tmp_path / group)).count() for group in ("north", "south")] == [1, 0]


def test_latest_status_with_tie_breaks(spark):
    """Ties, negative and missing tie-breaks, times before 1970."""
    noon = datetime(2024, 1, 2, 12)
    kinds = "event_id bigint, vin string, event_timestamp timestamp_ntz, battery_pct int, latitude double, longitude double, " \
            "speed_kmh int, charging boolean"
    events = [(n, "VW-1", noon, b, 0.0, 0.0, 1, False) for n, b in ((-5, 1), (7, 2), (None, 3), (-2 ** 63 + 1, 4))]
    events += [(2 ** 63 - 1, "VW-1", noon - timedelta(microseconds=1), 5, 0.0, 0.0, 1, False),
               (None, "VW-2", noon, 6, 0.0, 0.0, 1, False)]
    found = fleet.vehicle_status(spark.createDataFrame(events, kinds), noon, tie_break="event_id")
    assert rows(found, "vin", "current_battery") == [("VW-1", 2), ("VW-2", 6)]


def test_order_of_the_lists(spark):
    """The checks compare sorted rows; here the order itself counts."""
    given = Inputs(spark, f"{GIVEN}/sf0.001")
    status = fleet.vehicle_status(given.telemetry, AS_OF, tie_break="event_id")
    listed = [(r.status, r.current_battery) for r in dashboard.vehicle_list(status).collect()]
    rank = {"LOW_BATTERY": 0, "CHARGING": 1, "ACTIVE": 2}
    assert listed == sorted(listed, key=lambda r: (rank[r[0]], r[1]))
    low = [r.current_battery for r in explore.needing_attention(status).collect()]
    assert low == sorted(low)
    growth = adoption.ev_yoy_growth(curated.vehicles_with_fuel(given.vehicles_fuel))
    years = [r[0] for r in dashboard.share_by_year(growth).collect()]
    assert years == sorted(years)
