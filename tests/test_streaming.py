"""Incremental results against full runs: many micro-batches, any order, replays and restarts."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.inputs import Inputs
from tests.conftest import GIVEN, rows
from voltatlas import __main__ as jobs
from voltatlas.operators import adoption, climate, curated, fleet, quality, usage
from voltatlas.plans.refresh import refresh_targets
from voltatlas.sources import versions
from voltatlas.sources.lake import Lake
from voltatlas.streaming import fleet as fleet_stream
from voltatlas.streaming import quality as quality_stream
from voltatlas.streaming import sink, windows
from voltatlas.streaming.incremental import (
    JOIN_MODELS, SUM_MODELS, national_model, read_counted, read_join, read_sums, refresh_join, refresh_sums)


@pytest.fixture(scope="module")
def given(spark):
    return Inputs(spark, f"{GIVEN}/sf0.001")


def written(df, folder: Path, files: int = 4, seed: int = 1) -> str:
    """The rows in several files, in an order that has nothing to do with the rows."""
    df.repartition(files, F.xxhash64(F.lit(seed), *[c for c in df.columns if c != "raw_json"])).write.parquet(str(folder))
    return str(folder)


def stream(spark, folder: str, per_batch: int = 1):
    return spark.readStream.schema(spark.read.parquet(folder).schema).option("maxFilesPerTrigger", per_batch).parquet(folder)


def forget_last_commit(checkpoint: Path) -> None:
    """As after a crash between a batch's output and its commit: the batch is run again."""
    last = max((p for p in (checkpoint / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    last.unlink()
    (checkpoint / "commits" / f".{last.name}.crc").unlink(missing_ok=True)


BATCH = {
    "ev_by_region": ("vehicles_by_postcode", curated.ev_by_region),
    "charging_by_area": ("charging_capacity", curated.charging_by_area),
    "ev_growth_trends": ("vehicles_fuel", lambda df: adoption.ev_growth_trends(curated.vehicles_with_fuel(df))),
    "brandstof_per_postcode": ("vehicles_by_postcode", adoption.fuel_per_postcode),
}


@pytest.mark.parametrize("name", sorted(SUM_MODELS))
def test_sum_models(spark, given, tmp_path, name):
    view, full = BATCH[name]
    source = written(given.view(view), tmp_path / "in")
    model, state, checkpoint = SUM_MODELS[name], str(tmp_path / "state"), tmp_path / "checkpoint"
    for _ in range(2):
        refresh_sums(stream(spark, source), model, state, str(checkpoint)).awaitTermination()
        assert len(list(Path(state, "batches").glob("batch_id=*"))) == 4
        assert rows(read_sums(spark, model, state)) == rows(full(given.view(view)))
        forget_last_commit(checkpoint)


def test_models_on_top_of_merged_sums(spark, given, tmp_path):
    """Models that do not merge are rebuilt from the merged ones."""
    source = written(given.vehicles_by_postcode, tmp_path / "in")
    model, state = SUM_MODELS["ev_by_region"], str(tmp_path / "state")
    refresh_sums(stream(spark, source), model, state, str(tmp_path / "checkpoint")).awaitTermination()
    regions, full = read_sums(spark, model, state), curated.ev_by_region(given.vehicles_by_postcode)
    assert rows(adoption.national_ev_summary(regions, 500)) == rows(adoption.national_ev_summary(full, 500))
    chargers = adoption.chargers_per_postcode(given.parking_address_raw, given.charging_capacity)
    assert rows(adoption.ev_infrastructure(regions, chargers, 100)) == rows(adoption.ev_infrastructure(full, chargers, 100))
    assert rows(climate.regional_weather_ev(given.weather_hourly, regions)) == rows(
        climate.regional_weather_ev(given.weather_hourly, full))


def test_join_model_by_month(spark, given, tmp_path):
    left = written(given.vehicles, tmp_path / "left", 3)
    right = written(given.vehicles_fuel, tmp_path / "right", 5)
    model, state, checkpoint = JOIN_MODELS["brandstof_per_postcode_datum"], str(tmp_path / "state"), tmp_path / "checkpoint"
    full = rows(adoption.fuel_per_month(given.vehicles, given.vehicles_fuel))
    assert full
    for _ in range(2):
        refresh_join(stream(spark, left), stream(spark, right), model, state, str(checkpoint)).awaitTermination()
        assert len(list(Path(state, "sums", "batches").glob("batch_id=*"))) > 2
        assert rows(read_join(spark, model, state)) == full
        forget_last_commit(checkpoint)


def test_join_model_by_postcode(spark, given, tmp_path):
    left = written(given.parking_address_raw, tmp_path / "left", 4)
    right = written(given.charging_capacity, tmp_path / "right", 2)
    model, state = JOIN_MODELS["laadpalen_per_postcode"], str(tmp_path / "state")
    refresh_join(stream(spark, left), stream(spark, right), model, state, str(tmp_path / "checkpoint")).awaitTermination()
    full = rows(adoption.chargers_per_postcode(given.parking_address_raw, given.charging_capacity))
    assert full and rows(read_join(spark, model, state)) == full


AS_OF = datetime(2024, 1, 31)


@pytest.mark.parametrize(("seed", "bucket"), [(1, 3600), (2, 60)])
def test_status_with_shuffled_batches(spark, given, tmp_path, seed, bucket):
    source = written(given.telemetry, tmp_path / "in", 6, seed)
    state, checkpoint = str(tmp_path / "state"), tmp_path / "checkpoint"

    def streamed(as_of):
        return rows(fleet_stream.current_status(
            spark, state, as_of, given.telemetry, bucket_seconds=bucket, tie_break="event_id"))

    def full(as_of):
        return rows(fleet.vehicle_status(given.telemetry, as_of, tie_break="event_id"))

    for _ in range(2):
        fleet_stream.refresh_status(
            stream(spark, source), state, str(checkpoint), bucket, tie_break="event_id").awaitTermination()
        assert streamed(AS_OF) == full(AS_OF) != []
        forget_last_commit(checkpoint)
    # A later look at the same state forgets what has left its window; it may fall anywhere within an hour.
    for later in (timedelta(hours=12), timedelta(minutes=7, seconds=3, microseconds=1), timedelta(hours=30)):
        assert streamed(AS_OF + later) == full(AS_OF + later)


def test_status_at_the_cut(spark, tmp_path):
    """Events around the cut and on bucket edges, late ones among them; the batch model says what counts."""
    kinds = "event_id bigint, vin string, event_timestamp timestamp_ntz, battery_pct int, latitude double, " \
            "longitude double, speed_kmh int, charging boolean"
    noon, micro = datetime(2024, 1, 2, 12), timedelta(microseconds=1)
    rng = random.Random(5)
    events = [(0, "VW-EV-1", noon - timedelta(hours=24), 1, 0.0, 0.0, 100, False),
              (1, "VW-EV-1", noon - timedelta(hours=24) + micro, 2, 0.0, 0.0, 50, False),
              (2, "VW-EV-2", noon - timedelta(hours=24), 3, 0.0, 0.0, 50, False),
              (3, "VW-EV-3", noon, 4, 0.0, 0.0, None, False),
              (4, "VW-EV-9", noon - timedelta(hours=23), 5, 0.0, 0.0, 7, True),
              (5, "VW-EV-8", noon - timedelta(hours=23) + micro, 6, 0.0, 0.0, 7, True)]
    events += [(i, f"VW-EV-{rng.randrange(4)}", noon - timedelta(minutes=rng.randrange(1441)), rng.randrange(101),
                0.0, 0.0, rng.randrange(130), rng.random() < 0.5) for i in range(6, 200)]
    df = spark.createDataFrame(events, kinds)
    source, state = written(df, tmp_path / "in", 5), str(tmp_path / "state")
    fleet_stream.refresh_status(stream(spark, source), state, str(tmp_path / "c"), tie_break="event_id").awaitTermination()
    by_day = df.withColumn("event_date", F.to_date("event_timestamp"))
    for as_of in (noon, noon + micro, noon + timedelta(minutes=30), noon + timedelta(hours=1) - micro,
                  noon + timedelta(hours=1), noon + timedelta(hours=1) + micro, noon + timedelta(hours=23)):
        found = fleet_stream.current_status(spark, state, as_of, by_day, tie_break="event_id")
        assert rows(found) == rows(fleet.vehicle_status(df, as_of, tie_break="event_id"))
    with pytest.raises(ValueError):
        fleet_stream.current_status(spark, state, noon + timedelta(seconds=1))


KINDS = "vin string, event_timestamp timestamp_ntz, battery_pct int, latitude double, longitude double, speed_kmh int, " \
        "charging boolean"


def test_a_wrong_clock_harms_no_other_vehicle(spark, tmp_path):
    """One event stamped far ahead, then events of other vehicles at normal and at late times."""
    noon, folder = datetime(2024, 1, 2, 12), tmp_path / "in"
    batches = [[("VW-1", noon)], [("VW-BAD", datetime(2030, 1, 1))], [("VW-2", noon - timedelta(minutes=5))],
               [("VW-3", noon - timedelta(hours=23)), ("VW-1", noon - timedelta(hours=20))]]
    for events in batches:
        spark.createDataFrame([(vin, moment, 50, 0.0, 0.0, 10, False) for vin, moment in events], KINDS).coalesce(1).write.mode(
            "append").parquet(str(folder))
        fleet_stream.refresh_status(
            stream(spark, str(folder)), str(tmp_path / "state"), str(tmp_path / "c")).awaitTermination()
    raw = spark.read.parquet(str(folder))
    found = rows(fleet_stream.current_status(spark, str(tmp_path / "state"), noon, raw))
    assert len(found) == 4 and found == rows(fleet.vehicle_status(raw, noon))


def test_many_batches_are_folded(spark, tmp_path):
    """Files stay few, results are those of one run, also after a fold that was cut short and a replay."""
    noon, folder, state, checkpoint = datetime(2024, 1, 2, 12), tmp_path / "in", str(tmp_path / "state"), tmp_path / "c"
    rng = random.Random(4)
    for number in range(23):  # all times differ, so that the latest event is settled
        events = [(f"VW-{rng.randrange(5)}", noon - timedelta(minutes=rng.randrange(1500), microseconds=6 * number + n),
                   rng.randrange(100), 0.0, 0.0, rng.randrange(90), False) for n in range(6)]
        spark.createDataFrame(events, KINDS).coalesce(1).write.mode("append").parquet(str(folder))
    for _ in range(2):
        fleet_stream.refresh_status(
            stream(spark, str(folder)), state, str(checkpoint), fold_every=5).awaitTermination()
        log = fleet_stream.status_log(spark, state)
        assert log.folded_to() == 19 and len(list(Path(state, "batches").glob("batch_id=*"))) < 12
        assert len(versions.versions(spark, log.base)) == 2
        raw = spark.read.parquet(str(folder))
        assert rows(fleet_stream.current_status(spark, state, noon, raw)) == rows(fleet.vehicle_status(raw, noon))
        forget_last_commit(checkpoint)
        Path(state, "base", "v000099.21").mkdir(exist_ok=True)  # a fold without its success marker does not count


def test_expired_days_are_refused(spark, tmp_path):
    noon, state = datetime(2024, 1, 10, 12), str(tmp_path / "state")
    spark.createDataFrame([("VW-1", noon - timedelta(days=n), n, 0.0, 0.0, 10, False) for n in range(5)], KINDS).write.parquet(
        str(tmp_path / "in"))
    raw = spark.read.parquet(str(tmp_path / "in"))
    fleet_stream.refresh_status(stream(spark, str(tmp_path / "in")), state, str(tmp_path / "c")).awaitTermination()
    fleet_stream.expire(spark, state, noon - timedelta(hours=30))
    assert fleet_stream.kept_from(spark, state) == (noon - timedelta(hours=30)).date()
    assert fleet_stream.status_log(spark, state).read().select("day").distinct().count() == 2
    assert rows(fleet_stream.current_status(spark, state, noon, raw)) == rows(fleet.vehicle_status(raw, noon))
    with pytest.raises(ValueError):
        fleet_stream.current_status(spark, state, noon, raw, hours=72)


def test_session_must_run_in_utc(spark, tmp_path):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Amsterdam")
        with pytest.raises(ValueError):
            fleet_stream.current_status(spark, str(tmp_path), datetime(2024, 1, 1))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_sums_and_joins_are_folded(spark, given, tmp_path):
    source = written(given.vehicles_by_postcode, tmp_path / "in", 7)
    model, state = SUM_MODELS["ev_by_region"], str(tmp_path / "state")
    refresh_sums(stream(spark, source), model, state, str(tmp_path / "c"), fold_every=2).awaitTermination()
    assert len(list(Path(state, "batches").glob("batch_id=*"))) < 6
    assert rows(read_sums(spark, model, state)) == rows(curated.ev_by_region(given.vehicles_by_postcode))
    left, right = written(given.vehicles, tmp_path / "left", 3), written(given.vehicles_fuel, tmp_path / "right", 4)
    model, state = JOIN_MODELS["brandstof_per_postcode_datum"], str(tmp_path / "joined")
    refresh_join(stream(spark, left), stream(spark, right), model, state, str(tmp_path / "j"), fold_every=2).awaitTermination()
    assert list(Path(state, "left", "base").glob("v*")) and list(Path(state, "sums", "base").glob("v*"))
    assert rows(read_join(spark, model, state)) == rows(adoption.fuel_per_month(given.vehicles, given.vehicles_fuel))


def test_watch_publishes_after_each_batch(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path / "lake"))
    moment = jobs.now().replace(microsecond=0)
    events = [("VW-1", moment - timedelta(minutes=n), 90 - n, 0.0, 0.0, n, False) for n in range(60)]
    lake.append(spark.createDataFrame(events, KINDS).withColumn("raw_json", F.parse_json(F.lit("{}"))), "telemetry_raw")
    monkeypatch.setattr(jobs, "now", lambda: moment)
    jobs.watch(lake, str(tmp_path / "state"), str(tmp_path / "c"), {"availableNow": True}).awaitTermination()
    status = fleet.vehicle_status(lake.read("raw", "telemetry_raw"), moment)
    assert rows(lake.read("curated", "vehicle_status")) == rows(status) != []
    assert rows(lake.read("analytics", "fleet_alerts")) == rows(fleet.fleet_alerts(status))
    report = usage.freshness(lake.read("analytics", "refresh_log"), refresh_targets(lake), jobs.datetime.now(jobs.timezone.utc).replace(
        tzinfo=None)).where("model in ('vehicle_status', 'fleet_alerts')")
    assert report.count() == 2 and report.where("is_late").count() == 0


def test_update_keeps_the_incremental_models(spark, given, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    tables = {name: df for name, df in given.raw_tables().items() if name != "telemetry_raw"}
    for half in (0, 1):
        for name, df in tables.items():
            part = df.where(F.pmod(F.xxhash64(*[c for c in df.columns if c != "raw_json"]), F.lit(2)) == half)
            lake.put_load(part, name, f"half-{half}")
        jobs.update(lake, str(tmp_path / "state"), str(tmp_path / "c"))
    raw = {name: lake.read("raw", name) for name in tables}
    assert rows(lake.read("curated", "ev_by_region")) == rows(curated.ev_by_region(raw["vehicles_by_postcode_raw"]))
    assert rows(lake.read("analytics", "brandstof_per_postcode_datum")) == rows(
        adoption.fuel_per_month(raw["vehicles_raw"], raw["vehicles_fuel_raw"]))
    assert rows(lake.read("analytics", "laadpalen_per_postcode")) == rows(
        adoption.chargers_per_postcode(raw["parking_address_raw"], raw["charging_capacity_raw"]))
    # Corrected loads: rows go, come twice, and change; twice over, and one of them before the update has seen the first.
    for keep in ("aantal % 3 > 0", "aantal % 5 > 1", "brandstof <> 'E' or postcode > '5'"):
        half = raw["vehicles_by_postcode_raw"].where(keep)
        lake.put_load(half.unionAll(half.where("aantal = 7")), "vehicles_by_postcode_raw", "half-0")
    lake.put_load(tables["vehicles_fuel_raw"].withColumn("brandstof_omschrijving", F.when(
        F.col("kenteken") > "5", "Diesel").otherwise(F.col("brandstof_omschrijving"))), "vehicles_fuel_raw", "half-1")
    lake.put_load(tables["parking_address_raw"].where("zipcode > '3'"), "parking_address_raw", "half-0")
    lake.put_load(tables["charging_capacity_raw"].where("areaid < '5'"), "charging_capacity_raw", "half-1")
    jobs.update(lake, str(tmp_path / "state"), str(tmp_path / "c"))
    raw = {name: lake.read("raw", name) for name in tables}
    regions = curated.ev_by_region(raw["vehicles_by_postcode_raw"])
    growth = adoption.ev_growth_trends(curated.vehicles_with_fuel(raw["vehicles_fuel_raw"]))
    for layer, name, full in (
            ("curated", "ev_by_region", regions), ("analytics", "national_ev_summary", adoption.national_ev_summary(regions)),
            ("curated", "charging_by_area", curated.charging_by_area(raw["charging_capacity_raw"])),
            ("analytics", "ev_growth_trends", growth), ("analytics", "ev_yoy_growth", adoption.yoy_from_sums(growth)),
            ("analytics", "brandstof_per_postcode", adoption.fuel_per_postcode(raw["vehicles_by_postcode_raw"])),
            ("analytics", "brandstof_per_postcode_datum", adoption.fuel_per_month(raw["vehicles_raw"], raw["vehicles_fuel_raw"])),
            ("analytics", "laadpalen_per_postcode", adoption.chargers_per_postcode(
                raw["parking_address_raw"], raw["charging_capacity_raw"]))):
        assert rows(lake.read(layer, name)) == rows(full) != [], name


def test_changes_of_a_load(spark, tmp_path):
    """The change between two versions has each row with its sign, is written once, and made up for when it is missing."""
    lake, table = Lake(spark, str(tmp_path)), "charging_capacity_raw"

    def load(*given):
        return spark.createDataFrame([(a, "m", c, None) for a, c in given], "areaid string, areamanagerid string, "
                                     "chargingpointcapacity string, record string").withColumn("raw_json", F.parse_json("record")).drop("record")

    lake.put_load(load(("1", "5"), ("1", "5"), ("2", None)), table, "all")
    lake.put_load(load(("1", "5"), ("2", "7"), ("3", None), ("3", None)), table, "all")
    changed = spark.read.parquet(str(tmp_path / "raw_changes" / table / "all" / "v000002"))
    assert rows(changed, "areaid", "chargingpointcapacity", "times") == rows(spark.createDataFrame(
        [("1", "5", -1), ("2", None, -1), ("2", "7", 1), ("3", None, 2)], "a string, b string, n bigint"))
    versions.delete(spark, str(tmp_path / "raw_changes" / table / "all" / "v000002"))  # as after a crash before it was written
    lake.put_load(load(("9", "1")), table, "all")
    assert versions.names(spark, str(tmp_path / "raw_changes" / table / "all")) == ["v000002", "v000003"]
    for n in range(3):
        lake.put_load(load(("9", str(n))), table, "all")
    assert versions.versions(spark, str(tmp_path / "raw" / table / "all")) == ["v000001", "v000005", "v000006"]
    model, state = SUM_MODELS["charging_by_area"], str(tmp_path / "state")
    refresh_sums(lake.stream(table), model, state, str(tmp_path / "c")).awaitTermination()
    assert rows(read_sums(spark, model, state)) == [("m", 1, 2)]
    lake.put_load(load(("9", None)), table, "all")  # the only number goes: the sum is NULL again
    refresh_sums(lake.stream(table), model, state, str(tmp_path / "c")).awaitTermination()
    assert rows(read_sums(spark, model, state)) == [("m", 1, None)]
    lake.put_load(load(), table, "all")  # all rows go, and the group with them
    refresh_sums(lake.stream(table), model, state, str(tmp_path / "c")).awaitTermination()
    assert rows(read_sums(spark, model, state)) == []


def test_extremes_survive_withdrawals(spark, tmp_path):
    """Maxima, minima and distinct counts of a counted model after any inserts and withdrawals, with folds and a replay."""
    rng, state, checkpoint = random.Random(8), str(tmp_path / "state"), tmp_path / "c"
    kinds = "postcode string, voertuigsoort string, brandstof string, extern_oplaadbaar string, aantal int, times bigint"
    model, above = SUM_MODELS["ev_by_region"], {"national": national_model(20)}
    there: list[tuple] = []
    for batch in range(6):
        fresh = [(f"{rng.randrange(10, 22)}00", "Personenauto", rng.choice("EBD"), "N", rng.randrange(1, 30)) for _ in range(25)]
        gone = rng.sample(there, len(there) // 2 if batch < 5 else len(there))
        if batch == 5:
            fresh = fresh[:3]
        for row in gone:
            there.remove(row)
        there += fresh
        spark.createDataFrame([(*row, 1) for row in fresh] + [(*row, -1) for row in gone], kinds).coalesce(1).write.mode(
            "append").parquet(str(tmp_path / "in"))
        for _ in range(2 if batch == 3 else 1):
            refresh_sums(stream(spark, str(tmp_path / "in")), model, state, str(checkpoint), fold_every=2,
                         counted_models=above).awaitTermination()
            full = adoption.national_ev_summary(curated.ev_by_region(spark.createDataFrame(
                [row for row in there], kinds.removesuffix(", times bigint"))), 20)
            assert rows(read_counted(spark, state, "national", above["national"])) == rows(full)
            if batch == 3:
                forget_last_commit(checkpoint)


def test_metric_history(spark, tmp_path):
    """The history holds the metric of the table, not of the change, and a replay keeps the time."""
    folder, history, checkpoint = tmp_path / "in", str(tmp_path / "history"), tmp_path / "c"
    for values in ([None, "a"], [None, None, "b"], ["c"]):
        spark.createDataFrame([(v,) for v in values], "postcode string").coalesce(1).write.mode("append").parquet(str(folder))
        quality_stream.record_null_counts(
            stream(spark, str(folder)), "t", ["postcode"], history, str(checkpoint)).awaitTermination()
    found = quality_stream.read_history(spark, history).collect()
    assert [r.value for r in found] == [3, 3, 1]  # newest first
    forget_last_commit(checkpoint)
    quality_stream.record_null_counts(
        stream(spark, str(folder)), "t", ["postcode"], history, str(checkpoint)).awaitTermination()
    assert quality_stream.read_history(spark, history).collect() == found


def test_metrics_are_taken_while_rows_are_written(spark, tmp_path):
    """One pass over each batch: rows and counts land together; a replay replaces both and keeps the time."""
    folder, target, history, checkpoint = tmp_path / "in", str(tmp_path / "rows"), str(tmp_path / "history"), tmp_path / "c"
    passed = spark.sparkContext.accumulator(0)

    def counting(frames):
        for frame in frames:
            passed.add(len(frame))
            yield frame

    def run():
        rows_in = stream(spark, str(folder)).mapInPandas(counting, "postcode string, n int")
        quality_stream.write_observed(rows_in, "t", ["postcode", "n"], target, history, str(checkpoint)).awaitTermination()

    for values in ([(None, 1), ("a", None)], [(None, 2), (None, 3), ("b", 4)], []):
        spark.createDataFrame(values, "postcode string, n int").coalesce(1).write.mode("append").parquet(str(folder))
        run()
    assert passed.value == 5  # every row came by once
    found = quality_stream.read_history(spark, history).where("metric = 'null_count'").collect()
    latest = {row.column_name: row.value for row in found if row.measured_at == found[0].measured_at}
    whole = quality.null_counts(spark.read.parquet(str(folder)), "t", ["postcode", "n"])
    assert latest == {row.column_name: row.value for row in whole.collect()} == {"postcode": 3, "n": 1}
    assert rows(sink.read_batches(spark, target).drop("batch_id")) == rows(spark.read.parquet(str(folder)))
    forget_last_commit(checkpoint)
    run()
    assert quality_stream.read_history(spark, history).where("metric = 'null_count'").collect() == found


def test_windows_behind_a_watermark(spark, tmp_path):
    """Equal to the batch model over the events in time; late ones are counted; state and results survive a restart."""
    noon, folder, state, checkpoint = datetime(2024, 1, 2, 12), tmp_path / "in", str(tmp_path / "state"), tmp_path / "c"
    rng, micro = random.Random(6), iter(range(10 ** 6))

    def events(hours_ago, n=12):  # all times differ, so that the latest event is settled
        return [(f"VW-{rng.randrange(4)}", noon - timedelta(hours=hours_ago, minutes=rng.randrange(55), microseconds=next(micro)),
                 rng.randrange(100), 0.0, 0.0, rng.choice([None, rng.randrange(90)]), rng.random() < 0.5) for _ in range(n)]

    in_time, late = [], []
    for batch, (ages, lost) in enumerate([((5, 4), False), ((4, 3), False), ((1, 0), False), ((2,), False), ((9,), True), ((0, 1), False)]):
        fresh = [event for age in ages for event in events(age)]
        (late if lost else in_time).extend(fresh)
        spark.createDataFrame(fresh, KINDS).coalesce(1).write.mode("append").parquet(str(folder))
        for _ in range(2 if batch == 2 else 1):
            query = windows.refresh_windows(stream(spark, str(folder)), state, str(checkpoint), lateness="4 hours", fold_every=2)
            query.awaitTermination()
            windows.record_progress(spark, query, state)
            if batch == 2:
                forget_last_commit(checkpoint)
    kept = spark.createDataFrame(in_time, KINDS)
    for as_of in (noon + timedelta(hours=1), noon + timedelta(hours=20)):
        assert rows(windows.windowed_status(spark, state, as_of)) == rows(fleet.vehicle_status(kept, as_of)) != []
    assert windows.late_events(spark, state) == len(late) == 12
    progress = sink.read_batches(spark, f"{state}/progress")
    assert progress.agg(F.max("state_rows")).first()[0] <= 4 * 12 and progress.where("watermark > '2024'").count() > 0
    assert any((checkpoint / "state").rglob("*.zip"))  # snapshots as the RocksDB store writes them
