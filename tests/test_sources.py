"""Pages, landing and table layers, on page files written by the tests."""

from __future__ import annotations

import json
from urllib.parse import quote, unquote_plus

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import rows
from voltatlas.session import work_folder
from voltatlas.plans.refresh import IncompleteLoad, refresh_all
from voltatlas.sources import landing, versions
from voltatlas.sources.lake import Lake, read_emissions, read_weather
from voltatlas.sources.paged import (
    DATASETS, PagedJsonReader, PagedJsonStreamReader, read_pages, stream_pages, stretch_filter)
from voltatlas.streaming import sink
from voltatlas.sources.schemas import EMISSIONS, RAW_TABLES, WEATHER_HOURLY


def write_pages(folder, dataset, records, limit, pages, order="default"):
    target = folder / dataset
    target.mkdir(parents=True, exist_ok=True)
    for page in range(pages):
        body = json.dumps(records[page * limit:(page + 1) * limit])
        (target / f"{order}-{page * limit}.json").write_text(body)


RECORDS = [{"postcode": str(1000 + i), "voertuigsoort": "Personenauto", "brandstof": "E", "extern_oplaadbaar": "N",
            "aantal": str(i)} for i in range(25)]


def test_pages_are_fetched_once_each(spark, tmp_path):
    write_pages(tmp_path, "d", RECORDS, 10, 4)  # the third page is short, the fourth empty
    pages = read_pages(spark, "d", limit=10, pages=4, parallel=3, base=tmp_path)
    assert rows(pages, "dataset", "page_offset", "error") == [("d", 0, None), ("d", 10, None), ("d", 20, None), ("d", 30, None)]
    found = landing.typed(landing.elements(pages), "vehicles_by_postcode_raw")
    assert [f.name for f in found.schema] == RAW_TABLES["vehicles_by_postcode_raw"].fieldNames()
    assert rows(found.select("postcode", "aantal")) == sorted(((r["postcode"], int(r["aantal"])) for r in RECORDS), key=str)


def test_tasks_and_offsets():
    reader = PagedJsonReader({"dataset": "d", "limit": "1000", "pages": "50", "parallel": "8", "start": "5000"})
    parts = reader.partitions()
    assert len(parts) == 8
    assert sorted(o for p in parts for o in p.offsets) == list(range(5000, 55000, 1000))
    assert len(PagedJsonReader({"dataset": "d"}).partitions()) == 1


def test_page_offsets(spark):
    assert rows(landing.page_offsets(spark, 50)) == rows(spark.range(0, 50000, 1000))
    for n, pages in ((0, 0), (1, 1), (1000, 1), (1001, 2), (25000, 25)):
        found = landing.offsets_covering(spark.range(n), limit=1000, block=10)
        assert sorted(r.page_offset for r in found.collect()) == [1000 * p for p in range(pages)]


def test_order_is_part_of_the_request(spark, tmp_path):
    write_pages(tmp_path, "d", RECORDS[::-1], 25, 1, order="postcode")
    pages = read_pages(spark, "d", limit=25, order="postcode", base=tmp_path)
    assert json.loads(pages.first().body) == RECORDS[::-1]


def test_failed_page_fails_the_job_by_default(spark, tmp_path):
    write_pages(tmp_path, "d", RECORDS, 10, 2)
    with pytest.raises(PySparkException):
        read_pages(spark, "d", limit=10, pages=3, base=tmp_path).collect()


def test_failed_page_can_be_reported(spark, tmp_path):
    write_pages(tmp_path, "d", RECORDS, 10, 2)
    pages = read_pages(spark, "d", limit=10, pages=3, on_error="report", retries=2, base=tmp_path)
    (failed,) = landing.failed_pages(pages).collect()
    assert (failed.page_offset, "FileNotFoundError" in failed.error) == (20, True)
    assert landing.elements(pages).count() == 20


def test_request_of_the_service(monkeypatch):
    asked = []

    class Answer:
        def __enter__(self):
            return self

        def __exit__(self, *_):
            return False

        def read(self):
            return b"[]"

    monkeypatch.setattr("urllib.request.urlopen", lambda url, timeout: asked.append((url, timeout)) or Answer())
    options = {"dataset": "abcd-1234", "limit": "5", "order": "kenteken", "base": "https://example.org/resource"}
    assert PagedJsonReader(options).fetch(10) == "[]"
    assert PagedJsonReader({**options, "order": ""}).fetch(0) == "[]"
    assert asked == [("https://example.org/resource/abcd-1234.json?%24limit=5&%24offset=10&%24order=kenteken", 60.0),
                     ("https://example.org/resource/abcd-1234.json?%24limit=5&%24offset=0", 60.0)]


def write_key_pages(folder, dataset, records, key, limit, splits, broken=()):
    """The answers of a service that is asked for keys from one on, one file per request a reader makes.

    ``broken`` maps a part to what its first page holds instead.
    """
    target = folder / dataset
    target.mkdir(parents=True, exist_ok=True)
    order = sorted((r for r in records if r.get(key) is not None), key=lambda r: str(r[key]))
    bounds = ["", *splits, None]
    parts = list(enumerate(zip(bounds, bounds[1:]))) + [(len(bounds) - 1, (None, None))]
    for number, (low, high) in parts:
        start, skip = low, 0
        while True:
            if low is None:
                own = [r for r in records if r.get(key) is None]
            else:
                own = [r for r in order if str(r[key]) >= start and (high is None or str(r[key]) < high)]
            page = own[skip:skip + limit]
            name = "null" if start is None else quote(start, safe="") or "start"
            text = dict(broken).get(number, json.dumps(page)) if (start, skip) == (low, 0) else json.dumps(page)
            if text is not None:
                (target / f"{key}-{name}-{skip}.json").write_text(text)
            if len(page) < limit:
                break
            last = None if low is None else str(page[-1][key])
            if low is not None and last != start:
                start, skip = last, sum(str(r[key]) == last for r in page)
            else:
                skip += limit


def plates(n: int) -> list[dict]:
    return [{"kenteken": f"{chr(65 + i % 26)}{i:03d}", "merk": "VW", "new_field": i} for i in range(n)]


DATA = {
    "vehicles_raw": plates(230),
    # A plate with more records than a page holds, one whose records cross a page's end, and records without a plate.
    "vehicles_fuel_raw": [{"kenteken": "A001", "brandstof_omschrijving": f"LPG {i}"} for i in range(35)]
    + [{"kenteken": f"A1{i:02d}", "brandstof_omschrijving": "LPG"} for i in range(8)]
    + [{"kenteken": "A200", "brandstof_omschrijving": f"B{i}"} for i in range(9)]
    + [{"brandstof_omschrijving": f"none {i}"} for i in range(20)],
    "parking_address_raw": [{"areaid": str(i), "parkingaddresstype": "FB"[i % 2], "zipcode": "", "parkingaddressreference": f"m{i}"}
                            for i in range(30)],  # exactly three pages
    "charging_capacity_raw": [{"areaid": str(i), "chargingpointcapacity": i} for i in range(4)],
    "vehicles_by_postcode_raw": RECORDS,
}
KEPT = {"vehicles_raw": 230, "vehicles_fuel_raw": 72, "parking_address_raw": 15, "charging_capacity_raw": 4,
        "vehicles_by_postcode_raw": 25}


def test_loads(spark, tmp_path):
    """All five loads to the end of their datasets; running one again replaces its rows."""
    lake, pages = Lake(spark, str(tmp_path / "lake")), tmp_path / "pages"
    assert sorted(lake.create_missing()) == sorted(RAW_TABLES)
    assert lake.create_missing() == []
    for table, records in DATA.items():
        how = landing.LOADS[table]
        write_key_pages(pages, DATASETS[table], records, how.key, 10, [b for b in how.splits.split(",") if b])
        for _ in (1, 2):
            assert landing.load(lake, table, limit=10, base=pages).count() == 0
            assert lake.read("raw", table).count() == KEPT[table] and lake.incomplete(table) == {}
    vehicles = lake.read("raw", "vehicles_raw")
    assert vehicles.schema["kenteken"].metadata["comment"] == "licence plate, key"
    late = vehicles.select(landing.late_field(F.col("raw_json"), "new_field", "int").alias("n")).distinct()
    assert rows(late) == sorted(((i,) for i in range(230)), key=str)
    assert rows(vehicles.select(landing.late_field(F.col("raw_json"), "absent").alias("n")).distinct()) == [(None,)]
    fuel = lake.read("raw", "vehicles_fuel_raw")
    assert rows(fuel.select("kenteken", "brandstof_omschrijving")) == sorted(
        ((r.get("kenteken"), r["brandstof_omschrijving"]) for r in DATA["vehicles_fuel_raw"]),
        key=lambda r: tuple((v is None, str(v)) for v in r))
    capacity = lake.read("raw", "charging_capacity_raw")
    assert rows(capacity.select("chargingpointcapacity").distinct()) == [("0",), ("1",), ("2",), ("3",)]
    landing.load(lake, "charging_capacity_raw", load_id="more", limit=10, base=pages)
    assert lake.read("raw", "charging_capacity_raw").count() == 8  # another load adds


def test_failed_parts_are_fetched_again(spark, tmp_path):
    """A lost page and a body that is no JSON leave the load partial; the next run fetches those parts only."""
    lake, pages, how = Lake(spark, str(tmp_path / "lake")), tmp_path / "pages", landing.LOADS["vehicles_raw"]
    splits = how.splits.split(",")
    lost, bad = splits.index("C") + 1, splits.index("D") + 1
    write_key_pages(pages, DATASETS["vehicles_raw"], DATA["vehicles_raw"], "kenteken", 5, splits,
                    {lost: None, bad: "<html>busy</html>"}.items())
    failed = landing.load(lake, "vehicles_raw", limit=5, base=pages)
    assert sorted((row.part, row.error.split(":")[0]) for row in failed.collect()) == [
        (lost, "FileNotFoundError"), (bad, "JSONDecodeError")]
    held = [r for r in DATA["vehicles_raw"] if r["kenteken"][0] not in "CD"]
    assert lake.read("raw", "vehicles_raw").count() == len(held)
    assert lake.incomplete("vehicles_raw") == {"all": "partial"}
    with pytest.raises(IncompleteLoad):
        refresh_all(lake)
    assert refresh_all(lake, skip_missing=True, allow_incomplete=True) == []
    for page in (pages / DATASETS["vehicles_raw"]).glob("kenteken-[AB]-*"):
        page.unlink()  # what was complete is not asked for again
    write_key_pages(tmp_path / "whole", DATASETS["vehicles_raw"], DATA["vehicles_raw"], "kenteken", 5, splits)
    for page in (tmp_path / "whole" / DATASETS["vehicles_raw"]).glob("kenteken-[CD]*"):
        (pages / DATASETS["vehicles_raw"] / page.name).write_text(page.read_text())
    assert landing.load(lake, "vehicles_raw", limit=5, base=pages).count() == 0
    assert lake.read("raw", "vehicles_raw").count() == 230 and lake.incomplete("vehicles_raw") == {}


def test_sample_is_marked(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    write_pages(tmp_path, DATASETS["charging_capacity_raw"], DATA["charging_capacity_raw"], 2, 3, order="areaid")
    landing.load(lake, "charging_capacity_raw", limit=2, pages=1, base=tmp_path)
    assert lake.read("raw", "charging_capacity_raw").count() == 2
    assert lake.incomplete("charging_capacity_raw") == {"all": "sample"}


def test_bad_body_among_good_ones(spark):
    pages = spark.createDataFrame([("d", 0, 0, '[{"a": 1}]', None), ("d", 1, 10, "<html>", None), ("d", 2, 20, '{"a": 1}', None),
                                   ("d", 3, 30, None, "TimeoutError: late"), ("d", 4, 40, "[]", None)],
                                  "dataset string, part int, page_offset bigint, body string, error string")
    assert landing.elements(pages).count() == 1
    assert rows(landing.failed_pages(pages), "page_offset", "error") == [
        (10, "the body is no JSON array"), (20, "the body is no JSON array"), (30, "TimeoutError: late")]


def test_request_by_key(monkeypatch):
    asked = []

    class Answer:
        def __enter__(self):
            return self

        def __exit__(self, *_):
            return False

        def read(self):
            return b"[]"

    monkeypatch.setattr("urllib.request.urlopen", lambda url, timeout: asked.append(url) or Answer())
    reader = PagedJsonReader({"dataset": "abcd-1234", "limit": "5", "key": "plate", "splits": "B", "base": "https://example.org/r"})
    assert [part[0] for part in reader.key_parts()] == [0, 1, 2]
    for part in reader.key_parts():
        assert [row[2:] for row in reader.read_part(*part)] == [(0, "[]", None)]
    wanted = [unquote_plus(url).split("&")[2] for url in asked]
    assert wanted == ["$where=plate >= '' and plate < 'B'", "$where=plate >= 'B'", "$where=plate is null"]
    assert all("%24order=plate%2C%3Aid" in url and "%24offset=0" in url for url in asked)


def test_versions(spark, tmp_path):
    """A reader that has begun finishes, a failed write changes nothing, and two versions stay."""
    folder = str(tmp_path / "t")
    versions.put(spark.range(3), folder)
    begun = versions.read(spark, folder)
    versions.put(spark.range(5), folder, "note")
    assert begun.count() == 3 and versions.read(spark, folder).count() == 5
    with pytest.raises(PySparkException):
        versions.put(spark.range(7).select(F.raise_error(F.lit("stop")).alias("id")), folder)
    assert versions.read(spark, folder).count() == 5 and versions.note_of(versions.current(spark, folder)) == "note"
    versions.put(spark.range(7), folder)
    assert versions.versions(spark, folder) == ["v000002.note", "v000004"]
    with pytest.raises(LookupError):
        versions.read(spark, str(tmp_path / "none"))


def test_field_that_does_not_fit(spark):
    df = spark.sql("""SELECT parse_json('{"a": "x"}') AS v""")
    assert df.select(landing.late_field(F.col("v"), "a", "int")).first()[0] is None
    with pytest.raises(PySparkException):
        df.select(landing.field(F.col("v"), "a", "int")).collect()


def test_replace_is_idempotent(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    for _ in range(2):
        lake.replace(spark.range(3), "curated", "t")
    assert lake.read("curated", "t").count() == 3
    with pytest.raises(ValueError):
        lake.path("bronze", "t")


def test_external_tables(spark, tmp_path):
    spark.createDataFrame([], WEATHER_HOURLY).withColumn("more", F.lit(1)).write.parquet(str(tmp_path / "w"))
    spark.createDataFrame([], EMISSIONS).write.parquet(str(tmp_path / "e"))
    assert read_weather(spark, str(tmp_path / "w")).columns == WEATHER_HOURLY.fieldNames()
    assert read_emissions(spark, str(tmp_path / "e")).columns == EMISSIONS.fieldNames()


def test_work_folder(spark):
    folder = work_folder(spark, "status")
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir")) and folder != work_folder(spark, "status")

    class Cluster:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError):
        work_folder(Cluster, "status")


def test_growing_pages_arrive_once(spark, tmp_path):
    """Pages that appear later are read from the last key of each part on; a batch that is run again changes nothing."""
    base, checkpoint, seen = tmp_path / "service", tmp_path / "c", str(tmp_path / "rows")
    (base / "d").mkdir(parents=True)

    def add(name: str, *keys) -> None:
        (base / "d" / name).write_text(json.dumps([{"k": key, "n": f"{name}-{n}"} for n, key in enumerate(keys)]))

    def run_once() -> list:
        pages = stream_pages(spark, "d", base=str(base), key="k", splits="m", limit=3)
        sink.run(pages, lambda batch, batch_id: sink.put_batch(landing.elements(batch).select(
            landing.field(F.col("value"), "k").alias("k"), landing.field(F.col("value"), "n").alias("n")), seen, batch_id),
            str(checkpoint)).awaitTermination()
        return sorted(tuple(row) for row in sink.read_batches(spark, seen).select("k", "n").collect())

    def all_of(*files: str) -> list:
        return sorted((r["k"], r["n"]) for f in files for r in json.loads((base / "d" / f).read_text()) if r["k"] is not None)

    add("a.json", "b", "c", "c", "c", "c", "c", "d", None, "q", "p")  # more records of a key than a page holds
    assert run_once() == all_of("a.json")
    add("b.json", "e", "f", "r", "d'e")
    assert run_once() == all_of("a.json", "b.json")
    assert run_once() == all_of("a.json", "b.json")
    last = max((p for p in (checkpoint / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    last.unlink()
    (checkpoint / "commits" / f".{last.name}.crc").unlink(missing_ok=True)
    assert run_once() == all_of("a.json", "b.json")
    add("c.json", "z", "k")
    assert run_once() == all_of("a.json", "b.json", "c.json")
    (base / "d" / "bad.json").write_text("no json")
    with pytest.raises(Exception, match="JSONDecodeError"):
        run_once()


def test_filters_of_a_stretch():
    assert stretch_filter("k", None, False, "x", "a") == "k >= 'a' and k <= 'x'"
    assert stretch_filter("k", "b'c", False, "x", "a") == "k > 'b''c' and k <= 'x'"
    assert stretch_filter("k", "b", True, "x", "a") == "k >= 'b' and k <= 'x'"
    with pytest.raises(ValueError):
        PagedJsonStreamReader({"dataset": "d"})


def test_inventory_of_fields(spark):
    """New fields, changed kinds, nested ones, records that are no objects, and fields that come back."""
    rows = [("1", '{"a": 1, "b": "x"}'), ("1", '{"a": null}'), ("1", "[1]"), ("2", '{"a": 1.5, "c": {"d": [true]}}'), ("2", None),
            ("3", '{"b": "y", "c": 5, "e": false}')]
    records = spark.createDataFrame(rows, "load string, record string").withColumn("raw_json", F.parse_json("record"))
    found = {tuple(row) for row in landing.field_inventory(records, "load").collect()}
    assert found == {("1", "a", "integer", 1, True), ("1", "a", "null", 1, True), ("1", "b", "text", 1, True),
                     ("2", "a", "decimal", 1, False), ("2", "c", "object", 1, True), ("3", "b", "text", 1, False),
                     ("3", "c", "integer", 1, False), ("3", "e", "boolean", 1, True)}
    types = {row.load_id: (row.n_records, row.record_type) for row in landing.record_types(records.where("load > '1'"), "load").collect()}
    assert types["2"] == (2, "OBJECT<a: DECIMAL(2,1), c: OBJECT<d: ARRAY<BOOLEAN>>>")
    assert types["3"] == (1, "OBJECT<b: STRING, c: BIGINT, e: BOOLEAN>")


def test_stretch_of_files_is_read_once(tmp_path, monkeypatch):
    """A stretch of many pages from page files is read and ordered once, not once a page, and gives the same pages."""
    from voltatlas.sources import paged
    from voltatlas.sources.paged import KeyStretch, fetch_stretch_file

    (tmp_path / "d").mkdir()
    keys = [f"{n % 37:02d}" for n in range(100)]
    (tmp_path / "d" / "a.json").write_text(json.dumps([{"k": key, "n": n} for n, key in enumerate(keys)]))
    reads, records_in = [], paged.records_in
    monkeypatch.setattr(paged, "records_in", lambda *args: reads.append(args) or records_in(*args))
    reader = PagedJsonStreamReader({"dataset": "d", "base": str(tmp_path), "key": "k", "limit": "7"})
    pages = list(reader.read(KeyStretch(0, "", "03", "30")))
    assert len(reads) == 1
    wanted = sorted(({"k": key, "n": n} for n, key in enumerate(keys) if "03" < key <= "30"), key=lambda r: r["k"])
    assert [json.loads(page[3]) for page in pages] == [wanted[n:n + 7] for n in range(0, len(wanted), 7)]
    assert [page[2] for page in pages] == list(range(0, len(wanted), 7))
    assert json.loads(fetch_stretch_file(str(tmp_path), "d", 7, "k", "03", False, "30", "", 7, 60)) == wanted[7:14]
