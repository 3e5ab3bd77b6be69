"""Paged JSON datasets as a Spark data source.

``spark.read.format("paged_json")`` reads a dataset to its end: the values of
``key`` are cut into parts at ``splits``, and each part is read page by page in
the order of the key, asking for keys from the last one seen on, until a page
is short. So no request carries a deep offset, and rows without the key form
a part of their own. With ``pages`` it reads that many pages by offset instead,
which is a sample. Parts, or pages of a sample, are spread over ``parallel``
tasks, which also is the number of requests the server sees at a time. Each
page becomes one row with its body as text. Bodies are parsed by Spark
afterwards; Python looks only at a page's length and last key.

Options: ``dataset``, ``limit``, ``key`` and ``splits`` (comma-separated lower
bounds), ``parts`` (numbers of the parts to read, all by default), ``pages``,
``start`` (first offset of a sample), ``order`` (column, optional), ``parallel``,
``timeout`` and ``retries`` (seconds and count), ``on_error`` (``fail`` or
``report``; a part that fails ends with a row that says so), ``base`` (address
of the service, or a folder of page files for a dry run, which every executor
must see under this path).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

PAGE_SCHEMA = "dataset string, part int, page_offset bigint, body string, error string"

# The public open-data service and its dataset keys.
OPEN_DATA_SERVICE = "https://opendata.rdw.nl/resource"
DATASETS = {
    "vehicles_raw": "m9d7-ebf2",
    "vehicles_fuel_raw": "8ys7-d773",
    "vehicles_by_postcode_raw": "8wbe-pu7d",
    "parking_address_raw": "ygq4-hh5q",
    "charging_capacity_raw": "b3us-f26s",
}


def fetch_http(base: str, dataset: str, limit: int, offset: int, order: str, timeout: float) -> str:
    """Body of one page; a bad status raises."""
    from urllib.parse import urlencode
    from urllib.request import urlopen

    query = {"$limit": limit, "$offset": offset}
    if order:
        query["$order"] = order
    with urlopen(f"{base}/{dataset}.json?{urlencode(query)}", timeout=timeout) as answer:
        return answer.read().decode("utf-8")


def fetch_file(base: str, dataset: str, limit: int, offset: int, order: str, timeout: float) -> str:
    """Body of one page kept as ``<base>/<dataset>/<order or 'default'>-<offset>.json``."""
    with open(f"{base}/{dataset}/{order or 'default'}-{offset}.json", encoding="utf-8") as page:
        return page.read()


def key_filter(key: str, low: str | None, high: str | None) -> str:
    """Rows whose key lies from ``low`` up to ``high``; of no key if both are None."""
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    if low is None:
        return f"{key} is null"
    return f"{key} >= {quoted(low)}" + (f" and {key} < {quoted(high)}" if high is not None else "")


def fetch_keys_http(base: str, dataset: str, limit: int, key: str, low: str | None, high: str | None, skip: int,
                    timeout: float) -> str:
    """Body of one page of a key range in the order of the key; rows of one key keep their order by row id."""
    from urllib.parse import urlencode
    from urllib.request import urlopen

    query = {"$limit": limit, "$offset": skip, "$where": key_filter(key, low, high), "$order": f"{key},:id"}
    with urlopen(f"{base}/{dataset}.json?{urlencode(query)}", timeout=timeout) as answer:
        return answer.read().decode("utf-8")


def fetch_keys_file(base: str, dataset: str, limit: int, key: str, low: str | None, high: str | None, skip: int,
                    timeout: float) -> str:
    """Body of one page kept as ``<base>/<dataset>/<key>-<quoted low or 'null'>-<skip>.json``."""
    from urllib.parse import quote

    start = "null" if low is None else quote(low, safe="") or "start"
    with open(f"{base}/{dataset}/{key}-{start}-{skip}.json", encoding="utf-8") as page:
        return page.read()


def stretch_filter(key: str, after: str | None, inclusive: bool, upto: str, low: str) -> str:
    """Rows of a part whose key comes after one seen (or is it, if inclusive), up to the last one of the batch."""
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    start = f"{key} >= {quoted(low)}" if after is None else f"{key} {'>=' if inclusive else '>'} {quoted(after)}"
    return f"{start} and {key} <= {quoted(upto)}"


def last_key_http(base: str, dataset: str, key: str, low: str, high: str | None, timeout: float) -> str | None:
    """The greatest key of a part that the service has now."""
    from urllib.parse import urlencode
    from urllib.request import urlopen

    query = {"$select": f"max({key}) as last", "$where": key_filter(key, low, high)}
    with urlopen(f"{base}/{dataset}.json?{urlencode(query)}", timeout=timeout) as answer:
        found = json.loads(answer.read().decode("utf-8"))
    return found[0].get("last") if found else None


def fetch_stretch_http(base: str, dataset: str, limit: int, key: str, after: str | None, inclusive: bool, upto: str, low: str,
                       skip: int, timeout: float) -> str:
    from urllib.parse import urlencode
    from urllib.request import urlopen

    query = {"$limit": limit, "$offset": skip, "$where": stretch_filter(key, after, inclusive, upto, low), "$order": f"{key},:id"}
    with urlopen(f"{base}/{dataset}.json?{urlencode(query)}", timeout=timeout) as answer:
        return answer.read().decode("utf-8")


def records_in(base: str, dataset: str, key: str) -> Iterator[dict]:
    """Records with the key in a folder of page files, each line of a file an array; for a dry run of a stream."""
    import os

    folder = f"{base}/{dataset}"
    for name in sorted(os.listdir(folder)) if os.path.isdir(folder) else []:
        if name[0] not in "._":
            with open(f"{folder}/{name}", encoding="utf-8") as lines:
                for line in lines:
                    yield from (record for record in json.loads(line) if record.get(key) is not None)


def last_key_file(base: str, dataset: str, key: str, low: str, high: str | None, timeout: float) -> str | None:
    keys = (str(record[key]) for record in records_in(base, dataset, key))
    return max((found for found in keys if found >= low and (high is None or found < high)), default=None)


def fetch_stretch_file(base: str, dataset: str, limit: int, key: str, after: str | None, inclusive: bool, upto: str, low: str,
                       skip: int, timeout: float) -> str:
    return json.dumps(stretch_in_files(base, dataset, key, after, inclusive, upto, low)[skip:skip + limit])


def stretch_in_files(base: str, dataset: str, key: str, after: str | None, inclusive: bool, upto: str, low: str) -> list[dict]:
    """Records of a stretch in the order of the key, read once from the page files, so its pages are slices of it."""
    def wanted(found: str) -> bool:
        start = found >= low if after is None else found >= after if inclusive else found > after
        return start and found <= upto

    return sorted((record for record in records_in(base, dataset, key) if wanted(str(record[key]))), key=lambda r: str(r[key]))


@dataclass
class PageRun(InputPartition):
    offsets: list[int]


@dataclass
class KeyRuns(InputPartition):
    """Parts of the key's values: number, lower and upper bound."""

    parts: list[tuple[int, str | None, str | None]]


class PagedJsonReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.dataset = options["dataset"]
        self.limit = int(options.get("limit", 1000))
        self.key = options.get("key", "")
        self.splits = [bound for bound in options.get("splits", "").split(",") if bound]
        self.parts = options.get("parts", "")
        self.pages = int(options.get("pages", 0 if self.key else 1))
        self.start = int(options.get("start", 0))
        self.order = options.get("order", "")
        self.parallel = int(options.get("parallel", 8))
        self.timeout = float(options.get("timeout", 60))
        self.retries = int(options.get("retries", 0))
        self.on_error = options.get("on_error", "fail")
        self.base = options.get("base", OPEN_DATA_SERVICE)
        if self.on_error not in ("fail", "report"):
            raise ValueError("on_error must be 'fail' or 'report'")

    def key_parts(self) -> list[tuple[int, str | None, str | None]]:
        bounds = ["", *self.splits, None]
        parts = [(n, low, high) for n, (low, high) in enumerate(zip(bounds, bounds[1:]))] + [(len(bounds) - 1, None, None)]
        wanted = {int(number) for number in self.parts.split(",") if number}
        return [part for part in parts if not wanted or part[0] in wanted]

    def partitions(self) -> list[InputPartition]:
        if not self.pages:
            parts = self.key_parts()
            return [KeyRuns(parts[task::self.parallel]) for task in range(min(self.parallel, len(parts)))]
        offsets = range(self.start, self.start + self.pages * self.limit, self.limit)
        return [PageRun(list(offsets[task::self.parallel])) for task in range(min(self.parallel, self.pages))]

    def fetch(self, offset: int) -> str:
        fetch = fetch_http if self.base.startswith("http") else fetch_file
        return fetch(self.base, self.dataset, self.limit, offset, self.order, self.timeout)

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if isinstance(partition, KeyRuns):
            for part, low, high in partition.parts:
                yield from self.read_part(part, low, high)
            return
        for offset in partition.offsets:
            body, error = self.attempt(lambda: self.fetch(offset))
            yield self.dataset, offset // self.limit, offset, body, error

    def attempt(self, fetch: Callable[[], str]) -> tuple[str | None, str | None]:
        """A body, or after the retries the reason why there is none."""
        error = None
        for attempt in range(self.retries + 1):
            try:
                return fetch(), None
            except Exception as problem:  # every failure is either raised or reported
                error = f"{type(problem).__name__}: {problem}"
                if attempt == self.retries and self.on_error == "fail":
                    raise
        return None, error

    def fetch_page(self, low: str | None, high: str | None, skip: int) -> str:
        fetch = fetch_keys_http if self.base.startswith("http") else fetch_keys_file
        body = fetch(self.base, self.dataset, self.limit, self.key, low, high, skip, self.timeout)
        if not isinstance(json.loads(body), list):
            raise ValueError("the body is no JSON array")
        return body

    def read_part(self, part: int, low: str | None, high: str | None) -> Iterator[tuple]:
        """Pages of one key range until a short one. A page starts at the last key seen and skips its rows that were seen."""
        seen = skip = 0
        while True:
            start, passed = low, skip
            body, error = self.attempt(lambda: self.fetch_page(start, high, passed))
            yield self.dataset, part, seen, body, error
            if error is not None:
                return
            records = json.loads(body)
            seen += len(records)
            if len(records) < self.limit:
                return
            last = None if low is None else str(records[-1][self.key])
            if low is not None and last != low:
                low, skip = last, sum(str(record[self.key]) == last for record in records)
            else:
                skip += len(records)


@dataclass
class KeyStretch(InputPartition):
    """Keys of a part that a batch reads: those after the last one seen, up to the last one there is."""

    part: int
    low: str
    after: str | None
    upto: str


class PagedJsonStreamReader(DataSourceStreamReader):
    """A dataset that grows, as a stream of pages: the offset is the last key seen of each part.

    Keys that come later in the order of a part are read once each. A record
    that turns up under a key that has been passed is not seen; a load that is replaced brings it.
    Records without the key are not part of the stream.
    """

    def __init__(self, options: dict[str, str]) -> None:
        self.pages = PagedJsonReader(options)
        if not self.pages.key:
            raise ValueError("a stream of pages needs the option key")
        self.http = self.pages.base.startswith("http")

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        last_key, pages = last_key_http if self.http else last_key_file, self.pages
        found = {}
        for part, low, high in pages.key_parts():
            if low is None:
                continue
            last, error = pages.attempt(lambda: last_key(pages.base, pages.dataset, pages.key, low, high, pages.timeout))
            if error is not None:
                raise OSError(error)  # an offset must not go back
            if last is not None:
                found[str(part)] = last
        return found

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        lows = {str(part): low for part, low, _ in self.pages.key_parts()}
        return [KeyStretch(int(part), lows[part], start.get(part), upto)
                for part, upto in sorted(end.items()) if start.get(part) is None or start[part] < upto]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if not self.http:
            yield from self.read_files(partition)
            return
        fetch, pages = fetch_stretch_http, self.pages
        after, inclusive, skip, seen = partition.after, False, 0, 0
        while True:
            where = (after, inclusive, partition.upto, partition.low, skip)
            body, error = pages.attempt(lambda: fetch(pages.base, pages.dataset, pages.limit, pages.key, *where, pages.timeout))
            if error is not None:
                raise OSError(error)  # the batch is run again; nothing is passed over
            records = json.loads(body)
            if records:
                yield pages.dataset, partition.part, seen, body, None
            seen += len(records)
            if len(records) < pages.limit:
                return
            last = str(records[-1][pages.key])
            if inclusive and last == after:
                skip += len(records)
            else:
                after, inclusive, skip = last, True, sum(str(record[pages.key]) == last for record in records)

    def read_files(self, partition: InputPartition) -> Iterator[tuple]:
        """The same pages from a folder of page files: the stretch is read and put in order once, not once a page."""
        pages = self.pages
        rows, error = pages.attempt(lambda: stretch_in_files(
            pages.base, pages.dataset, pages.key, partition.after, False, partition.upto, partition.low))
        if error is not None:
            raise OSError(error)  # the batch is run again; nothing is passed over
        for seen in range(0, len(rows), pages.limit):
            yield pages.dataset, partition.part, seen, json.dumps(rows[seen:seen + pages.limit]), None

    def commit(self, end: dict) -> None:
        pass


class PagedJson(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> str:
        return PAGE_SCHEMA

    def reader(self, schema) -> PagedJsonReader:
        return PagedJsonReader(self.options)

    def streamReader(self, schema) -> PagedJsonStreamReader:
        return PagedJsonStreamReader(self.options)


def read_pages(spark: SparkSession, dataset: str, **options: object) -> DataFrame:
    """Pages of a dataset, one row each."""
    spark.dataSource.register(PagedJson)
    reader = spark.read.format("paged_json").option("dataset", dataset)
    for key, value in options.items():
        reader = reader.option(key, str(value))
    return reader.load()


def stream_pages(spark: SparkSession, dataset: str, **options: object) -> DataFrame:
    """Pages of a dataset that grows, as a stream; ``key`` and ``splits`` say in which order and parts."""
    spark.dataSource.register(PagedJson)
    reader = spark.readStream.format("paged_json").option("dataset", dataset)
    for key, value in options.items():
        reader = reader.option(key, str(value))
    return reader.load()
