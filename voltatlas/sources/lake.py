"""Three table layers as folders of parquet.

Models are versioned tables. A raw table consists of loads, each a versioned
table of its own, so running a load again replaces its rows. Telemetry, which
only grows, is one folder by day.
"""

from __future__ import annotations

import sys
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

from voltatlas.functions import MONTH_OF
from voltatlas.sources import versions
from voltatlas.sources.changes import TIMES, difference, with_times
from voltatlas.sources.schemas import DAY_OF, EMISSIONS, LAYERS, RAW_TABLES, WEATHER_HOURLY

#: What a load's version says about its rows; a complete load says nothing.
PARTIAL, SAMPLE = "partial", "sample"


class MissingTable(LookupError):
    """A table was read that nothing has written."""


@dataclass(frozen=True)
class Lake:
    """Tables under ``root/<layer>/<table>``."""

    spark: SparkSession
    root: str

    def path(self, layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"no layer {layer!r}, expected one of {LAYERS}")
        return f"{self.root}/{layer}/{table}"

    def exists(self, layer: str, table: str) -> bool:
        return bool(self.folders(layer, table))

    def loads(self, table: str) -> dict[str, str]:
        """The version in force of each load of a raw table."""
        folder = self.path("raw", table)
        found = {name: versions.current(self.spark, f"{folder}/{name}") for name in versions.names(self.spark, folder)}
        return {name: version for name, version in found.items() if version}

    def folders(self, layer: str, table: str) -> list[str]:
        """The folders of parquet files a table consists of at this moment."""
        folder = self.path(layer, table)
        if layer == "raw" and table not in DAY_OF:
            return [f"{folder}/{name}/{version}" for name, version in self.loads(table).items()]
        version = versions.current(self.spark, folder)
        if version:
            return [f"{folder}/{version}"]
        return [folder] if versions.exists(self.spark, f"{folder}/_SUCCESS") else []

    def read(self, layer: str, table: str) -> DataFrame:
        folders = self.folders(layer, table)
        if not folders:
            raise MissingTable(f"{layer}.{table} has not been written")
        reader = self.spark.read
        if layer == "raw" and table in RAW_TABLES:
            schema = StructType([*RAW_TABLES[table]])
            reader = reader.schema(schema.add(DAY_OF[table][0], DateType()) if table in DAY_OF else schema)
        return reader.parquet(*folders)

    def create_missing(self, tables: dict[str, StructType] | None = None) -> list[str]:
        """Empty raw tables with types and column comments, where there are none yet."""
        created = []
        for table, schema in (tables or RAW_TABLES).items():
            if not self.exists("raw", table):
                self.append(self.spark.createDataFrame([], schema), table)
                created.append(table)
        return created

    def _rows(self, df: DataFrame, table: str) -> DataFrame:
        return df.select(*[df[field.name].cast(field.dataType).alias(field.name) for field in RAW_TABLES[table]])

    def append(self, df: DataFrame, table: str) -> None:
        """Adds rows to a raw table, column by column in the table's order."""
        if table in DAY_OF:
            day, moment = DAY_OF[table]
            self._rows(df, table).withColumn(day, F.to_date(moment)).write.partitionBy(day).mode("append").parquet(
                self.path("raw", table))
        else:
            self.put_load(df, table, f"rows-{uuid.uuid4().hex}")

    def put_load(self, df: DataFrame, table: str, load_id: str, note: str = "") -> None:
        """Replaces the rows of one load of a raw table; ``note`` marks rows that are not all there are.

        What changes against the version before is kept beside the table for
        those who follow it. The first version stays, as the changes start from it.
        """
        folder = f"{self.path('raw', table)}/{load_id}"
        for name in set(versions.names(self.spark, folder)) - set(versions.versions(self.spark, folder)):
            versions.delete(self.spark, f"{folder}/{name}")  # left by a write that failed
        self._note_changes(table, load_id)
        versions.put(self._rows(df, table), folder, note, kept=sys.maxsize)
        self._note_changes(table, load_id)
        for name in versions.versions(self.spark, folder)[1:-versions.KEPT]:
            versions.delete(self.spark, f"{folder}/{name}")

    def _changes(self, table: str) -> str:
        return f"{self.root}/raw_changes/{table}"

    def _note_changes(self, table: str, load_id: str) -> None:
        """Writes the changes that made a version of a load, where a write that was cut short has not."""
        folder, known = f"{self.path('raw', table)}/{load_id}", f"{self._changes(table)}/{load_id}"
        found = versions.versions(self.spark, folder)
        for old, new in zip(found, found[1:]):
            if new in versions.names(self.spark, known) or new != found[-1]:
                continue
            schema = StructType([*RAW_TABLES[table]])
            old_rows, new_rows = (self.spark.read.schema(schema).parquet(f"{folder}/{name}") for name in (old, new))
            staged = f"{self.root}/_staged/{uuid.uuid4().hex}"
            difference(old_rows, new_rows).write.parquet(staged)
            versions.move(self.spark, staged, f"{known}/{new}")

    def stream(self, table: str, raw_json: bool = False) -> DataFrame:
        """The rows that loads add to a raw table, as a stream of signed rows (``times``).

        The first version of a load brings its rows; a version that replaces
        another brings what it adds and withdraws what it leaves out.
        """
        for load_id in self.loads(table):
            self._note_changes(table, load_id)
        schema = StructType([field for field in RAW_TABLES[table] if raw_json or field.name != "raw_json"])
        first = self.spark.readStream.schema(schema).parquet(f"{self.path('raw', table)}/*/v000001*")
        changed = self.spark.readStream.schema(StructType([*schema, StructField(TIMES, LongType())])).parquet(
            f"{self._changes(table)}/*/v*")
        return with_times(first).unionByName(changed)

    def incomplete(self, table: str) -> dict[str, str]:
        """Loads of a raw table that do not hold all rows, and why."""
        if table in DAY_OF:
            return {}
        notes = {name: versions.note_of(version) for name, version in self.loads(table).items()}
        return {name: note for name, note in notes.items() if note}

    def replace(self, df: DataFrame, layer: str, table: str) -> None:
        """Replaces a table at once; running it twice leaves the same rows."""
        versions.put(df, self.path(layer, table))

    def mount(self) -> list[str]:
        """Makes the written tables known to SQL as ``layer.table``, for reports that come as SQL text.

        The names stand for the versions in force now; mount again after a refresh.
        """
        mounted = []
        for layer in LAYERS:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
        for layer, table in _known_tables():
            folders = self.folders(layer, table)
            if not folders:
                continue
            name = f"{layer}.{table}"
            if layer == "raw" and table in DAY_OF:
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")
                self.spark.catalog.createTable(name, path=folders[0], source="parquet")
                self.spark.catalog.recoverPartitions(name)
            else:
                parts = " UNION ALL ".join(f"SELECT * FROM parquet.`{folder}`" for folder in folders)
                self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {parts}")
            mounted.append(name)
        return mounted


def _known_tables() -> list[tuple[str, str]]:
    from voltatlas.plans.refresh import MODELS

    return [("raw", table) for table in RAW_TABLES] + [(model.layer, model.name) for model in MODELS]


def read_weather(spark: SparkSession, path: str) -> DataFrame:
    """External hourly weather, under the column names the models use; of a table kept by month also the month."""
    found = spark.read.parquet(path)
    return found.select(*WEATHER_HOURLY.fieldNames(), *[name for name in (MONTH_OF,) if name in found.columns])


def write_weather(weather: DataFrame, path: str) -> None:
    """Keeps hourly weather in folders by month, so that reads from a year on leave out the folders before.

    File statistics do not prune on times without a zone. Rows are dealt by month,
    and a month with too many of them goes to several tasks.
    """
    months = weather.select(*WEATHER_HOURLY.fieldNames()).withColumn(MONTH_OF, F.trunc("time", "MM"))
    months.hint("rebalance", MONTH_OF).write.mode("overwrite").partitionBy(MONTH_OF).parquet(path)


def read_emissions(spark: SparkSession, path: str) -> DataFrame:
    """External emissions series."""
    return spark.read.parquet(path).select(*EMISSIONS.fieldNames())
