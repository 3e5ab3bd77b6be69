"""Tables as numbered versions: readers see the old one until the new one is complete.

A version is a folder ``v000001``, ``v000002``, ... with an optional note after a
dot. It counts once Spark has put its success marker there, which happens after
all its files are written. A failed or running write leaves the version before
it in force, and a reader that has listed its files keeps them: the version
before the newest stays until the next write.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_NAME = re.compile(r"v([0-9]{6,})(?:\.(.+))?$")
KEPT = 2


def _system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _system(spark, path)
    return system.exists(place)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders in a folder; none if there is no such folder."""
    place, system = _system(spark, folder)
    if not system.exists(place):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(place) if status.isDirectory())


def delete(spark: SparkSession, path: str) -> None:
    place, system = _system(spark, path)
    system.delete(place, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Gives a finished folder its name at once; its parents are made."""
    place, system = _system(spark, to)
    system.mkdirs(place.getParent())
    if not system.rename(_system(spark, path)[0], place):
        raise OSError(f"cannot rename {path} to {to}")


def versions(spark: SparkSession, folder: str) -> list[str]:
    """Complete versions of a table, oldest first."""
    found = [(int(match[1]), name) for name in names(spark, folder) if (match := _NAME.match(name))]
    return [name for _, name in sorted(found) if exists(spark, f"{folder}/{name}/_SUCCESS")]


def current(spark: SparkSession, folder: str) -> str | None:
    """Name of the version in force."""
    found = versions(spark, folder)
    return found[-1] if found else None


def note_of(name: str) -> str:
    return _NAME.match(name)[2] or ""


def put(df: DataFrame, folder: str, note: str = "", kept: int = KEPT, partition_by: tuple[str, ...] = ()) -> str:
    """Writes the next version and removes all but the newest ``kept``; returns the version's name."""
    spark = df.sparkSession
    numbers = [int(match[1]) for name in names(spark, folder) if (match := _NAME.match(name))]
    name = f"v{max(numbers, default=0) + 1:06d}" + (f".{note}" if note else "")
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{folder}/{name}")
    for old in versions(spark, folder)[:-kept]:
        delete(spark, f"{folder}/{old}")
    return name


def read(spark: SparkSession, folder: str) -> DataFrame:
    """The version in force."""
    name = current(spark, folder)
    if name is None:
        raise LookupError(f"no complete version of a table in {folder}")
    return spark.read.parquet(f"{folder}/{name}")
