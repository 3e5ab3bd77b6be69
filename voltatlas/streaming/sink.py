"""What the refresh jobs share: a log of batches that is folded now and then, and the start of a query.

A log holds one folder per batch, which a replay replaces, and a base into
which earlier batches have been folded. The base is a versioned table whose
note says up to which batch it reaches, so a reader sees each batch once,
whether a fold is under way, done, or was cut short. The folders of folded
batches are deleted when the next fold is done, when no reader can need them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from voltatlas.sources import versions

AVAILABLE_NOW = {"availableNow": True}
#: A log is folded at every so-manieth batch.
FOLD_EVERY = 20


def _batch_name(batch_id: int) -> str:
    return f"batch_id={batch_id}"


def put_batch(df: DataFrame, table: str, batch_id: int, partition_by: tuple[str, ...] = ()) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{table}/{_batch_name(batch_id)}")


def batch_ids(spark: SparkSession, table: str) -> list[int]:
    """Numbers of the batches that have a finished folder."""
    found = [name for name in versions.names(spark, table) if name.startswith("batch_id=")]
    return sorted(int(name.partition("=")[2]) for name in found if versions.exists(spark, f"{table}/{name}/_SUCCESS"))


def read_batches(spark: SparkSession, table: str) -> DataFrame:
    """All batches of a table that is not folded; ``batch_id`` comes from the folder names."""
    return spark.read.option("basePath", table).parquet(*(f"{table}/{_batch_name(n)}" for n in batch_ids(spark, table)))


@dataclass(frozen=True)
class BatchLog:
    """Batches of partial results under a folder, with ``fold`` to merge them, kept apart by ``partition_by``."""

    spark: SparkSession
    folder: str
    fold: Callable[[DataFrame], DataFrame]
    partition_by: tuple[str, ...] = ()

    @property
    def batches(self) -> str:
        return f"{self.folder}/batches"

    @property
    def base(self) -> str:
        return f"{self.folder}/base"

    def folded_to(self) -> int:
        """The last batch the base holds; -1 without a base."""
        name = versions.current(self.spark, self.base)
        return int(versions.note_of(name)) if name else -1

    def put(self, df: DataFrame, batch_id: int) -> None:
        put_batch(df, self.batches, batch_id, self.partition_by)

    def read(self, upto: int | None = None) -> DataFrame | None:
        """Partial results of all batches, or of those up to one; None if there are none."""
        name = versions.current(self.spark, self.base)
        folded = int(versions.note_of(name)) if name else -1
        wanted = [n for n in batch_ids(self.spark, self.batches) if n > folded and (upto is None or n <= upto)]
        # Each folder is its own root, so the partition columns below it are found and its name adds none.
        parts = [f"{self.batches}/{_batch_name(n)}" for n in wanted]
        if name:
            parts.insert(0, f"{self.base}/{name}")
        read = [self.spark.read.option("basePath", part).parquet(part) for part in parts if self._filled(part)]
        whole = None
        for part in read:
            whole = part if whole is None else whole.unionByName(part)
        return whole

    def _filled(self, part: str) -> bool:
        """A partitioned folder without any partition has no columns to read."""
        return not self.partition_by or bool(versions.names(self.spark, part))

    def fold_upto(self, batch_id: int, keep: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
        """Folds the batches up to one into the base; ``keep`` may leave out what nobody reads any more."""
        before = self.folded_to()
        rows = self.read(upto=batch_id)
        if batch_id <= before or rows is None:
            return
        versions.put(self.fold(keep(rows)), self.base, str(batch_id), partition_by=self.partition_by)
        for old in batch_ids(self.spark, self.batches):
            if old <= before:  # also the version before this one holds it
                versions.delete(self.spark, f"{self.batches}/{_batch_name(old)}")

    def fold_now_and_then(self, batch_id: int, every: int = FOLD_EVERY, **how) -> None:
        """At every so-manieth batch, folds those before it; the batch itself may still be replayed."""
        if every and batch_id and batch_id % every == 0:
            self.fold_upto(batch_id - 1, **how)


def run(
    stream: DataFrame,
    each_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    trigger: dict[str, object] | None = None,
    partitions: int | None = None,
) -> StreamingQuery:
    """Starts the query; by default it works through what is there and stops.

    ``partitions`` is the number of state partitions. A query takes it from the
    session when it first starts, so the session's own setting is put back after.
    """
    writer = (
        stream.writeStream.foreachBatch(each_batch)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
    )
    if partitions is None:
        return writer.start()
    conf, key = stream.sparkSession.conf, "spark.sql.shuffle.partitions"
    before = conf.get(key)
    conf.set(key, partitions)
    try:
        return writer.start()
    finally:
        conf.set(key, before)


def fold(partials: DataFrame, keys: list[str]) -> DataFrame:
    """Adds up the measures of all batches per key."""
    measures = [name for name in partials.columns if name not in (*keys, "batch_id")]
    return partials.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in measures])
