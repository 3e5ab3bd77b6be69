"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltatlas.session import work_folder

#: Whitespace that separates words: space and the controls tab to carriage return.
SPACES = "\\x20\\x09-\\x0D"
#: Rows handled before a Python task hands its output on, counted in characters of text.
CHARS_AT_ONCE = 500_000


#: Bytes of an Arrow batch. Spark counts batches in rows otherwise, and a row may hold a long text or a block of sets.
BATCH_BYTES = "4m"


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns and no others.

    Names are matched exactly and the first match counts, so a table may carry
    further columns whose names clash with these or with an operator's own.
    As every operator begins here, it also bounds the bytes of Arrow batches in the session.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    at = [df.columns.index(name) for name in names]
    return df.toDF(*(f"column_{i}" for i in range(len(df.columns)))).select(
        *(F.col(f"column_{i}").alias(name) for i, name in zip(at, names)))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; also lets Python tasks import this package from its folder where it is not installed."""
    own = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if own not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (known, own)))
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Writes a table to the folder all executors share and reads it back, so that later steps start from files."""
    spark = df.sparkSession
    folder = work_folder(spark, f"llm-{purpose}")
    df.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def id_remainder(doc_id: str, divisor: int) -> Column:
    """crc32 of the id written as text, modulo a number; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % F.lit(divisor)


def spread_sample(rows: DataFrame, group: str, per_group: int, key: str = "doc_id") -> DataFrame:
    """At most ``per_group`` ids of each group, spread evenly over the ids by hash; columns group and key.

    Ids fall into ``per_group`` hash bins and each bin keeps one, so the bound
    holds for tables of any size and no sort or window is needed.
    """
    return rows.where(F.col(group).isNotNull() & F.col(key).isNotNull()).groupBy(
        F.col(group), F.pmod(F.xxhash64(F.col(key), F.lit(17)), F.lit(per_group)).alias("bin")).agg(
        F.min(F.col(key)).alias(key)).select(group, key)


def in_chunks(batches: Iterator[pa.RecordBatch], text: str = "text",
              most: int = CHARS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that a chunk holds few characters, or a single row."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False)
        start = total = 0
        for row, size in enumerate(sizes.tolist()):
            if total and total + size > most:
                yield batch.slice(start, row - start)
                start, total = row, 0
            total += size
        if start < len(sizes):
            yield batch.slice(start)

