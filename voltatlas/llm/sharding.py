"""Sharding by a lookup table that the shards fill in turns.

Every shard has an order of preference over the slots of a table of prime
size: a start and a step taken from a hash of its name. The shards take turns,
each claiming the first free slot of its order, until the table is full. So
slots are dealt almost evenly, and when a shard comes or goes few slots change
hands. A document's slot is a hash of its id; its shard is read off the table,
which is broadcast, as its size is a parameter and not the corpus.

Rows: every input row gives one row, repeated rows included; equal ids share a
shard. A null id is hashed as the empty text. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltatlas.llm.common import pick

#: A prime far above the number of shards: slots per shard differ by one at most.
SLOTS = 65_537
SHARDS = tuple(f"shard-{n:03d}" for n in range(64))


def digest(name: str, use: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{use}:{name}".encode()).digest()[:8], "big")


def lookup_table(shards: tuple[str, ...], slots: int = SLOTS) -> np.ndarray:
    """For each slot the position of its shard in the sequence given."""
    if not shards or len(set(shards)) < len(shards) or slots < len(shards):
        raise ValueError("shards must be distinct, at least one, and no more than the slots")
    if slots < 3 or any(slots % n == 0 for n in range(2, int(slots ** 0.5) + 1)):
        raise ValueError("the number of slots must be a prime above 2")  # else a step may miss slots
    at = [digest(shard, "start") % slots for shard in shards]
    by = [digest(shard, "step") % (slots - 1) + 1 for shard in shards]
    owner, free = np.full(slots, -1, dtype=np.int32), slots
    order = sorted(range(len(shards)), key=lambda shard: shards[shard])  # turns go by name, not by position
    while True:
        for shard in order:
            while owner[at[shard]] >= 0:
                at[shard] = (at[shard] + by[shard]) % slots
            owner[at[shard]] = shard
            free -= 1
            if not free:
                return owner


def owners_of(spark: SparkSession, shards: tuple[str, ...], slots: int) -> DataFrame:
    """slot and shard of the whole table: as many rows as slots, whatever the corpus."""
    return spark.createDataFrame(
        [(slot, shards[shard]) for slot, shard in enumerate(lookup_table(shards, slots).tolist())], "slot int, shard string")


def slot_of(doc_id: str, slots: int) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(slots)).cast("int")


def place(docs: DataFrame, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """doc_id, its slot, its shard, and the bytes it brings there."""
    rows = pick(docs, "doc_id", "text").select(
        "doc_id", slot_of("doc_id", slots).alias("slot"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return rows.join(F.broadcast(owners_of(docs.sparkSession, shards, slots)), "slot").select("doc_id", "slot", "shard", "n_bytes")


def write_shards(docs: DataFrame, folder: str, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS, files: int = 8,
                 columns: tuple[str, ...] = ("doc_id", "text", "lang", "source", "n_chars")) -> None:
    """Writes the named columns of the documents to one folder per shard, ``shard=<name>``, each from several tasks.

    Other columns of the table stay behind, whatever their names; ``shard`` itself
    cannot be a column, as the folders give it. Within a shard rows are dealt by
    a hash of their id and, so that an id on many rows does not fill one
    file, of their text.
    """
    if any(name.lower() == "shard" for name in columns) or "doc_id" not in columns or "text" not in columns:
        raise ValueError("doc_id and text must be written, and shard is the name of the folders")
    rows = pick(docs, *columns)
    own = rows.toDF(*(f"column_{n}" for n in range(len(columns))))
    doc_id, text = (f"column_{columns.index(name)}" for name in ("doc_id", "text"))
    placed = own.withColumns({"slot": slot_of(doc_id, slots), "part": F.pmod(F.xxhash64(doc_id, text, F.lit(5)), F.lit(files))})
    dealt = placed.join(F.broadcast(owners_of(docs.sparkSession, shards, slots)), "slot").repartition(
        len(shards) * files, "shard", "part").drop("slot", "part")
    named = [F.col(f"column_{n}").alias(name) for n, name in enumerate(columns)]
    dealt.select(*named, "shard").write.partitionBy("shard").parquet(folder)
