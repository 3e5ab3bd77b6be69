from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import GIVEN, ODD, documents
from voltatlas.llm import sharding


def brute(shards: list[str], slots: int) -> list[int]:
    """Whole preference lists, one claim per turn."""
    lists = [[(sharding.digest(s, "start") % slots + k * (sharding.digest(s, "step") % (slots - 1) + 1)) % slots
              for k in range(slots)] for s in shards]
    owner: list = [None] * slots
    while None in owner:
        for shard in sorted(range(len(shards)), key=shards.__getitem__):
            free = next((slot for slot in lists[shard] if owner[slot] is None), None)
            if free is None:
                return owner
            owner[free] = shard
    return owner


@pytest.mark.parametrize("count,slots", [(1, 3), (3, 7), (5, 101), (16, 17), (7, 211)])
def test_table(count, slots):
    shards = [f"s{n}" for n in range(count)]
    found = sharding.lookup_table(tuple(shards), slots)
    assert found.tolist() == brute(shards, slots)
    sizes = np.bincount(found, minlength=count)
    assert sizes.max() - sizes.min() <= 1


def test_few_slots_move():
    names = tuple(f"s{n}" for n in range(20))
    whole, less = sharding.lookup_table(names, 10_007), sharding.lookup_table(names[:-1], 10_007)
    moved = np.mean((whole != less) & (whole != 19))
    assert moved < 0.1
    turned = sharding.lookup_table(names[::-1], 10_007)
    assert [names[n] for n in whole] == [names[::-1][n] for n in turned]  # the order given does not matter


@pytest.mark.parametrize("shards,slots", [((), 7), (("a", "a"), 7), (("a", "b"), 8), (("a", "b", "c", "d"), 3)])
def test_refused(shards, slots):
    with pytest.raises(ValueError):
        sharding.lookup_table(shards, slots)


def test_placement(spark):
    docs = spark.read.parquet(f"{GIVEN}/sf0.1/documents.parquet")
    found = sharding.place(docs).collect()
    assert len(found) == docs.count()
    owner = sharding.lookup_table(sharding.SHARDS)
    assert all(row.shard == sharding.SHARDS[owner[row.slot]] for row in found)
    counts = Counter(row.shard for row in found)
    assert len(counts) == 64 and max(counts.values()) < 2 * min(counts.values())


def test_rows_and_files(spark, tmp_path):
    docs = documents(spark, ODD)
    found = sharding.place(docs).collect()
    assert Counter(row.doc_id for row in found) == Counter(row[0] for row in ODD)
    assert len({row.shard for row in found if row.doc_id == 4}) == 1
    assert {row.doc_id: row.n_bytes for row in found}[1] == 0
    assert sharding.place(documents(spark, [])).collect() == []
    clashing = docs.selectExpr("*", "3 as part", "'x' as shard", "'y' as SHARD", "1 as column_0")
    sharding.write_shards(clashing, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard"]
    assert Counter((row.doc_id, row.shard) for row in back.collect()) == Counter((row.doc_id, row.shard) for row in found)
    assert Counter(row.text for row in back.collect()) == Counter(row[1] for row in ODD)
    few = ("north", "south")
    sharding.write_shards(docs, str(tmp_path / "few"), few, slots=11, files=2, columns=("doc_id", "text"))
    back = spark.read.parquet(str(tmp_path / "few"))
    assert Counter((row.doc_id, row.shard) for row in back.collect()) == Counter(
        (row.doc_id, row.shard) for row in sharding.place(docs, few, 11).collect())
    for columns in (("doc_id", "text", "Shard"), ("text",)):
        with pytest.raises(ValueError):
            sharding.write_shards(docs, str(tmp_path / "no"), columns=columns)
