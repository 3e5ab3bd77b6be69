from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import GIVEN
from voltatlas.llm import grid_join

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows: list[tuple], cosine: float = 0.95) -> Counter:
    usable = [n for n, (vec_id, x) in enumerate(rows) if vec_id is not None and x and all(
        v is not None and np.isfinite(v) for v in x) and any(x)]
    parent = {n: n for n in usable}
    links = Counter()

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in usable:
        for b in usable:
            if a < b and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(rows[n][1], dtype=np.float32).astype(float) for n in (a, b))
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= cosine:
                    links[a] += 1
                    links[b] += 1
                    parent[find(a)] = find(b)
    least: dict = {}
    for n in usable:
        least[find(n)] = min(least.get(find(n), rows[n][0]), rows[n][0])
    out = Counter()
    for n, (vec_id, _) in enumerate(rows):
        component = least[find(n)] if n in parent else vec_id
        out[vec_id, links[n], component, vec_id is not None and vec_id == component] += 1
    return out


def result(spark, rows: list[tuple]) -> Counter:
    table = spark.createDataFrame([(vec_id, x, 1) for vec_id, x in rows], SCHEMA).selectExpr(
        "*", "1 as at", "'x' as vector", "'y' as place", "3 as copies")
    return Counter(map(tuple, grid_join.near_copies(table).collect()))


def clustered(seed: int, width: int) -> list[tuple]:
    rng = np.random.default_rng(seed)
    rows = []
    for size in (1, 2, 5, 30, 60):
        centre = rng.normal(size=width)
        rows += [(centre + rng.normal(size=width) * s).tolist() for s in rng.uniform(0.02, 0.45, size)]
    rows += [rows[0]] * 3 + [(2 * np.array(rows[40])).tolist()] * 2
    order = rng.permutation(len(rows))
    return [(int(n) * 2, rows[at]) for n, at in enumerate(order)]


@pytest.mark.parametrize("seed,width,block,leaf", [(1, 16, 2048, 512), (2, 16, 64, 8), (3, 3, 64, 16), (4, 64, 100, 32), (5, 1, 64, 8)])
def test_against_all_pairs(spark, monkeypatch, seed, width, block, leaf):
    """Small blocks and leaves make the halving and the pairs of blocks count."""
    monkeypatch.setattr(grid_join, "BLOCK", block)
    monkeypatch.setattr(grid_join, "LEAF", leaf)
    monkeypatch.setattr(grid_join, "ROWS_PER_RANGE", 40)
    rows = clustered(seed, width)
    assert result(spark, rows) == brute(rows)


def test_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, nan]), (5, [inf, 1.0]), (6, [1.0, None]), (None, [1.0, 1.0]),
            (7, [1.0, 1.0]), (8, [1.0, 1.0]), (8, [1.0, 1.0]), (9, [2.0, 2.0]), (10, [1.0, -0.0]), (11, [1.0, 0.0]),
            (12, [1.0, 1.0, 1.0]), (13, [1.0, 1.0, 1.001]), (14, [1e-30, 1e-30]), (15, [3e38, 3e38]), (8, [-1.0, 0.0])]
    assert result(spark, rows) == brute(rows)
    assert result(spark, []) == Counter()
    assert result(spark, [(1, None), (None, None)]) == Counter({(1, 0, 1, True): 1, (None, 0, None, False): 1})


def test_wide_vectors(spark, monkeypatch):
    monkeypatch.setattr(grid_join, "MOST_DIMENSIONS", 8)
    rows = clustered(6, 16)
    assert result(spark, rows) == brute(rows)


def test_roots_follow_long_chains():
    i = np.arange(199)
    assert (grid_join.roots(i, i + 1, 200) == 0).all()
    assert grid_join.roots(np.array([3]), np.array([1]), 4).tolist() == [0, 1, 2, 1]


def test_given_embeddings(spark):
    table = spark.read.parquet(f"{GIVEN}/sf0.01/embeddings.parquet")
    rows = [(row.vec_id, row.embedding) for row in table.collect()]
    assert Counter(map(tuple, grid_join.near_copies(table).collect())) == brute(rows)


def test_directions_of_wide_vectors(spark, monkeypatch):
    """Beyond the width whose moments are gathered the same principal directions come from a block, and the result is the same."""
    rng = np.random.default_rng(6)
    base = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    x = (rng.standard_normal((300, 40)) * np.r_[np.linspace(3, 2, grid_join.DIRECTIONS), np.full(40 - grid_join.DIRECTIONS, 0.05)]) @ base.T
    nodes = spark.createDataFrame([(row.tolist(),) for row in x], "vector array<double>")
    whole = grid_join.directions(nodes, 40)
    monkeypatch.setattr(grid_join, "MOST_DIMENSIONS", 8)
    block = grid_join.directions(nodes, 40)
    assert np.linalg.svd(whole.T @ block)[1].min() > 0.999  # the same space
    assert grid_join.by_power(nodes.limit(0), 40).shape == (40, grid_join.DIRECTIONS)
    rows = clustered(7, 16)
    assert result(spark, rows) == brute(rows)


def test_block_pairs_are_not_shuffled(spark, monkeypatch):
    """Blocks come to their pairs from the files, whatever the number of pairs; each pair once."""
    monkeypatch.setattr(grid_join, "ROWS_PER_RANGE", 40)
    rows = spark.createDataFrame([(vec_id, x) for vec_id, x in clustered(8, 16)], "vec_id bigint, vector array<float>")
    axes = grid_join.directions(rows, 16)
    blocks = grid_join.packed(grid_join.ordered(rows, axes, 0.3, 3), axes, 8)
    found = [(row.at, len(row.vectors) // 64, row.copies) for row in blocks.orderBy("block").collect()]
    assert [at for at, _, _ in found] == np.cumsum([0, *(count for _, count, _ in found[:-1])]).tolist() and len(found) > 10
    assert sum(np.frombuffer(copies, np.int64).sum() for _, _, copies in found) == rows.count()
    plan = grid_join.links(blocks, axes, 0.95, 0.3, "f4")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "hashpartitioning" not in plan and "SortMergeJoin" not in plan
    pairs = [(a, b) for a in range(9) for b in range(a, 9)]
    held = grid_join.partners(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert sorted(tuple(sorted((row.block, other))) for row in held for other in row.others) == pairs


def test_copies_over_batches(spark, monkeypatch):
    """Equal vectors are one node also where Arrow batches part them, floats and doubles alike."""
    rows = clustered(9, 4) + [(1000 + n, [1.0, 2.0, 3.0, 4.0]) for n in range(70)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        assert result(spark, rows) == brute(rows)
        exact = [(vec_id, np.array(x, dtype=np.float32).astype(float).tolist()) for vec_id, x in rows]
        wide = spark.createDataFrame(exact, "vec_id bigint, embedding array<double>")
        assert Counter(map(tuple, grid_join.near_copies(wide).collect())) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
