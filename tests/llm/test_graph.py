from __future__ import annotations

import random

import pytest

from voltatlas.llm.graph import components


def brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {node: find(node) for node in parent}


RNG = random.Random(2)
CHAIN = [(n, n + 1) for n in range(300)]


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(2, 1)], CHAIN, [(b, a) for a, b in CHAIN], [(0, n) for n in range(1, 500)],
    [(RNG.randrange(400), RNG.randrange(400)) for _ in range(220)], [(-5, 3), (3, -9), (7, 8), (7, 8)],
    [(n, (n * 37) % 211) for n in range(211)],
])
def test_components(spark, edges):
    found = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {row.node: row.component for row in found} == brute(edges) and len(found) == len(brute(edges))
