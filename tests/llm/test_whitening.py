from __future__ import annotations

import math
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from tests.llm.helpers import GIVEN
from voltatlas.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as x", "2 as n", "3 as component", "'e' as EMBEDDING")


def plain(rows: list[tuple], count: int = 4) -> tuple[list[tuple], np.ndarray, np.ndarray, int, list[int]]:
    """Usable rows in whole steps, eigenvalues and components of their distinct vectors, by ordinary means."""
    usable = [(i, tuple(math.floor(256 * float(np.float32(c))) for c in v)) for i, v in rows
              if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({v for _, v in usable})
    x = np.array(fit, dtype=np.float64)
    values, vectors = np.linalg.eigh(np.cov(x.T, bias=True).reshape(x.shape[1], -1))
    return usable, values[::-1][:count], vectors.T[::-1][:count], len(fit), [sum(column) for column in zip(*fit)]


def holds(found, rows: list[tuple], count: int = 4) -> None:
    usable, values, vectors, n, total = plain(rows, count)
    x = np.array([v for _, v in usable], dtype=np.float64)
    expected = (x - np.array(total) / n) @ vectors.T / np.sqrt(values)
    by_component = defaultdict(list)
    for row in found:
        by_component[row.component].append(row)
    assert sorted(by_component) == list(range(1, len(values) + 1))
    trace = np.cov(np.array(sorted({v for _, v in usable}), dtype=np.float64).T, bias=True).trace()
    for component, part in by_component.items():
        own = sorted((row.vec_id is None, row.vec_id or 0, row.deviation, row.whitened) for row in part)
        assert len(part) == len(usable) and {row.n for row in part} == {n}
        sides = []
        for sign in (1, -1):
            other = sorted((i is None, i or 0, sum((n * a - b) ** 2 for a, b in zip(v, total)), sign * w)
                           for (i, v), w in zip(usable, expected[:, component - 1]))
            sides.append(all(one[:3] == two[:3] and abs(one[3] - two[3]) < 1e-6 for one, two in zip(own, other)))
        assert any(sides)
        assert all(row.explained == pytest.approx(values[component - 1] / trace, rel=1e-6) for row in part)
        assert all(row.identity_error < 1e-6 and row.deviation_exact == str(row.deviation) for row in part)


def test_given_embeddings(spark):
    embeddings = spark.read.parquet(f"{GIVEN}/sf0.001/embeddings.parquet")
    holds(whitening.whiten(embeddings).collect(), [(row.vec_id, row.embedding) for row in embeddings.collect()])


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(n, [float(c) for c in rng.standard_normal(6)]) for n in range(40)]
    rows += [(1, rows[5][1]), (1, rows[5][1]), (None, rows[7][1]), (50, [-0.0] * 6), (51, [0.0] * 6)]
    left_out = [(60, None), (61, []), (62, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (63, [float("nan")] * 6),
                (64, [float("inf")] + [0.0] * 5), (65, [1.0, 2.0])]
    holds(whitening.whiten(table(spark, rows + left_out)).collect(), rows)


def test_few_components(spark):
    """Fewer entries than components, a plane in a wider space, one distinct vector, no rows."""
    holds(whitening.whiten(table(spark, [(1, [0.5, 0.25]), (2, [1.0, 0.0]), (3, [0.0, 2.0])])).collect(),
          [(1, [0.5, 0.25]), (2, [1.0, 0.0]), (3, [0.0, 2.0])], 2)
    flat = [(n, [float(n), float(n * n % 7), float(n) + n * n % 7, 0.0, 1.0]) for n in range(20)]
    found = whitening.whiten(table(spark, flat)).collect()
    assert {row.component for row in found} == {1, 2} and max(row.identity_error for row in found) < 1e-9
    assert sum(row.explained for row in found if row.vec_id == 3) == pytest.approx(1)
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]):
        assert whitening.whiten(table(spark, rows)).collect() == []


def test_equal_eigenvalues(spark):
    """A root that comes three times has a null space of three directions; any orthonormal ones will do."""
    rows = [(2 * n + side, [float(sign * (n == k)) * (4 if k == 3 else 1) for k in range(4)])
            for n in range(4) for side, sign in ((0, 1), (1, -1))]
    found = whitening.whiten(table(spark, rows)).collect()
    assert {row.component for row in found} == {1, 2, 3, 4} and max(row.identity_error for row in found) < 1e-9


def test_nearly_equal_eigenvalues():
    """Doubles cannot tell these directions apart; long decimals do."""
    scatter = [[10 ** 30, 1, 0], [1, 10 ** 30, 0], [0, 0, 7]]
    polynomial = [0] * 4
    for factor in ((10 ** 30 + 1), (10 ** 30 - 1), 7):
        polynomial = [a - factor * b for a, b in zip([0] + polynomial[:-1], polynomial)] if any(polynomial) else [-factor, 1, 0, 0]
    roots = whitening.greatest_roots(polynomial, 3)
    assert [times for _, times in roots] == [1, 1, 1]
    assert [round(Fraction(root, 1 << whitening.ROOT_BITS)) for root, _ in roots] == [10 ** 30 + 1, 10 ** 30 - 1, 7]
    one, two, three = (whitening.null_space(scatter, root, 1)[0] for root, _ in roots)
    assert np.abs(one) == pytest.approx([0.5 ** 0.5, 0.5 ** 0.5, 0], abs=1e-15) and one[0] * one[1] > 0
    assert np.abs(two) == pytest.approx([0.5 ** 0.5, 0.5 ** 0.5, 0], abs=1e-15) and two[0] * two[1] < 0
    assert np.abs(three) == pytest.approx([0, 0, 1], abs=1e-15)


def by_fractions(a: list[list[int]]) -> list[int]:
    """Coefficients of det(x - a) by the recursion of traces, in fractions."""
    d = len(a)
    c, m = [Fraction(1)], [[Fraction(0)] * d for _ in range(d)]
    for k in range(1, d + 1):
        m = [[sum(a[i][t] * m[t][j] for t in range(d)) + (c[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        am = [[sum(a[i][t] * m[t][j] for t in range(d)) for j in range(d)] for i in range(d)]
        c.append(-sum(am[i][i] for i in range(d)) / k)
    return [int(value) for value in reversed(c)]


def test_polynomial(spark):
    rng = np.random.default_rng(8)
    for d, most in ((1, 5), (2, 100), (5, 3), (7, 10 ** 9), (6, 1)):
        x = rng.integers(-most, most + 1, (d + 1, d)).astype(object)
        x[:, -1] = x[:, 0]  # a column twice, so that a root is zero
        scatter = x.T @ x
        assert whitening.characteristic_polynomial(spark, scatter) == by_fractions(scatter.tolist())


def test_residues_of_any_matrix():
    rng = np.random.default_rng(1)
    for p in (3, 7, 101, 2 ** 31 - 1):
        for d in (1, 2, 3, 6):
            a = rng.integers(0, p, (d, d))
            a[rng.random((d, d)) < 0.4] = 0
            assert whitening.polynomial_modulo(a, p).tolist() == [value % p for value in by_fractions(a.tolist())]


def test_great_entries_are_summed_exactly(spark):
    rows = [(n, [float(2 ** 40 + n * 2 ** 20), float(-(2 ** 41) * n), 3.0]) for n in range(9)]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    x = [[math.floor(256 * c) for c in v] for _, v in rows]
    total = [sum(column) for column in zip(*x)]
    for row in found:
        exact = sum((9 * a - b) ** 2 for a, b in zip(x[row.vec_id], total))
        assert row.deviation_exact == str(exact) and row.deviation == (exact if exact < 2 ** 63 else None)
    assert {row.component for row in found} == {1} and found[0].identity_error < 1e-9


def test_primes():
    assert [n for n in range(60) if whitening.is_prime(n)] == [
        n for n in range(2, 60) if all(n % k for k in range(2, n))]
    assert whitening.primes_for(31)[0] == 2 ** 31 - 1 and len(whitening.primes_for(31)) == 2
