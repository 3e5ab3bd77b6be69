"""Every registered query against its SQL on the given tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from checks.oracle import oracle_sql
from checks.registry import all_queries as queries
from checks.compare import connect, difference
from tests.conftest import GIVEN

FOLDER = f"{GIVEN}/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    assert difference(spark, duck, FOLDER, name, oracle_sql()[name]) == ""


def test_entry_has_rows(spark):
    found = entry(spark).collect()
    assert len(found) == 83
    assert sum(row.charging_points > 0 for row in found) == 8


def test_thresholds_take_effect(spark):
    """The checks' thresholds must drop areas, or the comparison says little about them."""
    areas = queries()["ev_by_region"](spark, FOLDER).count()
    assert 0 < queries()["ev_infrastructure"](spark, FOLDER).count() < areas
    assert 0 < queries()["dashboard_leading_areas"](spark, FOLDER).count()
