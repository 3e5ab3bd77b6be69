"""Column expressions on hand-made values."""

from __future__ import annotations

from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from voltatlas import functions as V
from voltatlas.functions.places import AREA_NAMES


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_round_half_up(spark):
    assert one(spark, V.round_half_up(F.lit(0.285), 2)) == 0.29
    assert one(spark, V.round_half_up(F.lit(-2.5), 0)) == -3.0
    assert one(spark, V.round_half_up(F.lit(1.4999999999), 0)) == 2.0  # noise of a floating sum
    assert one(spark, V.round_half_up(F.lit(None).cast("double"), 2)) is None


def test_percentage_of_nothing_is_null(spark):
    assert one(spark, V.percentage(F.lit(0), F.lit(0), 2)) is None
    assert one(spark, V.percentage(F.lit(1), F.lit(3), 2)) == 33.33
    assert one(spark, V.ratio(F.lit(1), F.lit(0))) is None


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**9), st.integers(1, 10**9)), min_size=50, max_size=50))
def test_percentage_matches_decimal_arithmetic(spark, pairs):
    df = spark.createDataFrame(pairs, "a bigint, b bigint").withColumn("p", V.percentage(F.col("a"), F.col("b"), 2))
    for a, b, found in (tuple(r) for r in df.collect()):
        exact = (Decimal(100 * a) / Decimal(b)).quantize(Decimal("1e-7"), ROUND_HALF_UP)
        assert found == float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP))


def test_fuel_names(spark):
    names = ["Elektriciteit", "ELEKTRISCH", "Benzine-Hybride", "Waterstof", "benzine", "Diesel", "LPG", "CNG", "lng",
             "Alcohol", "", None]
    df = spark.createDataFrame([(n,) for n in names], "n string").select(
        "n", V.fuel_category(F.col("n")).alias("c"), V.is_ev_or_hybrid(F.col("n")).alias("e"),
        V.fuel_label(F.col("n")).alias("l"))
    found = {r.n: (r.c, r.e, r.l) for r in df.collect()}
    assert found == {
        "Elektriciteit": ("Electric", True, "Elektrisch"), "ELEKTRISCH": ("Electric", True, "Elektrisch"),
        "Benzine-Hybride": ("Hybrid", True, "Hybride"), "Waterstof": ("Hydrogen", True, "Overig"),
        "benzine": ("Petrol", False, "Benzine"), "Diesel": ("Diesel", False, "Diesel"),
        "LPG": ("LPG", False, "Overig"), "CNG": ("Gas", False, "Overig"), "lng": ("Gas", False, "Overig"),
        "Alcohol": ("Other", False, "Overig"), "": ("Other", False, "Overig"), None: ("Other", False, "Overig"),
    }


def test_fuel_code_wins_over_plug_in(spark):
    df = spark.createDataFrame([("E", "J"), ("B", "J"), ("D", "N"), ("W", "J"), (None, "J"), (None, None)], "b string, p string")
    assert [r.x for r in df.select(V.registry_fuel_label(F.col("b"), F.col("p")).alias("x")).collect()] == [
        "Elektrisch", "Benzine", "Diesel", "Hybride", "Hybride", "Overig"]


def test_bucketed_year_ranges(spark):
    def years(pattern):
        df = spark.range(3000).select(V.bucketed_year(F.expr(pattern)).alias("y"))
        return {r.y for r in df.distinct().collect()}

    digits = "lpad(cast(id % 100 as string), 2, '0')"
    letter = "substr('BDFGHJKLNP', cast(1 + id % 10 as int), 1)"
    other = "substr('BDFGHJKLNP', cast(1 + (id div 10) % 10 as int), 1)"
    assert years(f"concat({digits}, {letter}, {other}, 'Z', cast(id % 7 as string))") == set(range(2020, 2026))
    assert years(f"concat(cast(id % 7 as string), {letter}, {other}, 'Z', {digits})") == set(range(2015, 2020))
    assert years(f"concat({letter}, {other}, '1', {digits}, 'Z')") == set(range(2010, 2015))
    assert years("cast(id as string)") == set(range(2015, 2026))
    assert years(f"concat('x', {digits}, {letter}, {other}, 'Z1')") == set(range(2015, 2026))  # whole plate must match


def test_bucketed_year_is_stable(spark):
    # 5d41402a is the start of the MD5 of "hello".
    assert one(spark, V.bucketed_year(F.lit("hello"))) == 2015 + 0x5D41402A % 11


def test_region_names(spark):
    df = spark.createDataFrame([("10",), ("19",), ("59",), ("XX",), (None,)], "postal_area string")
    assert rows(V.with_region_name(df), "region_name") == [
        ("Amsterdam Centrum",), ("Area 19",), ("Area 59",), ("Area None",), ("Area XX",)]
    assert len(AREA_NAMES) == 88


def test_climate_regions(spark):
    df = spark.createDataFrame(
        [("10",), ("39",), ("40",), ("49",), ("50",), ("66",), ("67",), ("87",), ("88",), ("99",), ("AB",), ("",), (None,)],
        "a string")
    assert [r.x for r in df.select(V.climate_region_of_area(F.col("a")).alias("x")).collect()] == [
        "Randstad", "Randstad", "Overig", "Overig", "Zuid", "Zuid", "Overig", "Overig", "Noord", "Noord",
        "Overig", "Overig", "Overig"]
    assert one(spark, V.climate_region_of_station(F.lit("AMSTERDAM EELDE"))) == "Randstad"
    assert one(spark, V.climate_region_of_station(F.lit("De Bilt"))) == "Overig"


def test_month_labels(spark):
    assert one(spark, V.month_label(F.lit(1))) == "01-Jan"
    assert one(spark, V.month_label(F.lit(12))) == "12-Dec"
    assert one(spark, V.month_label(F.lit(13))) is None


def test_timestamp_literal_has_no_zone(spark):
    assert one(spark, V.timestamp(datetime(2024, 3, 31, 2, 30))) == datetime(2024, 3, 31, 2, 30)
