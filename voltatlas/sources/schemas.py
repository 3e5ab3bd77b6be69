"""Schemas of the raw and the external tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _table(*columns: tuple[str, T.DataType, str]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True, {"comment": note}) for name, kind, note in columns])


_TEXT, _RAW = T.StringType(), ("raw_json", T.VariantType(), "whole record as delivered")

RAW_TABLES: dict[str, T.StructType] = {
    "vehicles_raw": _table(
        ("kenteken", _TEXT, "licence plate, key"),
        ("datum_eerste_tenaamstelling_in_nederland", _TEXT, "date of first registration, yyyymmdd"),
        ("merk", _TEXT, "make"),
        ("handelsbenaming", _TEXT, "model name"),
        ("voertuigsoort", _TEXT, "kind of vehicle"),
        _RAW,
    ),
    "vehicles_fuel_raw": _table(
        ("kenteken", _TEXT, "licence plate, refers to vehicles_raw"),
        ("brandstof_omschrijving", _TEXT, "fuel in words"),
        _RAW,
    ),
    "parking_address_raw": _table(
        ("areaid", _TEXT, "parking area"),
        ("areamanagerid", _TEXT, "manager of the area"),
        ("parkingaddresstype", _TEXT, "kind of address, F for a facility"),
        ("zipcode", _TEXT, "postcode, may be empty"),
        _RAW,
    ),
    "charging_capacity_raw": _table(
        ("areaid", _TEXT, "parking area"),
        ("areamanagerid", _TEXT, "manager of the area"),
        ("chargingpointcapacity", _TEXT, "number of charging points as text"),
        _RAW,
    ),
    "vehicles_by_postcode_raw": _table(
        ("postcode", _TEXT, "four-digit postcode"),
        ("voertuigsoort", _TEXT, "kind of vehicle"),
        ("brandstof", _TEXT, "fuel code: B petrol, D diesel, E electric"),
        ("extern_oplaadbaar", _TEXT, "plug-in, J or N"),
        ("aantal", T.IntegerType(), "number of vehicles"),
        _RAW,
    ),
    "telemetry_raw": _table(
        ("vin", _TEXT, "vehicle, brand first"),
        ("event_timestamp", T.TimestampNTZType(), "time of the event"),
        ("battery_pct", T.IntegerType(), "charge of the battery, 0 to 100"),
        ("latitude", T.DoubleType(), "position, degrees north"),
        ("longitude", T.DoubleType(), "position, degrees east"),
        ("speed_kmh", T.IntegerType(), "speed"),
        ("charging", T.BooleanType(), "connected to a charger"),
        _RAW,
    ),
}

# External tables are somebody else's; only the columns the jobs read are listed.
WEATHER_HOURLY = _table(
    ("time", T.TimestampNTZType(), "hour of the observation"),
    ("stationname", _TEXT, "station"),
    ("lat", T.DoubleType(), "position, degrees north"),
    ("lon", T.DoubleType(), "position, degrees east"),
    ("temp", T.DoubleType(), "degrees Celsius"),
    ("wind_speed", T.DoubleType(), "metres per second"),
    ("precip_hour", T.DoubleType(), "millimetres"),
    ("rel_humidity", T.DoubleType(), "percent"),
)
EMISSIONS = _table(
    ("date", T.DateType(), "first day of the year"),
    ("geo_id", _TEXT, "place"),
    ("variable", _TEXT, "key of the series"),
    ("variable_name", _TEXT, "series in words"),
    ("value", T.DoubleType(), "tonnes"),
    ("unit", _TEXT, "unit of the value"),
)

LAYERS = ("raw", "curated", "analytics")

# Folder column and the time it comes from. Parquet statistics do not prune on
# timestamps without a zone, so a table read by its last hours is kept by day.
DAY_OF = {"telemetry_raw": ("event_date", "event_timestamp")}


def without_raw(schema: T.StructType) -> T.StructType:
    """The typed columns only; a stream that reads these never touches the raw record."""
    return T.StructType([field for field in schema if field.name != "raw_json"])
