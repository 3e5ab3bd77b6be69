"""Postal areas, region names and climate regions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of the two-digit postal areas. 19 and 59 have none.
AREA_NAMES = {
    "10": "Amsterdam Centrum", "11": "Amsterdam Zuid", "12": "Amsterdam Oost", "13": "Amsterdam Noord",
    "14": "Zaandam", "15": "Purmerend", "16": "Alkmaar", "17": "Hoorn", "18": "Den Helder",
    "20": "Haarlem", "21": "Hoofddorp", "22": "Hillegom", "23": "Leiden", "24": "Alphen a/d Rijn",
    "25": "Den Haag", "26": "Delft", "27": "Zoetermeer", "28": "Gouda", "29": "Dordrecht",
    "30": "Rotterdam West", "31": "Rotterdam Centrum", "32": "Rotterdam Zuid", "33": "Spijkenisse",
    "34": "Hellevoetsluis", "35": "Utrecht", "36": "Zeist", "37": "Amersfoort", "38": "Hilversum",
    "39": "Almere", "40": "Lelystad", "41": "Harderwijk", "42": "Apeldoorn", "43": "Deventer",
    "44": "Zwolle", "45": "Emmeloord", "46": "Kampen", "47": "Hengelo", "48": "Enschede",
    "49": "Almelo", "50": "Eindhoven", "51": "Helmond", "52": "Tilburg", "53": "Breda",
    "54": "Bergen op Zoom", "55": "Roosendaal", "56": "Goes", "57": "Middelburg", "58": "Vlissingen",
    "60": "Arnhem", "61": "Nijmegen", "62": "Venlo", "63": "Roermond", "64": "Maastricht",
    "65": "Sittard", "66": "Heerlen", "67": "Weert", "68": "Doetinchem", "69": "Tiel",
    "70": "Oss", "71": "s-Hertogenbosch", "72": "Veghel", "73": "Cuijk", "74": "Venray",
    "75": "Ede", "76": "Barneveld", "77": "Nijkerk", "78": "Ermelo", "79": "Nunspeet",
    "80": "Zwolle Oost", "81": "Raalte", "82": "Ommen", "83": "Hoogeveen", "84": "Emmen",
    "85": "Assen", "86": "Meppel", "87": "Steenwijk", "88": "Leeuwarden", "89": "Sneek",
    "90": "Drachten", "91": "Heerenveen", "92": "Dokkum", "93": "Groningen", "94": "Veendam",
    "95": "Winschoten", "96": "Stadskanaal", "97": "Hoogezand", "98": "Delfzijl", "99": "Appingedam",
}

# Parts of station names and ranges of postal areas per climate region.
STATION_PARTS = {
    "Randstad": ("SCHIPHOL", "AMSTERDAM", "ROTTERDAM", "DEN HAAG", "UTRECHT", "HAARLEM", "VALKENBURG", "VOORSCHOTEN"),
    "Noord": ("GRONINGEN", "LEEUWARDEN", "EELDE", "HOOGEVEEN"),
    "Zuid": ("MAASTRICHT", "EINDHOVEN", "VOLKEL", "ARCEN"),
}
AREA_RANGES = {"Randstad": (10, 39), "Noord": (88, 99), "Zuid": (50, 66)}
OTHER_REGION = "Overig"


def area_of(postcode: Column) -> Column:
    """Two-character postal area of a postcode."""
    return F.left(postcode, F.lit(2))


def _first_match(conditions: dict[str, Column]) -> Column:
    (first, condition), *rest = conditions.items()
    case = reduce(lambda c, rule: c.when(rule[1], rule[0]), rest, F.when(condition, first))
    return case.otherwise(OTHER_REGION)


def climate_region_of_station(station: Column) -> Column:
    """Climate region by station name; the first region with a matching part wins."""
    return _first_match({
        region: reduce(Column.__or__, [station.contains(part) for part in parts])
        for region, parts in STATION_PARTS.items()
    })


def climate_region_of_area(area: Column) -> Column:
    """Climate region of a two-digit area; anything that is no number is 'Overig'."""
    number = area.try_cast("int")
    return _first_match({region: number.between(*bounds) for region, bounds in AREA_RANGES.items()})


def with_region_name(df: DataFrame, area: str = "postal_area", name: str = "region_name") -> DataFrame:
    """Adds the area's name, or 'Area <code>' where there is none.

    The name list is the 88 fixed rows above, so broadcasting it is always safe.
    """
    names = df.sparkSession.createDataFrame(list(AREA_NAMES.items()), f"{area} string, {name} string")
    fallback = F.concat(F.lit("Area "), F.coalesce(df[area], F.lit("None")))
    return (
        df.join(F.broadcast(names), area, "left")
        .withColumn(name, F.coalesce(F.col(name), fallback))
    )
