"""Fuel names and codes to categories."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fuel names of the vehicle register (lower case) and the labels of the models.
ELECTRIC_NAMES = ("elektriciteit", "elektrisch")
HYBRID_PART = "hybride"
HYDROGEN_NAME = "waterstof"
PETROL_NAME = "benzine"
DIESEL_NAME = "diesel"
LPG_NAME = "lpg"
GAS_NAMES = ("cng", "lng")
FUEL_LABELS = ("Elektrisch", "Hybride", "Benzine", "Diesel", "Overig")


def fuel_category(description: Column) -> Column:
    """Eight-way category of a fuel description; unknown and NULL are 'Other'."""
    name = F.lower(description)
    return (
        F.when(name.isin(*ELECTRIC_NAMES), "Electric")
        .when(name.contains(HYBRID_PART), "Hybrid")
        .when(name == HYDROGEN_NAME, "Hydrogen")
        .when(name == PETROL_NAME, "Petrol")
        .when(name == DIESEL_NAME, "Diesel")
        .when(name == LPG_NAME, "LPG")
        .when(name.isin(*GAS_NAMES), "Gas")
        .otherwise("Other")
    )


def is_ev_or_hybrid(description: Column) -> Column:
    """True for electric, hydrogen and any hybrid; never NULL."""
    name = F.lower(description)
    low_carbon = name.isin(*ELECTRIC_NAMES, HYDROGEN_NAME) | name.contains(HYBRID_PART)
    return F.coalesce(low_carbon, F.lit(False))


def fuel_label(description: Column) -> Column:
    """Five-way label (see FUEL_LABELS) of a fuel description."""
    name = F.lower(description)
    return (
        F.when(name.isin(*ELECTRIC_NAMES), "Elektrisch")
        .when(name.contains(HYBRID_PART), "Hybride")
        .when(name == PETROL_NAME, "Benzine")
        .when(name == DIESEL_NAME, "Diesel")
        .otherwise("Overig")
    )


def registry_fuel_label(code: Column, plug_in: Column) -> Column:
    """Label of a one-letter fuel code. The code wins over the plug-in flag."""
    return (
        F.when(code == "E", "Elektrisch")
        .when(code == "B", "Benzine")
        .when(code == "D", "Diesel")
        .when(plug_in == "J", "Hybride")
        .otherwise("Overig")
    )
