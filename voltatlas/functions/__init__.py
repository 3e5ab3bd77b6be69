"""Column expressions shared by the models; all of them stay inside the JVM."""

from .fuel import fuel_category, fuel_label, is_ev_or_hybrid, registry_fuel_label
from .numeric import percentage, ratio, round_half_up, whole_number
from .places import area_of, climate_region_of_area, climate_region_of_station, with_region_name
from .plates import bucketed_year
from .time import MONTH_OF, before, month_label, rows_since, since_year, timestamp

__all__ = [
    "MONTH_OF",
    "area_of", "before", "bucketed_year", "climate_region_of_area", "climate_region_of_station",
    "fuel_category", "fuel_label", "is_ev_or_hybrid", "month_label", "percentage", "ratio",
    "registry_fuel_label", "round_half_up", "rows_since", "since_year", "timestamp", "whole_number", "with_region_name",
]
