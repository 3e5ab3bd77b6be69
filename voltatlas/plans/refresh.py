"""The full refresh: every model rebuilt and written, upstream models first."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltatlas.functions import timestamp
from voltatlas.operators import adoption, climate, curated, fleet
from voltatlas.sources.lake import Lake
from voltatlas.sources.schemas import RAW_TABLES

HOUR, MINUTE = 3600, 60


@dataclass(frozen=True)
class Model:
    """A table, the tables it reads (in the order of the function's arguments) and its target lag."""

    layer: str
    name: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    target_lag_seconds: int = HOUR
    options: tuple[str, ...] = field(default=())


# Upstream first. ``options`` names the run's parameters a model takes.
MODELS = (
    Model("curated", "ev_by_region", ("vehicles_by_postcode_raw",), curated.ev_by_region),
    Model("curated", "charging_by_area", ("charging_capacity_raw",), curated.charging_by_area),
    Model("curated", "vehicles_with_fuel", ("vehicles_fuel_raw",), curated.vehicles_with_fuel),
    Model("analytics", "national_ev_summary", ("ev_by_region",), adoption.national_ev_summary,
          options=("min_total_summary",)),
    Model("analytics", "ev_growth_trends", ("vehicles_with_fuel",), adoption.ev_growth_trends),
    Model("analytics", "ev_yoy_growth", ("ev_growth_trends",), adoption.yoy_from_sums),
    Model("analytics", "brandstof_per_postcode_datum", ("vehicles_raw", "vehicles_fuel_raw"), adoption.fuel_per_month),
    Model("analytics", "laadpalen_per_postcode", ("parking_address_raw", "charging_capacity_raw"),
          adoption.chargers_per_postcode),
    Model("analytics", "brandstof_per_postcode", ("vehicles_by_postcode_raw",), adoption.fuel_per_postcode),
    Model("analytics", "ev_infrastructure_correlation", ("ev_by_region", "laadpalen_per_postcode"),
          adoption.ev_infrastructure, options=("min_total_infrastructure",)),
    Model("curated", "nl_weather_yearly", ("weather_hourly",), climate.weather_yearly),
    Model("curated", "nl_monthly_weather", ("weather_hourly",), climate.weather_monthly),
    Model("curated", "nl_transport_emissions", ("emissions",), climate.transport_emissions),
    Model("curated", "nl_total_emissions", ("emissions",), climate.total_emissions),
    Model("analytics", "regional_weather_ev_correlation", ("weather_hourly", "ev_by_region"),
          climate.regional_weather_ev),
    Model("analytics", "ev_weather_emissions", ("ev_yoy_growth", "nl_weather_yearly", "nl_transport_emissions"),
          climate.ev_weather_emissions),
    Model("curated", "vehicle_status", ("telemetry_raw",), fleet.vehicle_status, MINUTE,
          options=("as_of", "tie_break")),
    Model("analytics", "fleet_alerts", ("vehicle_status",), fleet.fleet_alerts, MINUTE),
)

_ARGUMENT = {"min_total_summary": "min_total", "min_total_infrastructure": "min_total"}


class IncompleteLoad(ValueError):
    """A raw table does not hold all rows of its source."""


def refresh_all(
    lake: Lake, external: dict[str, DataFrame] | None = None, skip_missing: bool = False,
    allow_incomplete: bool = False, **options: object,
) -> list[str]:
    """Rebuilds every model; returns the names in the order written.

    A model reads the written tables of the models before it, so shared work
    is done once and a lost executor costs at most the model in progress.
    ``external`` holds tables that live elsewhere (weather, emissions). A model
    without its inputs is an error unless ``skip_missing``, and so is a raw
    table that a load has left incomplete unless ``allow_incomplete``; both are
    raised before anything is written.
    """
    external = external or {}
    needed = sorted({name for model in MODELS for name in model.inputs} - {model.name for model in MODELS})
    incomplete = {name: lake.incomplete(name) for name in needed if name in RAW_TABLES and lake.incomplete(name)}
    if incomplete and not allow_incomplete:
        raise IncompleteLoad(f"not all rows are there: {incomplete}")
    absent = [name for name in needed if name not in external and not lake.exists("raw", name)]
    absent += [name for model in MODELS for name in model.options if name == "as_of" and name not in options]
    if absent and not skip_missing:
        raise LookupError(f"inputs are missing: {', '.join(absent)}")
    layer_of = {model.name: model.layer for model in MODELS}
    refreshed: list[str] = []

    def table(name: str) -> DataFrame | None:
        if name in external:
            return external[name]
        if name in layer_of:
            return lake.read(layer_of[name], name) if name in refreshed else None
        return lake.read("raw", name) if lake.exists("raw", name) else None

    for model in MODELS:
        inputs = [table(name) for name in model.inputs]
        if any(df is None for df in inputs) or ("as_of" in model.options and "as_of" not in options):
            continue
        chosen = {_ARGUMENT.get(key, key): options[key] for key in model.options if key in options}
        lake.replace(model.build(*inputs, **chosen), model.layer, model.name)
        log_refresh(lake, model)
        refreshed.append(model.name)
    return refreshed


def publish_status(lake: Lake, status: DataFrame) -> None:
    """Replaces the vehicle status and the alerts that follow from it, and logs both refreshes."""
    models = {model.name: model for model in MODELS}
    lake.replace(status, "curated", "vehicle_status")
    log_refresh(lake, models["vehicle_status"])
    lake.replace(fleet.fleet_alerts(lake.read("curated", "vehicle_status")), "analytics", "fleet_alerts")
    log_refresh(lake, models["fleet_alerts"])


def log_refresh(lake: Lake, model: Model) -> None:
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    row = lake.spark.range(1).select(F.lit(model.name).alias("model"), timestamp(now).alias("refreshed_at"))
    row.write.mode("append").parquet(lake.path("analytics", "refresh_log"))


def refresh_targets(lake: Lake) -> DataFrame:
    """Target lag per model, one of the inputs of the freshness report."""
    return lake.spark.createDataFrame(
        [(model.name, model.target_lag_seconds) for model in MODELS], "model string, target_lag_seconds bigint"
    )
