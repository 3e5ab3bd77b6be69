"""What a reader may see: rows by principal, masked columns, published extracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltatlas.functions import climate_region_of_area
from voltatlas.sources import versions

MASK = "****"

# Models a dealer may read, and the dealer group of each climate region.
DEALER_MODELS = ("ev_growth_trends", "ev_yoy_growth", "ev_infrastructure_correlation")
DEALER_GROUPS = {"Noord": "north", "Zuid": "south"}


def visible_rows(df: DataFrame, region: Column, permissions: DataFrame, principal: str) -> DataFrame:
    """Rows whose region is on the principal's list.

    The list stays a plain filtered scan. Spark broadcasts it when its measured
    size is below the threshold; otherwise the join shuffles, and a region with
    too many rows is split across tasks, which a semi join allows on this side.
    """
    allowed = permissions.where(F.col("principal") == principal).select(F.col("allowed_region").alias("_allowed"))
    return df.join(allowed, region == F.col("_allowed"), "left_semi")


REGION = "region"


def write_by_region(df: DataFrame, region: Column, folder: str) -> None:
    """Keeps a table in folders by region, so that ``visible_rows`` reads the folders of a principal's regions only."""
    df.withColumn(REGION, region).hint("rebalance", REGION).write.mode("overwrite").partitionBy(REGION).parquet(folder)


def visible_in_folders(df: DataFrame, permissions: DataFrame, principal: str) -> DataFrame:
    """What a principal may see of a table kept by region; the list prunes the folders while the query runs.

    Folder names are text, whatever they look like: read the table with its schema, or regions such as
    ``10`` come back as numbers and match nothing.
    """
    return visible_rows(df, F.col(REGION), permissions, principal).drop(REGION)


def masked(df: DataFrame, column: str, is_admin: bool) -> DataFrame:
    """The column in clear for an administrator, a fixed mask for anybody else."""
    return df if is_admin else df.withColumn(column, F.lit(MASK))


def dealer_extract(ev_infrastructure: DataFrame) -> DataFrame:
    """Infrastructure rows of the areas that belong to a dealer group, with the group's name."""
    region = climate_region_of_area(F.col("postal_area"))
    group = F.coalesce(*[F.when(region == name, group) for name, group in DEALER_GROUPS.items()])
    return ev_infrastructure.withColumn("dealer_group", group).where(F.col("dealer_group").isNotNull())


def manufacturer_extract(ev_growth_trends: DataFrame) -> DataFrame:
    """Totals by category only; manufacturers see nothing finer."""
    return ev_growth_trends.groupBy("fuel_category").agg(
        F.sum("vehicle_count").alias("vehicle_count"),
        F.sum("ev_hybrid_count").alias("ev_hybrid_count"),
    )


def publish(models: dict[str, DataFrame], folder: str, allowed: tuple[str, ...] = DEALER_MODELS) -> list[str]:
    """Replaces the published copy of every allowed model at once and returns their names.

    An allowed model that is not among the models is an error, raised before anything is written.
    """
    missing = [name for name in allowed if name not in models]
    if missing:
        raise LookupError(f"models to publish are missing: {', '.join(missing)}")
    for name in allowed:
        versions.put(models[name], f"{folder}/{name}")
    return list(allowed)


def publish_by_group(extract: DataFrame, folder: str, groups: tuple[str, ...] = tuple(DEALER_GROUPS.values())) -> None:
    """One table per dealer group, so a group can be given its own path; a group without rows gets an empty one."""
    for group in groups:
        versions.put(extract.where(F.col("dealer_group") == group), f"{folder}/{group}")


def publish_totals(ev_growth_trends: DataFrame, folder: str) -> None:
    """The manufacturers' share: totals by category."""
    versions.put(manufacturer_extract(ev_growth_trends), f"{folder}/manufacturer_totals")
