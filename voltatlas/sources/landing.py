"""From pages of JSON to typed raw tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltatlas.sources import versions
from voltatlas.sources.lake import PARTIAL, SAMPLE, Lake
from voltatlas.sources.paged import DATASETS, read_pages
from voltatlas.sources.schemas import RAW_TABLES, without_raw


@dataclass(frozen=True)
class Load:
    """How a raw table is fetched: page size, the key it is read by and where that is cut, and what to keep."""

    table: str
    limit: int
    key: str
    splits: str
    keep: str | None = None


_FIRST_LETTERS = ",".join("123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_FIRST_DIGITS = ",".join("23456789")

# Page sizes, keys and the rows to keep.
LOADS = {
    load.table: load
    for load in (
        Load("vehicles_raw", 1000, "kenteken", _FIRST_LETTERS),
        Load("vehicles_fuel_raw", 1000, "kenteken", _FIRST_LETTERS),
        Load("parking_address_raw", 10000, "parkingaddressreference", "", keep="parkingaddresstype = 'F'"),
        Load("charging_capacity_raw", 10000, "areaid", ""),
        Load("vehicles_by_postcode_raw", 1000, "postcode", _FIRST_DIGITS),
    )
}


def page_offsets(spark: SparkSession, pages: int, limit: int = 1000) -> DataFrame:
    return spark.range(pages).select((F.col("id") * limit).alias("page_offset"))


def offsets_covering(rows: DataFrame, limit: int = 1000, block: int = 10000) -> DataFrame:
    """Offsets of all the pages a table takes; expanded in blocks, so no array grows with the table."""
    last = F.col("last_page")
    return (
        rows.agg(F.count("*").alias("n"))
        .where("n > 0")
        .select(F.expr(f"(n - 1) div {limit}").alias("last_page"))
        .select(last, F.explode(F.sequence(F.lit(0), F.expr(f"last_page div {block}"))).alias("b"))
        .select(F.explode(F.sequence(
            F.col("b") * block, F.least(F.col("b") * block + (block - 1), last))).alias("page"))
        .select((F.col("page") * limit).alias("page_offset"))
    )


def elements(pages: DataFrame) -> DataFrame:
    """One variant row per array element of each page; an empty or failed page has none."""
    return pages.select(F.explode(_array()).alias("value"))


def _array() -> Column:
    """The page as an array; NULL for a body that is none."""
    return F.try_variant_get(F.try_parse_json("body"), "$", "array<variant>")


def field(value: Column, name: str, kind: str = "string") -> Column:
    """A field of a record, cast; a value that does not fit is an error."""
    return F.variant_get(value, f"$.{name}", kind)


def late_field(raw: Column, name: str, kind: str = "string") -> Column:
    """A field that appeared after the table was typed; NULL where it is missing or does not fit."""
    return F.try_variant_get(raw, f"$.{name}", kind)


def field_kind(value: Column) -> Column:
    """What a field of a raw record holds, in a few words that do not depend on the size of numbers or the depth of objects."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind == "VOID", "null").when(kind == "STRING", "text").when(kind == "BOOLEAN", "boolean")
        .when(kind == "BIGINT", "integer").when(kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), "decimal")
        .when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array").otherwise(F.lower(kind))
    )


def field_inventory(records: DataFrame, load: str, raw: str = "raw_json") -> DataFrame:
    """Which fields the records of each load have: field, kind, in how many records, and whether no earlier load had it.

    Loads are ordered by name. Counting is one shuffle of a row per load, field
    and kind and task; the first load of each field is looked up in that small result. A record that
    is no object has no fields.
    """
    fields = records.select(F.col(load).alias("load_id"), F.col(raw).alias("record")).lateralJoin(
        records.sparkSession.tvf.variant_explode(F.col("record").outer())).where(F.col("key").isNotNull())
    counts = fields.groupBy("load_id", F.col("key").alias("field"), field_kind(F.col("value")).alias("kind")).agg(
        F.count("*").alias("n_records"))
    first = Window.partitionBy("field")
    return counts.withColumn("is_new", F.col("load_id") == F.min("load_id").over(first))


def record_types(records: DataFrame, load: str, raw: str = "raw_json") -> DataFrame:
    """The whole type that the records of each load have in common, nested fields included, merged by Spark in one pass."""
    return records.groupBy(F.col(load).alias("load_id")).agg(
        F.count("*").alias("n_records"), F.schema_of_variant_agg(raw).alias("record_type"))


def telemetry_payload() -> Column:
    """The nested record kept beside the typed columns of a telemetry event."""
    return F.to_variant_object(F.struct(
        "vin",
        F.col("battery_pct").alias("battery"),
        F.col("speed_kmh").alias("speed"),
        F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("lon")).alias("location"),
    ))


def typed(records: DataFrame, table: str) -> DataFrame:
    """Columns of the raw table from its records, with the whole record as ``raw_json``."""
    value = F.col("value")
    columns = [field(value, f.name, f.dataType.simpleString()).alias(f.name) for f in without_raw(RAW_TABLES[table])]
    return records.select(*columns, value.alias("raw_json"))


def rows_of(pages: DataFrame, table: str) -> DataFrame:
    """Typed rows of a table's pages, after the load's own filter."""
    rows = typed(elements(pages), table)
    keep = LOADS[table].keep
    return rows.where(keep) if keep else rows


def failed_pages(pages: DataFrame) -> DataFrame:
    """Pages that could not be fetched, or whose body is no JSON array."""
    reason = F.coalesce("error", F.when(_array().isNull(), F.lit("the body is no JSON array")))
    return pages.withColumn("error", reason).where(F.col("error").isNotNull()).select(
        "dataset", "part", "page_offset", "error")


def load(lake: Lake, table: str, load_id: str = "all", **options: object) -> DataFrame:
    """Fetches a table to its end, replaces the rows of this load, and returns the pages that failed.

    With ``pages`` among the options it is a sample, and the load is marked so.
    Fetched pages are kept before they are parsed. A load that is run again
    after pages failed asks for the parts with failures only; one that was
    complete is fetched anew. The rows of a load stand under its id, so they are
    never added twice, and they are marked as partial while pages are missing.
    """
    how = LOADS[table]
    sample = "pages" in options
    request = {"limit": how.limit, **({"order": how.key} if sample else {"key": how.key, "splits": how.splits}),
               "on_error": "report", **options}
    landed = f"{lake.root}/pages/{table}/{load_id}"
    open_parts = [] if sample else _parts_with_failures(lake, landed)
    if open_parts:
        request["parts"] = ",".join(map(str, open_parts))
    fetched = read_pages(lake.spark, DATASETS[table], **request)
    if open_parts:
        kept = versions.read(lake.spark, landed).where(~F.col("part").isin(open_parts))
        fetched = kept.unionByName(fetched)
    versions.put(fetched, landed)
    pages = versions.read(lake.spark, landed)
    failed = failed_pages(pages)
    note = SAMPLE if sample else "" if failed.isEmpty() else PARTIAL
    lake.put_load(rows_of(pages, table), table, load_id, note)
    return failed


def _parts_with_failures(lake: Lake, landed: str) -> list[int]:
    if versions.current(lake.spark, landed) is None:
        return []
    failed = failed_pages(versions.read(lake.spark, landed)).select("part").distinct()
    return sorted(row["part"] for row in failed.collect())  # one row per part
