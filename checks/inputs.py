"""The domain's raw tables, derived from the given star schema and event table.

Each text runs unchanged in Spark and in DuckDB, so both sides of a check read
the same rows. No row is left out: every given row becomes a domain row.
"""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = datetime(2024, 1, 30, 12)

# Plates in the three classes the models tell apart and one they don't; every
# two-hundredth order repeats the plate of an earlier one. Digits come from the
# order number, letters are digits written in another alphabet.
_PLATE = """
  CASE r WHEN 0 THEN concat(substr(digits, 1, 2), substr(letters, 3, 3), substr(digits, 6, 1))
         WHEN 1 THEN concat(substr(digits, 1, 1), substr(letters, 2, 3), substr(digits, 5, 2))
         WHEN 2 THEN concat(substr(letters, 1, 2), substr(digits, 3, 3), substr(letters, 6, 1))
         ELSE concat('Q', cast(n as string)) END"""
_NUMBERED_ORDERS = """
  (SELECT *, translate(digits, '0123456789', 'BDFGHJKLNP') AS letters
   FROM (SELECT *, n % 4 AS r, lpad(cast(cast(floor(n / 4) as bigint) % 1000000 as string), 6, '0') AS digits
         FROM (SELECT *, CASE WHEN o_orderkey % 200 = 0 AND o_orderkey > 0 THEN o_orderkey - 4 ELSE o_orderkey END AS n
               FROM {orders}) o1) o2) o3"""

VIEWS = {
    "vehicles_by_postcode": """
SELECT cast(1000 + (l_partkey * 37 + l_suppkey * 101) % 9000 as string) AS postcode,
       CASE WHEN l_linestatus = 'O' THEN 'Personenauto' ELSE 'Bedrijfsauto' END AS voertuigsoort,
       CASE WHEN l_linenumber = 7 THEN 'W' WHEN l_returnflag = 'R' THEN 'E' WHEN l_returnflag = 'A' THEN 'B' ELSE 'D' END AS brandstof,
       CASE WHEN l_linenumber % 3 = 0 THEN 'J' ELSE 'N' END AS extern_oplaadbaar,
       cast(l_quantity as int) AS aantal
FROM {lineitem}""",
    "charging_capacity": """
SELECT cast(p_partkey as string) AS areaid,
       cast(p_partkey % 100 as string) AS areamanagerid,
       CASE p_size % 7 WHEN 0 THEN 'n/a' WHEN 1 THEN concat(cast(p_size as string), '.7') WHEN 2 THEN '0.4'
            WHEN 3 THEN concat(' ', cast(p_size as string), ' ') WHEN 4 THEN concat(cast(p_size as string), 'x')
            ELSE cast(p_size - 1 as string) END AS chargingpointcapacity
FROM {part}""",
    "parking_address": """
SELECT cast(s_suppkey as string) AS areaid,
       cast(s_nationkey as string) AS areamanagerid,
       cast(s_suppkey as string) AS parkingaddressreference,
       CASE WHEN s_nationkey % 5 = 0 THEN 'B' ELSE 'F' END AS parkingaddresstype,
       CASE WHEN s_suppkey % 11 = 0 THEN '' ELSE concat(cast(1000 + (s_suppkey * 911) % 9000 as string), 'AB') END AS zipcode
FROM {supplier}""",
    "vehicles": f"""
SELECT {_PLATE} AS kenteken,
       CASE WHEN o_orderkey % 50 = 0 THEN '20150230'
            ELSE concat(cast(year(o_orderdate) + 20 as string), lpad(cast(month(o_orderdate) as string), 2, '0'),
                        lpad(cast(day(o_orderdate) as string), 2, '0')) END AS datum_eerste_tenaamstelling_in_nederland,
       CASE o_custkey % 4 WHEN 0 THEN 'VOLKSWAGEN' WHEN 1 THEN 'TESLA' WHEN 2 THEN 'BMW' ELSE 'SKODA' END AS merk,
       CASE o_custkey % 3 WHEN 0 THEN 'MODEL A' WHEN 1 THEN 'MODEL B' ELSE 'MODEL C' END AS handelsbenaming,
       CASE WHEN o_orderstatus = 'P' THEN 'Bedrijfsauto' ELSE 'Personenauto' END AS voertuigsoort
FROM {_NUMBERED_ORDERS}""",
    "vehicles_fuel": f"""
SELECT CASE WHEN o_orderpriority = '5-LOW' THEN concat('X', cast(n as string)) ELSE {_PLATE} END AS kenteken,
       CASE o_orderkey % 9 WHEN 0 THEN 'Elektriciteit' WHEN 1 THEN 'Benzine' WHEN 2 THEN 'Diesel' WHEN 3 THEN 'Benzine-hybride'
            WHEN 4 THEN 'Waterstof' WHEN 5 THEN 'LPG' WHEN 6 THEN 'CNG' WHEN 7 THEN 'Alcohol' ELSE 'elektrisch' END AS brandstof_omschrijving
FROM {_NUMBERED_ORDERS}""",
    "weather_hourly": """
SELECT l_shipdate + interval '7305' day AS time,
       CASE l_suppkey % 8 WHEN 0 THEN 'SCHIPHOL AWS' WHEN 1 THEN 'DE BILT' WHEN 2 THEN 'EELDE' WHEN 3 THEN 'MAASTRICHT'
            WHEN 4 THEN 'ROTTERDAM' WHEN 5 THEN 'VOLKEL' WHEN 6 THEN 'HOOGEVEEN' ELSE 'VLISSINGEN' END AS stationname,
       cast(51 + l_suppkey % 8 as double) / 8 + 45 AS lat,
       cast(l_suppkey % 8 as double) / 4 + 4 AS lon,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE l_quantity - 10 END AS temp,
       CASE WHEN l_tax = 0 THEN NULL ELSE l_discount * 10 END AS precip_hour,
       l_tax * 100 AS wind_speed,
       l_quantity + 40 AS rel_humidity
FROM {lineitem}""",
    "emissions": """
SELECT make_date(cast(y + 20 as int), 1, 1) AS date,
       geo_id,
       variable,
       CASE WHEN variable LIKE 'transport%' THEN 'Transportation CO2' ELSE 'Total CO2 without land use' END AS variable_name,
       cast(sum(tonnes) as double) AS value,
       'tCO2e' AS unit
FROM (SELECT year(o_orderdate) AS y,
             CASE WHEN o_orderpriority = '1-URGENT' THEN 'country/BEL' ELSE 'country/NLD' END AS geo_id,
             CASE WHEN o_orderstatus = 'F' THEN 'transportation_co2_climate_watch'
                  ELSE 'total_excluding_lulucf_co2_climate_watch' END AS variable,
             floor(o_totalprice) AS tonnes
      FROM {orders}) o1
GROUP BY y, geo_id, variable""",
    "telemetry": """
SELECT event_id,
       concat(CASE user_id % 3 WHEN 0 THEN 'VW-EV-' WHEN 1 THEN 'TESLA-' ELSE 'BMW-EV-' END,
              CASE WHEN user_id < 1000 THEN lpad(cast(user_id as string), 3, '0') ELSE cast(user_id as string) END) AS vin,
       ts AS event_timestamp,
       cast(floor(value) as int) % 101 AS battery_pct,
       51 + cast(event_id % 250 as double) / 100 AS latitude,
       4 + cast(event_id % 300 as double) / 100 AS longitude,
       cast(floor(value * 10) as int) % 131 AS speed_kmh,
       event_type = 'click' AS charging
FROM {events}""",
    "usage_log": """
SELECT event_id, ts AS start_time, event_type AS warehouse_name, cast(floor(value) / 100 as decimal(18,4)) AS credits_used
FROM {events}""",
    "query_log": """
SELECT event_id AS query_id, concat('user', cast(user_id as string)) AS user_name,
       CASE user_id % 3 WHEN 0 THEN 'ADMIN' WHEN 1 THEN 'ANALYST' ELSE 'DEALER' END AS role_name,
       CASE WHEN event_id % 2 = 0 THEN 'ANALYTICS' ELSE 'LOAD' END AS warehouse_name,
       event_type AS query_type,
       CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'SUCCESS' END AS execution_status,
       cast(floor(value * 10) as bigint) AS total_elapsed_time,
       props AS query_text,
       CASE WHEN user_id % 2 = 0 THEN 'VOLT_MODELS' ELSE 'SANDBOX' END AS database_name,
       ts AS start_time
FROM {events}""",
    "refresh_log": """
SELECT concat('model_', event_type) AS model, ts AS refreshed_at FROM {events}""",
    "permissions": """
SELECT concat('dealer', cast(n_regionkey as string)) AS principal, cast(10 + n_nationkey * 3 as string) AS allowed_region
FROM {nation}""",
}

# Corrected loads: rows that go, rows that come twice, and rows that change.
VIEWS["vehicles_by_postcode_corrected"] = f"""
SELECT postcode, voertuigsoort, brandstof, extern_oplaadbaar, CASE WHEN aantal > 45 THEN aantal - 5 ELSE aantal END AS aantal
FROM ({VIEWS["vehicles_by_postcode"]}) c1 WHERE brandstof <> 'W' OR extern_oplaadbaar = 'J'
UNION ALL
SELECT postcode, voertuigsoort, brandstof, extern_oplaadbaar, aantal
FROM ({VIEWS["vehicles_by_postcode"]}) c2 WHERE postcode LIKE '99%'"""
VIEWS["vehicles_fuel_corrected"] = f"""
SELECT kenteken, CASE WHEN brandstof_omschrijving = 'Diesel' THEN 'Benzine' ELSE brandstof_omschrijving END AS brandstof_omschrijving
FROM ({VIEWS["vehicles_fuel"]}) c1 WHERE brandstof_omschrijving <> 'LPG' OR kenteken LIKE 'X%'
UNION ALL
SELECT kenteken, brandstof_omschrijving FROM ({VIEWS["vehicles_fuel"]}) c2 WHERE brandstof_omschrijving = 'Waterstof'"""

# Raw records as they come, load by load: some fields are in every record, some appear later, and their types vary.
VIEWS["event_records"] = """
SELECT event_id, concat('load-', cast(cast(floor((day(ts) - 1) / 10) as int) as string)) AS load_id,
       concat('{{"id": ', cast(event_id as string), ', "kind": "', event_type, '"',
              CASE WHEN event_id % 7 = 0 THEN ', "battery": null' WHEN event_id % 7 = 1 THEN ', "battery": "low"'
                   ELSE concat(', "battery": ', cast(event_id % 100 as string)) END,
              CASE WHEN day(ts) > 10 THEN concat(', "place": {{"lat": ', cast(event_id % 50 as string), '.5}}') ELSE '' END,
              CASE WHEN day(ts) > 20 AND event_id % 2 = 0 THEN ', "tags": [1, "a"], "moving": true' ELSE '' END, '}}') AS record
FROM {events}"""

# Target lag of the models in refresh_log; one of them was never refreshed.
TARGETS = {"model_click": 3600, "model_error": 60, "model_purchase": 86400, "model_signup": 3600, "model_view": 60,
           "model_never": 3600}

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


class Inputs:
    """The domain tables of one folder of given tables, as DataFrames."""

    def __init__(self, spark: SparkSession, folder: str, stream: bool = False) -> None:
        self.spark, self.folder, self.stream = spark, folder, stream

    def given(self, table: str) -> DataFrame:
        batch = self.spark.read.parquet(f"{self.folder}/{table}.parquet")
        if not self.stream:
            return batch
        # A stream takes a folder or a pattern; the pattern fits a single file and a folder of parts.
        return self.spark.readStream.schema(batch.schema).parquet(f"{self.folder}/{table}.parque[t]")

    def view(self, name: str) -> DataFrame:
        text = VIEWS[name]
        df = self.spark.sql(text, **{t: self.given(t) for t in TABLES if f"{{{t}}}" in text})
        if "kenteken" not in df.columns:
            return df
        # The optimizer would copy the plate's long expression into every test a
        # model makes on it; passing it through explode works it out once per row.
        rest = [column for column in df.columns if column != "kenteken"]
        return df.select(F.explode(F.array("kenteken")).alias("kenteken"), *rest)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in VIEWS:
            raise AttributeError(name)
        return self.view(name)

    @cached_property
    def parking_address_raw(self) -> DataFrame:
        """Parking addresses with the reference only inside the raw record, as the service delivers it."""
        view = self.view("parking_address")
        record = F.parse_json(F.to_json(F.struct(*view.columns)))
        return view.withColumn("raw_json", record).drop("parkingaddressreference")

    def raw_tables(self) -> dict[str, DataFrame]:
        """The raw tables as loaded: typed columns beside the whole record."""
        loaded = {f"{name}_raw": self.raw(name) for name in (
            "vehicles", "vehicles_fuel", "charging_capacity", "vehicles_by_postcode", "telemetry")}
        return {**loaded, "parking_address_raw": self.parking_address_raw}

    def raw(self, view: str) -> DataFrame:
        """A view as a load brings it: the typed columns beside the whole record."""
        df = self.view(view)
        return df.withColumn("raw_json", F.parse_json(F.to_json(F.struct(*df.columns))))

    def pages(self, name: str, limit: int = 1000) -> DataFrame:
        """Pages of at most ``limit`` records of a view as JSON arrays."""
        records = self.view(name).select(F.to_json(F.struct("*")).alias("record"))
        page = F.floor(F.monotonically_increasing_id() / limit)
        return records.withColumn("page_offset", page).groupBy("page_offset").agg(
            F.concat(F.lit("["), F.array_join(F.collect_list("record"), ","), F.lit("]")).alias("body"))

    def targets(self) -> DataFrame:
        return self.spark.createDataFrame(list(TARGETS.items()), "model string, target_lag_seconds bigint")
