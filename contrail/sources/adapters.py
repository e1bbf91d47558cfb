"""Raw tables of the flight domain derived from the star-schema parquet tables.

Every column is an SQL expression that Spark and DuckDB read alike, so the same text gives the input
of a query and of its oracle.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Adapter:
    tables: str  # a table name, or "left right on <condition>" for a lookup
    columns: dict[str, str]
    where: str | None = None


# The columns of the star-schema tables that the adapters read. Declared, so that no job
# has to look into the files for them.
TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,"
    " l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING,"
    " l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}

# The mapping of the star-schema columns.
ADAPTERS = {
    "src_flights": Adapter(
        "orders",
        {
            "id": "CAST(o_orderkey AS STRING)",
            "adep": "CASE WHEN o_orderkey % 17 = 0 THEN NULL"
            " ELSE concat('ap', CAST(o_custkey % 10 AS STRING)) END",
            "ades": "CASE WHEN o_orderkey % 13 = 0 THEN NULL"
            " ELSE concat('ap', CAST((o_custkey + o_orderkey) % 10 AS STRING)) END",
            "icao24": "concat('a', CAST(o_custkey AS STRING))",
            "flt_id": "concat('fl', CAST(o_orderkey AS STRING))",
            "first_seen": "concat('2024-01-', lpad(CAST(1 + o_orderkey % 30 AS STRING), 2, '0'),"
            " ' 0', CAST(o_orderkey % 10 AS STRING), ':00:00')",
            "last_seen": "concat('2024-01-', lpad(CAST(1 + o_orderkey % 30 AS STRING), 2, '0'),"
            " ' 1', CAST(o_orderkey % 10 AS STRING), ':30:00')",
            "dof": "concat('2024-01-', lpad(CAST(1 + o_orderkey % 30 AS STRING), 2, '0'))",
            "version": "'v002'",
        },
    ),
    "src_events": Adapter(
        "events",
        {
            "id": "CAST(event_id AS STRING)",
            "flight_id": "CAST(user_id AS STRING)",
            "type": "CASE event_type"
            " WHEN 'click' THEN CASE WHEN event_id % 2 = 0 THEN 'take-off' ELSE 'landing' END"
            " WHEN 'view' THEN CASE WHEN event_id % 2 = 0 THEN 'level-start' ELSE 'level-end' END"
            " WHEN 'signup' THEN CASE WHEN event_id % 2 = 0 THEN 'first_seen' ELSE 'last_seen' END"
            " WHEN 'purchase' THEN CASE WHEN event_id % 2 = 0 THEN 'top-of-climb' ELSE 'top-of-descent' END"
            " ELSE CASE WHEN event_id % 2 = 0 THEN 'entry-taxiway' ELSE 'exit-runway' END END",
            "event_time": "ts",
            "longitude": "5.0E0 + (event_id % 100) / 100.0E0",
            "latitude": "47.0E0 + ((event_id * 37) % 100) / 100.0E0",
            "altitude": "CASE WHEN event_id % 50 = 0 THEN NULL ELSE CAST(FLOOR(value * 20) AS INT) END",
            "source": "'osn'",
            "version": "'v002'",
            "info": "CAST(NULL AS STRING)",
        },
    ),
    "src_measurements": Adapter(
        "event_kinds",
        {
            "id": "CAST(event_id * 2 + k AS STRING)",
            "event_id": "CAST(event_id AS STRING)",
            "type": "CASE WHEN k = 0 THEN 'Time Passed (s)' ELSE 'Distance flown (NM)' END",
            "value": "CASE WHEN k = 0 THEN value ELSE value / 2 END",
            "version": "'v002'",
        },
        "NOT (k = 1 AND event_id % 9 = 0)",
    ),
    "src_airports": Adapter(
        "supplier",
        {
            "id": "CAST(s_suppkey AS INT)",
            "ident": "concat('AP', CAST(s_suppkey AS STRING))",
            "type": "CASE s_suppkey % 4 WHEN 0 THEN 'large_airport' WHEN 1 THEN 'medium_airport'"
            " WHEN 2 THEN 'small_airport' ELSE 'heliport' END",
            "name": "s_name",
            "latitude_deg": "47.0E0 + ((s_suppkey * 37) % 100) / 100.0E0",
            "longitude_deg": "5.0E0 + (s_suppkey % 100) / 100.0E0",
            "elevation_ft": "CAST(FLOOR(s_acctbal / 10) AS INT)",
            "continent": "CASE WHEN s_suppkey % 5 = 4 THEN 'NA' ELSE 'EU' END",
            "iso_country": "concat('C', CAST(s_nationkey AS STRING))",
            "municipality": "CASE WHEN s_suppkey % 7 = 6 THEN NULL"
            " ELSE concat('Town', CAST(s_nationkey AS STRING)) END",
        },
    ),
    "country_codes": Adapter(
        "nation region on n_regionkey = r_regionkey",
        {
            "code": "concat('C', CAST(n_nationkey AS STRING))",
            "name": "n_name",
            "continent": "r_name",
        },
    ),
    "src_aircrafts": Adapter(
        "customer nation on c_nationkey = n_nationkey",
        {
            "icao24": "concat('a', CAST(c_custkey AS STRING))",
            "operatoricao": "CASE WHEN c_custkey % 6 = 0 THEN '' ELSE lower(substr(c_mktsegment, 1, 3)) END",
            "country": "n_name",
            "registration": "lower(c_name)",
            "manufacturericao": "concat('brand#', CAST(1 + c_custkey % 25 AS STRING))",
            "manufacturername": "c_name",
            "typecode": "CASE c_custkey % 7 WHEN 0 THEN 'standard' WHEN 1 THEN 'economy'"
            " WHEN 2 THEN 'medium' WHEN 3 THEN 'promo' WHEN 4 THEN 'small' WHEN 5 THEN 'large'"
            " ELSE 'unknown' END",
        },
    ),
    "src_aircraft_types": Adapter(
        "part",
        {
            "AircraftDescription": "CASE WHEN p_partkey % 5 = 0 THEN 'Helicopter' ELSE 'LandPlane' END",
            "Description": "p_name",
            "Designator": "p_type",
            "EngineCount": "CASE WHEN p_size % 10 = 9 THEN 'C' ELSE CAST(1 + p_size % 4 AS STRING) END",
            "EngineType": "CASE p_size % 3 WHEN 0 THEN 'Jet' WHEN 1 THEN 'Piston'"
            " ELSE 'Turboprop/Turboshaft' END",
            "ManufacturerCode": "p_brand",
            "ModelFullName": "p_name",
            "WTC": "CASE p_size % 4 WHEN 0 THEN 'L' WHEN 1 THEN 'M' WHEN 2 THEN 'H' ELSE 'J' END",
        },
    ),
    "stg_customers": Adapter(
        "customer",
        {
            "id": "c_custkey",
            "first_name": "c_name",
            "last_name": "c_mktsegment",
            "country_code": "CASE WHEN c_custkey % 11 = 0 THEN 'ZZ'"
            " ELSE concat('C', CAST(c_nationkey AS STRING)) END",
            "last_updated_dt": "DATE '2024-01-01'",
            "dbt_valid_from": "DATE '2024-01-01'",
            "dbt_valid_to": "CASE WHEN c_custkey % 20 = 0 THEN DATE '2024-06-01' ELSE NULL END",
        },
    ),
    "stg_orders": Adapter(
        "orders",
        {
            "id": "o_orderkey",
            "user_id": "o_custkey",
            "order_date": "CAST(o_orderdate AS DATE)",
            "status": "o_orderstatus",
        },
    ),
    "stg_payments": Adapter(
        "lineitem",
        {
            "id": "l_orderkey * 10 + l_linenumber",
            "order_id": "l_orderkey",
            "payment_method": "l_returnflag",
            "amount": "l_extendedprice",
        },
    ),
}


class StarSchema:
    """The flight-domain raw tables over one folder of star-schema parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.raw = cache(self._raw)

    def table(self, name: str) -> DataFrame:
        if name == "event_kinds":
            # Two measurement kinds per event: a narrow expansion, no join.
            return self.table("events").selectExpr("*", "explode(array(0, 1)) AS k")
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.folder}/{name}.parquet")

    def _raw(self, name: str) -> DataFrame:
        adapter = ADAPTERS[name]
        if " on " in adapter.tables:
            tables, condition = adapter.tables.split(" on ")
            left, right = tables.split()
            key, lookup_key = condition.split(" = ")
            base, lookup = self.table(left), self.table(right)
            base = base.join(lookup, base[key] == lookup[lookup_key])
        else:
            base = self.table(adapter.tables)
        if adapter.where:
            base = base.where(adapter.where)
        return base.selectExpr(*(f"{expr} AS {name}" for name, expr in adapter.columns.items()))


def duckdb_view(name: str) -> str:
    """The same raw table as a SELECT that DuckDB runs."""
    adapter = ADAPTERS[name]
    columns = ", ".join(f"{expr} AS {alias}" for alias, expr in adapter.columns.items())
    if " on " in adapter.tables:
        tables, condition = adapter.tables.split(" on ")
        source = " JOIN ".join(tables.split()) + f" ON {condition}"
    elif adapter.tables == "event_kinds":
        source = "(SELECT *, unnest([0, 1]) AS k FROM events)"
    else:
        source = adapter.tables
    where = f" WHERE {adapter.where}" if adapter.where else ""
    return f"SELECT {columns} FROM {source}{where}"
