"""Staging models: rename, upper-case, cast, filter. All narrow, so they fuse with the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Fixed values.
AIRPORT_TYPES = ["small_airport", "medium_airport", "large_airport"]
AIRPORT_CONTINENT = "EU"


def stg_flights(raw: DataFrame) -> DataFrame:
    codes = ["adep", "ades", "icao24", "flt_id"]
    return raw.select(
        "id",
        *(F.upper(code).alias(code) for code in codes),
        F.col("first_seen").cast("timestamp_ntz"),
        F.col("last_seen").cast("timestamp_ntz"),
        F.col("dof").cast("date"),
    )


def stg_events(raw: DataFrame, *more: str) -> DataFrame:
    """Staged events; ``more`` names further columns to keep."""
    return raw.select(
        "id",
        "flight_id",
        "type",
        F.col("event_time").cast("timestamp_ntz"),
        "longitude",
        "latitude",
        "altitude",
        "info",
        *more,
    )


def stg_measurements(raw: DataFrame) -> DataFrame:
    return raw.select("id", "event_id", "type", "value")


def stg_aircrafts(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.upper("icao24").alias("icao24"),
        F.upper("operatoricao").alias("operatoricao"),
        "country",
        F.upper("registration").alias("registration"),
        F.upper("manufacturericao").alias("manufacturericao"),
        F.col("manufacturername").alias("manufacturer"),
        F.upper("typecode").alias("typecode"),
    )


def stg_aircraft_types(raw: DataFrame) -> DataFrame:
    """An engine count of 'C' (coupled engines) stands for two; any other text fails the cast."""
    return raw.withColumn("EngineCount", F.replace("EngineCount", F.lit("C"), F.lit("2")).cast("int"))


def stg_airports(raw: DataFrame) -> DataFrame:
    kept = (F.col("continent") == AIRPORT_CONTINENT) & F.col("type").isin(AIRPORT_TYPES)
    return raw.where(kept).select(
        "id",
        F.col("ident").alias("icao_code"),
        "type",
        "iso_country",
        F.col("name").alias("airport"),
        F.col("latitude_deg").alias("latitude"),
        F.col("longitude_deg").alias("longitude"),
        F.col("elevation_ft").alias("elevation"),
        "municipality",
    )
