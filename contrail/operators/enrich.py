"""Intermediate models and mart tables built from joins and groupings.

No join carries a broadcast hint on a dimension: dimensions may grow, so Spark decides from their size
(statistics first, the measured shuffle size under AQE).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from contrail.operators.skew import hot_keys, split_join
from contrail.operators.staging import AIRPORT_TYPES

# Fixed values.
TIME_PASSED = "Time Passed (s)"
DISTANCE_FLOWN = "Distance flown (NM)"
LAND_PLANE = "LandPlane"


def int_events(events: DataFrame, flights: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Events with the day of flight. Events of unknown flights are left out.

    ``hot`` are the hot flights of the events where the caller knows them.
    """
    hot = hot_keys(events, "flight_id") if hot is None else hot
    days = flights.select(F.col("id").alias("flight_key"), "dof")
    return split_join(events, days, {"flight_id": "flight_key"}, hot, ["id"])


def orphan_events(events: DataFrame, flights: DataFrame) -> DataFrame:
    """The events that ``int_events`` leaves out."""
    known = flights.select(F.col("id").alias("flight_key"))
    return events.join(known, events["flight_id"] == known["flight_key"], "left_anti")


def int_measurements(measurements: DataFrame) -> DataFrame:
    """One row per event with a column per kind.

    Conditional maxima instead of ``pivot``: one partial aggregation and one shuffle instead of two.
    """

    def largest(kind):
        return F.max(F.when(F.col("type") == kind, F.col("value")))

    return measurements.groupBy("event_id").agg(
        largest(TIME_PASSED).alias("time_passed"),
        largest(DISTANCE_FLOWN).alias("distance_flown"),
    )


def fct_events(events: DataFrame, measurements: DataFrame) -> DataFrame:
    """``int_events`` rows with their pivoted measurements."""
    values = measurements.withColumnRenamed("event_id", "event_key")
    return events.join(values, events["id"] == values["event_key"], "left").drop("event_key")


def int_aircraft_types(types: DataFrame) -> DataFrame:
    """Distinct land planes. Codes are upper-cased after the grouping, so case variants stay apart."""
    raw_columns = ["ManufacturerCode", "Designator", "AircraftDescription", "WTC", "EngineType", "EngineCount"]
    return (
        types.where(F.col("AircraftDescription").isin([LAND_PLANE]))
        .select(raw_columns)
        .distinct()
        .select(
            F.upper("ManufacturerCode").alias("ManufacturerCode"),
            F.upper("Designator").alias("TypeDesignator"),
            F.col("AircraftDescription").alias("AircraftType"),
            "WTC",
            "EngineType",
            "EngineCount",
        )
    )


def dim_aircrafts(aircrafts: DataFrame, types: DataFrame) -> DataFrame:
    """Aircraft with every type record of their manufacturer and type code (may fan out)."""
    keys = {"manufacturericao": "ManufacturerCode", "typecode": "TypeDesignator"}
    known = types.withColumn("typedesignator_", F.col("TypeDesignator"))
    hot = hot_keys(aircrafts, *keys)
    return split_join(aircrafts, known, keys, hot, ["icao24"], "left").select(
        "icao24",
        "operatoricao",
        "country",
        "registration",
        "manufacturericao",
        "manufacturer",
        F.col("typedesignator_").alias("typedesignator"),
        F.col("AircraftType").alias("aircrafttype"),
        F.col("EngineCount").alias("enginecount"),
        F.col("EngineType").alias("enginetype"),
        F.col("WTC").alias("wtc"),
    )


def dim_airports(airport_versions: DataFrame, countries: DataFrame) -> DataFrame:
    """Airport versions with a known municipality and country."""
    kept = F.col("type").isin(AIRPORT_TYPES) & F.col("municipality").isNotNull()
    names = countries.select(
        F.col("code").alias("country_code"),
        F.col("name").alias("country"),
        "continent",
    )
    versions = airport_versions.where(kept)
    return versions.join(names, versions["iso_country"] == names["country_code"])


def dim_customers(customers: DataFrame, countries: DataFrame) -> DataFrame:
    names = countries.select(F.col("code").alias("country_key"), F.col("name").alias("country_name"))
    return customers.join(names, customers["country_code"] == names["country_key"], "left").select(
        "id",
        "first_name",
        "last_name",
        "country_name",
        "last_updated_dt",
        "dbt_valid_from",
        "dbt_valid_to",
    )


def payment_methods_agg(payments: DataFrame) -> DataFrame:
    """Sorted list of payment methods (with repeats) and amount paid per order.

    Payments are first counted per order and method, so what is gathered per order is one entry per
    distinct method, however many payments an order has.
    """
    separator = ", "
    per_method = payments.groupBy("order_id", "payment_method").agg(
        F.count("*").cast("int").alias("payments"), F.sum("amount").alias("amount")
    )
    known = F.when(F.col("payment_method").isNotNull(), F.struct("payment_method", "payments"))
    gathered = per_method.groupBy("order_id").agg(
        F.sort_array(F.collect_list(known)).alias("methods"),
        F.sum("amount").alias("amount"),
    )
    listed = F.flatten(F.transform("methods", lambda m: F.array_repeat(m["payment_method"], m["payments"])))
    return gathered.select("order_id", F.array_join(listed, separator).alias("payment_methods"), "amount")


def fact_orders(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders with their payments, which are grouped before the join."""
    paid = payment_methods_agg(payments)
    return orders.join(paid, orders["id"] == paid["order_id"], "left").select(
        "id", "user_id", "order_date", "status", "payment_methods", "amount"
    )


def agg_orders(order_facts: DataFrame) -> DataFrame:
    return order_facts.groupBy("order_date", "status").agg(F.sum("amount").alias("total_amount"))
