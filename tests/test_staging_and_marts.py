from datetime import date, datetime

import pytest
from helpers import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from contrail.operators import enrich, staging


def test_flights_are_upper_cased_and_cast(spark):
    raw = spark.createDataFrame(
        [("f1", "lszh", None, "4b1a", "swr1", "2024-01-01 10:00:00.5", "2024-01-01 11:00:00", "2024-01-01", "v")],
        "id string, adep string, ades string, icao24 string, flt_id string, first_seen string, last_seen string,"
        " dof string, version string",
    )
    row = staging.stg_flights(raw).first()
    assert tuple(row) == (
        "f1",
        "LSZH",
        None,
        "4B1A",
        "SWR1",
        datetime(2024, 1, 1, 10, 0, 0, 500000),
        datetime(2024, 1, 1, 11),
        date(2024, 1, 1),
    )


def types(spark, *entries):
    return spark.createDataFrame(
        list(entries),
        "AircraftDescription string, Description string, Designator string, EngineCount string, EngineType string,"
        " ManufacturerCode string, ModelFullName string, WTC string",
    )


def test_coupled_engines_count_as_two_and_junk_fails(spark):
    def staged(count):
        raw = types(spark, ("LandPlane", "d", "A1", count, "Jet", "m", "f", "L"))
        return staging.stg_aircraft_types(raw).first().EngineCount

    assert [staged("C"), staged("4"), staged(None)] == [2, 4, None]
    with pytest.raises(PySparkException):
        staged("x")


def test_case_variants_of_a_type_survive_and_fan_out(spark):
    raw = types(
        spark,
        ("LandPlane", "d", "a320", "2", "Jet", "Airbus", "f1", "M"),
        ("LandPlane", "d", "A320", "2", "Jet", "Airbus", "f2", "M"),
        ("LandPlane", "d", "A320", "2", "Jet", "Airbus", "f3", "M"),
        ("Helicopter", "d", "H1", "2", "Jet", "Airbus", "f4", "M"),
    )
    known = enrich.int_aircraft_types(staging.stg_aircraft_types(raw))
    assert rows(known, "TypeDesignator") == [("A320",), ("A320",)]
    aircrafts = spark.createDataFrame(
        [("1", "o", "c", "r", "AIRBUS", "Airbus", "A320"), ("2", "o", "c", "r", None, "x", None)],
        "icao24 string, operatoricao string, country string, registration string, manufacturericao string,"
        " manufacturer string, typecode string",
    )
    assert rows(enrich.dim_aircrafts(aircrafts, known), "icao24", "typedesignator") == [
        ("1", "A320"),
        ("1", "A320"),
        ("2", None),
    ]


def test_airport_filter(spark):
    def airport(key, continent, kind):
        return (key, "I", kind, "n", 1.0, 2.0, 3, continent, "C", "m")

    raw = spark.createDataFrame(
        [airport(1, "EU", "small_airport"), airport(2, "EU", "heliport"), airport(3, "NA", "large_airport")],
        "id int, ident string, type string, name string, latitude_deg double, longitude_deg double, elevation_ft int,"
        " continent string, iso_country string, municipality string",
    )
    assert rows(staging.stg_airports(raw), "id") == [(1,)]


def test_events_without_flight_are_left_out_and_reported(spark):
    flights = spark.createDataFrame([("f1", date(2024, 1, 1))], "id string, dof date")
    facts = spark.createDataFrame([("e1", "f1"), ("e2", "f9"), ("e3", None)], "id string, flight_id string")
    assert rows(enrich.int_events(facts, flights)) == [("e1", "f1", date(2024, 1, 1))]
    assert rows(enrich.orphan_events(facts, flights), "id") == [("e2",), ("e3",)]


def test_measurements_become_columns(spark):
    values = spark.createDataFrame(
        [("e1", enrich.TIME_PASSED, 5.0), ("e1", enrich.TIME_PASSED, 7.0), ("e1", enrich.DISTANCE_FLOWN, 2.0), ("e2", "?", 1.0)],
        "event_id string, type string, value double",
    )
    assert rows(enrich.int_measurements(values)) == [("e1", 7.0, 2.0), ("e2", None, None)]


def test_agg_orders_golden(spark):
    facts = spark.createDataFrame(
        [
            (date(2024, 1, 1), "completed", 100.0),
            (date(2024, 1, 1), "completed", 100.0),
            (date(2024, 1, 2), "cancelled", 100.0),
            (date(2024, 1, 2), "shipped", 100.0),
        ],
        "order_date date, status string, amount double",
    )
    assert rows(enrich.agg_orders(facts)) == [
        (date(2024, 1, 1), "completed", 200.0),
        (date(2024, 1, 2), "cancelled", 100.0),
        (date(2024, 1, 2), "shipped", 100.0),
    ]


def test_payment_methods_are_listed_sorted_with_repeats(spark):
    payments = spark.createDataFrame(
        [(1, "card", 1.0), (1, "bank", 2.0), (1, "card", 3.0), (1, None, 4.0), (2, None, 5.0)],
        "order_id bigint, payment_method string, amount double",
    )
    assert rows(enrich.payment_methods_agg(payments)) == [(1, "bank, card, card", 10.0), (2, "", 5.0)]


def test_order_without_payment_stays(spark):
    orders = spark.createDataFrame([(1, 7, date(2024, 1, 1), "new")], "id bigint, user_id bigint, order_date date, status string")
    payments = spark.createDataFrame([], "order_id bigint, payment_method string, amount double")
    assert rows(enrich.fact_orders(orders, payments)) == [(1, 7, date(2024, 1, 1), "new", None, None)]


def test_airport_filter_reaches_the_scan(spark, tmp_path):
    source = spark.range(10).select(
        F.lit("EU").alias("continent"),
        F.lit("small_airport").alias("type"),
        *(F.lit("x").alias(c) for c in ("id", "ident", "name", "iso_country", "municipality", "keywords")),
        *(F.lit(1.0).alias(c) for c in ("latitude_deg", "longitude_deg")),
        F.lit(1).alias("elevation_ft"),
    )
    source.write.parquet(f"{tmp_path}/airports")
    df = staging.stg_airports(spark.read.parquet(f"{tmp_path}/airports"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(continent,EU)" in plan
    assert "In(type, [" in plan.split("PushedFilters")[1]
    assert "keywords" not in plan
