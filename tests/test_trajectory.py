from datetime import datetime

import pytest
from helpers import at, events, rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from contrail.functions.times import seconds_between, share_of_seconds, span_start
from contrail.operators import trajectory
from contrail.operators.skew import hot_keys

NO_FLIGHT = "flight_id string, pieces bigint"


def none_hot(spark):
    return spark.createDataFrame([], NO_FLIGHT)


def test_predecessor_by_time_then_id_and_may_be_a_surface_event(spark):
    df = events(
        spark,
        ("b", "f", "landing", at(10), 2.0, 2.0, 20),
        ("a", "f", "entry-runway", at(10), 1.0, 1.0, 10),
        ("c", "f", "take-off", at(0), 0.0, 0.0, None),
        ("d", "g", "take-off", at(5), 9.0, 9.0, 90),
    )
    lagged = trajectory.view_events_lagged(df)
    assert rows(lagged, "id", "prev_event_time", "prev_longitude", "prev_altitude") == [
        ("a", at(0), 0.0, None),
        ("b", at(10), 1.0, 10),
        ("c", None, None, None),
        ("d", None, None, None),
    ]
    assert rows(trajectory.view_events_filtered(df), "id", "prev_longitude") == [("b", 1.0), ("c", None), ("d", None)]


def test_unknown_type_is_dropped_by_the_surface_filter(spark):
    df = events(spark, ("a", "f", None, at(0), 0.0, 0.0, 0))
    assert trajectory.view_events_filtered(df).count() == 0


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    moments=st.lists(st.tuples(st.sampled_from("fgh"), st.one_of(st.none(), st.integers(0, 40))), max_size=40),
    segment_seconds=st.sampled_from([1, 7, 3600]),
    hot=st.sets(st.sampled_from("fgx")),
)
def test_splitting_hot_flights_changes_nothing(spark, moments, segment_seconds, hot):
    entries = [
        (f"{i:03}", flight, "landing", None if second is None else at(second), float(i), 0.0, i)
        for i, (flight, second) in enumerate(moments)
    ]
    df = events(spark, *entries)
    chosen = spark.createDataFrame([(h, 2) for h in hot], NO_FLIGHT)
    plain = trajectory.legs(df, none_hot(spark)).drop("segment")
    split = trajectory.legs(df, chosen, segment_seconds).drop("segment")
    assert rows(split) == rows(plain)
    assert plain.count() == len(entries)


def leg(spark, lat2, lon2, alt1=100, alt2=200, seconds=100.0):
    return events(
        spark,
        ("a", "f", "take-off", at(0), 5.0, 47.0, alt1),
        ("b", "f", "landing", at(seconds), lon2, lat2, alt2),
    )


def test_distance_of_one_degree_of_latitude(spark):
    lagged = trajectory.view_events_lagged(leg(spark, 48.0, 5.0))
    row = trajectory.with_leg_distance(lagged).where("id = 'b'").first()
    assert row.distance_km == pytest.approx(111.1949, abs=1e-4)
    assert row.steps == 121


def test_antipodes_have_a_distance(spark):
    df = events(spark, ("a", "f", "t", at(0), 0.0, 0.0, 0), ("b", "f", "t", at(1), 180.0, 0.0, 0))
    row = trajectory.with_leg_distance(trajectory.view_events_lagged(df)).where("id = 'b'").first()
    assert row.distance_km == pytest.approx(20015.0868, abs=1e-3)


def test_interpolation_runs_from_the_previous_event_up_to_the_own(spark):
    points = trajectory.interpolated_points(trajectory.legs(leg(spark, 47.02, 5.0)))
    found = points.orderBy("n").select("n", "steps", "waypoint.*").collect()
    assert [r.n for r in found] == list(range(found[0].steps))
    first = found[0]
    assert (first.lat, first.lon, first.alt, first.ts) == (47.0, 5.0, 100.0, at(0))
    for r in found:
        assert r.lat == 47.0 + (47.02 - 47.0) * r.n / r.steps
        assert r.alt == 100 + 100 * r.n / r.steps
        assert r.ts == at((100 * r.n * 2 + r.steps) // (2 * r.steps))


def test_high_short_and_first_legs_give_no_points(spark):
    def count(df):
        return trajectory.view_interpolated_steps(trajectory.legs(df)).count()

    assert count(leg(spark, 47.02, 5.0, alt2=3001)) == 0
    assert count(leg(spark, 47.02, 5.0, alt1=None)) == 0
    assert count(leg(spark, 47.0, 5.0)) == 0
    assert count(leg(spark, 47.02, 5.0, alt2=3000)) > 0


@pytest.mark.parametrize("altitude", [None, 3000])
def test_an_unknown_end_gives_no_distance_and_no_steps(spark, altitude):
    df = events(
        spark,
        ("a", "f", "t", at(0), None, 47.0, 100),
        ("b", "f", "t", at(60), 5.0, 47.1, 100),
        ("c", "f", "t", at(120), 5.1, None, 100),
    )
    legs = trajectory.legs(df)
    measured = trajectory.with_leg_distance(legs)
    assert [tuple(r) for r in measured.select("distance_km", "steps").collect()] == [(None, None)] * 3
    assert trajectory.interpolated_points(legs, max_altitude=altitude).count() == 0


def test_splitting_a_flight_keeps_events_of_unknown_id_last(spark):
    entries = [
        ("x", "f", "t", at(10), 1.0, 47.0, 100),
        (None, "f", "t", at(10), 2.0, 47.0, 100),
        ("y", "f", "t", at(10), 3.0, 47.0, 100),
        ("z", "f", "t", at(4000), 4.0, 47.0, 100),
        ("n", None, "t", at(10), 5.0, 47.0, 100),
        ("o", None, "t", at(4000), 6.0, 47.0, 100),
    ]
    df = events(spark, *entries)
    split = trajectory.legs(df, hot_keys(df, "flight_id", rows=1)).drop("segment")
    plain = trajectory.legs(df).drop("segment")
    assert rows(split) == rows(plain)
    assert plain.where("id = 'z'").first().prev_longitude == 2.0


def test_series_is_cut_only_on_demand(spark):
    legs = trajectory.legs(leg(spark, 47.0, 60.0))
    measured = trajectory.with_leg_distance(legs).where("id = 'b'").first()
    assert measured.steps > 3000
    assert trajectory.interpolated_points(legs).count() == measured.steps
    cut = trajectory.interpolated_points(legs, max_steps=3000)
    assert cut.agg(F.max("n"), F.count("*")).first()[:] == (2999, 3000)


def test_seconds_count_boundaries_and_round_half_up(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1, 0, 0, 0, 900000), datetime(2024, 1, 1, 0, 0, 1, 100000))], "a timestamp_ntz, b timestamp_ntz"
    )
    row = df.select(
        seconds_between(F.col("a"), F.col("b")).alias("crossed"),
        share_of_seconds(F.lit(21), F.lit(1), F.lit(2)).alias("half"),
        share_of_seconds(F.lit(20), F.lit(1), F.lit(3)).alias("down"),
        span_start(F.col("b"), 60).alias("minute"),
    ).first()
    assert tuple(row) == (1, 11, 7, datetime(2024, 1, 1))


def test_daylight_saving_does_not_move_seconds(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Zurich")
    try:
        df = spark.createDataFrame(
            [(datetime(2024, 3, 31, 1, 30), datetime(2024, 3, 31, 3, 30))], "a timestamp_ntz, b timestamp_ntz"
        )
        assert df.select(seconds_between(F.col("a"), F.col("b"))).first()[0] == 7200
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
