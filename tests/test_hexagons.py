from datetime import date

import pytest
from helpers import at, events, rows
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from contrail.functions import geo
from contrail.operators import accumulate, hexagons, trajectory
from contrail.session import empty_frame

CENTRES = [(q, r) for q in range(-3, 4) for r in range(-3, 4)]


def centre(q, r, resolution):
    """Coordinates of a cell's centre, the inverse of the grid's scaling."""
    qx, qy, ry = geo.axial_scale(resolution)
    lat = r / ry
    return lat, (q + lat * qy) / qx


@pytest.mark.parametrize("resolution", [6, 8, 10])
def test_centre_lies_in_its_cell(spark, resolution):
    points = spark.createDataFrame([(q, r, *centre(q, r, resolution)) for q, r in CENTRES], "q int, r int, lat double, lon double")
    found = points.select("q", "r", geo.hex_cell(F.col("lat"), F.col("lon"), resolution).alias("cell"))
    assert all((row.q, row.r) == tuple(row.cell) for row in found.collect())


def test_nearest_centre_wins(spark):
    """The rounding agrees with looking for the closest of all centres."""
    steps = [i / 7 for i in range(-10, 11)]
    points = [(x, y) for x in steps for y in steps]
    df = spark.createDataFrame(points, "qf double, rf double")
    found = df.select("qf", "rf", geo.nearest_cell(F.col("qf"), F.col("rf")).alias("cell")).collect()

    def squared(qf, rf, q, r):
        dq, dr = qf - q, rf - r
        return dq * dq + dr * dr + dq * dr

    for row in found:
        best = min(squared(row.qf, row.rf, q, r) for q, r in CENTRES)
        assert squared(row.qf, row.rf, *row.cell) == pytest.approx(best, abs=1e-9)


def test_impossible_points_have_no_cell(spark):
    points = spark.createDataFrame([(91.0, 0.0), (0.0, -181.0), (None, 0.0), (float("nan"), 0.0)], "lat double, lon double")
    assert points.where(geo.hex_cell(F.col("lat"), F.col("lon")).isNotNull()).count() == 0


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(*[st.integers(-40, 40)] * 4), min_size=1, max_size=30))
def test_path_is_connected_and_as_long_as_the_distance(spark, ends):
    df = spark.createDataFrame(ends, "aq bigint, ar bigint, bq bigint, br bigint")
    a, b = (F.struct(F.col(f"{e}q").alias("q"), F.col(f"{e}r").alias("r")) for e in "ab")
    for row in df.select("*", geo.hex_path(a, b).alias("path"), geo.hex_distance(a, b).alias("hops")).collect():
        path = [tuple(cell) for cell in row.path]
        assert path[0] == (row.aq, row.ar) and path[-1] == (row.bq, row.br)
        assert len(path) == len(set(path)) == row.hops + 1
        for (q, r), (q2, r2) in zip(path, path[1:]):
            assert max(abs(q2 - q), abs(r2 - r), abs(q2 - q + r2 - r)) == 1


def test_unknown_end_has_no_path(spark):
    cell = F.struct(F.lit(0).cast("bigint").alias("q"), F.lit(0).cast("bigint").alias("r"))
    nothing = F.when(F.lit(False), cell)
    assert spark.range(1).select(geo.hex_path(cell, nothing)).first()[0] is None


def tracks(spark, *flights):
    """Flights given as (flight, day, cells), each cell visited in turn."""
    entries = []
    for flight, day, cells in flights:
        for i, (q, r) in enumerate(cells):
            lat, lon = centre(q, r, 6)
            entries.append((f"{flight}{day}{i}", flight, "landing", at(i, day), lon, lat, 100))
    return events(spark, *entries)


def dated_legs(df):
    """Legs of events whose day is the flight's."""
    return trajectory.legs(df.withColumn("dof", F.to_date("event_time")), carried=["dof"])


def test_a_flight_counts_once_per_cell(spark):
    df = tracks(spark, ("f", 1, [(0, 0), (2, 0), (0, 0)]), ("g", 1, [(1, 0), (1, 1)]))
    traffic = hexagons.hex_traffic(trajectory.legs(df))
    assert rows(traffic) == [("h6_0_0", 1), ("h6_1_0", 2), ("h6_1_1", 1), ("h6_2_0", 1)]


def test_rows_and_arrays_give_the_same_cells(spark):
    df = trajectory.legs(tracks(spark, ("f", 1, [(0, 0), (5, -3), (2, 7)]), ("g", 2, [(1, 1), (1, 1)])))
    by_row = hexagons.path_cells(df, 6, "id")
    by_array = hexagons.hex_paths(df).select("id", F.explode("grid_array").alias("c")).select("id", "c.q", "c.r")
    assert rows(by_row, "id", "q", "r") == rows(by_array)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from("fgh"), st.integers(1, 25), st.tuples(st.integers(-3, 3), st.integers(-3, 3))), max_size=25
    ),
    st.sets(st.sampled_from("fg")),
)
def test_counting_agrees_with_count_distinct(spark, visits, hot):
    entries = [
        (f"{i:03}", flight, "landing", at(i, day), centre(q, r, 6)[1], centre(q, r, 6)[0], 0)
        for i, (flight, day, (q, r)) in enumerate(visits)
    ]
    legs = trajectory.legs(events(spark, *entries), spark.createDataFrame([(h, 2) for h in hot], "flight_id string, pieces bigint"), 3600)
    cells = hexagons.path_cells(legs, 6)
    plain = cells.groupBy("q", "r").agg(F.count_distinct("flight_id").alias("count"))
    assert rows(hexagons.count_flights(cells, "q", "r")) == rows(plain)


def test_period_counts_agree_with_each_period(spark):
    legs = dated_legs(tracks(spark, ("f", 1, [(0, 0), (2, 0)]), ("f", 12, [(0, 0), (0, 1)]), ("g", 12, [(2, 0), (0, 0)])))
    counts = hexagons.period_counts(legs)
    for slot, (start, end) in enumerate([(1, 11), (11, 21)]):
        single = hexagons.hex_traffic(legs, start=date(2024, 1, start), end=date(2024, 1, end))
        assert rows(counts.where(F.col("slot") == slot), "hex", "count") == rows(single)


def test_airport_traffic_agrees_with_every_point(spark):
    df = trajectory.legs(tracks(spark, ("f", 1, [(0, 0), (9, 2)]), ("g", 1, [(-9, 3), (4, -6)]), ("h", 1, [(80, 80), (90, 90)])))
    points = trajectory.interpolated_points(df)
    at_point = F.col("waypoint.lat"), F.col("waypoint.lon")
    near = points.where(geo.haversine_km(*at_point, F.lit(0.1), F.lit(0.1)) <= 30)
    expected = near.groupBy(geo.hex_id(geo.hex_cell(*at_point, 8), 8)).agg(F.count_distinct("flight_id"))
    assert rows(hexagons.agg_by_coordinates(df, 0.1, 0.1)) == rows(expected)
    assert expected.count() > 20


def test_circle_across_the_180th_meridian(spark):
    df = events(
        spark,
        ("a", "f", "landing", at(0), -179.95, 10.0, 100),
        ("b", "f", "landing", at(9), -179.9, 10.0, 100),
    )
    assert hexagons.agg_by_coordinates(trajectory.legs(df), 10.0, 179.95).count() > 0


def test_distinct_cells_need_no_shuffle_after_the_window(spark):
    """Between the window and the first grouping of cells there is no exchange."""
    plan = hexagons.hex_traffic(trajectory.legs(tracks(spark, ("f", 1, [(0, 0), (1, 0)]))))
    text = plan._jdf.queryExecution().executedPlan().toString()
    above_window = text.split("Window [lag(longitude")[0]
    assert above_window.count("Exchange hashpartitioning") == 2


# Arrays of counts per period

YEAR = date(2024, 1, 1)


def counts(spark, **by_hex):
    return spark.createDataFrame(list(by_hex.items()), "hex string, count bigint")


def state_of(df):
    return {row.hex: row.metric_array for row in df.collect()}


def test_appending_follows_the_three_cases(spark):
    state = empty_frame(spark, accumulate.STATE_SCHEMA)
    for current in ({"a": 1, "b": 2}, {"a": 3}, {"c": 4}):
        frame = accumulate.accumulate(state, counts(spark, **current), YEAR)
        state = spark.createDataFrame(frame.collect(), accumulate.STATE_SCHEMA)
    assert state_of(state) == {"a": [1, 3, 0], "b": [2, 0, 0], "c": [0, 0, 4]}


def test_a_slot_is_replaced_by_a_second_run(spark):
    state = spark.createDataFrame([("a", YEAR, [1, 3]), ("b", YEAR, [2, 0])], accumulate.STATE_SCHEMA)
    again = accumulate.accumulate(state, counts(spark, a=5, c=6), YEAR, 0)
    assert state_of(again) == {"a": [5, 3], "b": [0, 0], "c": [6, 0]}
    later = accumulate.accumulate(state, counts(spark, c=6), YEAR, 3)
    assert state_of(later) == {"a": [1, 3, 0, 0], "b": [2, 0, 0, 0], "c": [0, 0, 0, 6]}


def test_other_years_are_no_part_of_the_state(spark):
    state = spark.createDataFrame([("a", date(2023, 1, 1), [1, 3])], accumulate.STATE_SCHEMA)
    assert state_of(accumulate.accumulate(state, counts(spark, a=5), YEAR)) == {"a": [5]}


def test_one_pass_equals_the_steps(spark):
    df = tracks(spark, ("f", 1, [(0, 0), (2, 0)]), ("f", 12, [(0, 0), (0, 1)]), ("g", 27, [(2, 0), (0, 0)]))
    legs = dated_legs(df)
    state = empty_frame(spark, accumulate.STATE_SCHEMA)
    for slot, (start, end) in enumerate([(1, 11), (11, 21), (21, 31)]):
        period = hexagons.hex_traffic(legs, start=date(2024, 1, start), end=date(2024, 1, end))
        state = spark.createDataFrame(accumulate.accumulate(state, period, YEAR, slot).collect(), accumulate.STATE_SCHEMA)
    whole = accumulate.metric_arrays(hexagons.period_counts(legs), accumulate.loaded_periods(legs))
    assert state_of(whole) == state_of(state)
    assert {len(a) for a in state_of(whole).values()} == {3}
    totals = {row.hex: row["count"] for row in accumulate.sum_yearly_metric_array(whole).collect()}
    assert totals == {hex_: sum(a) for hex_, a in state_of(state).items()}


def test_quotes_are_stripped_from_ids(spark):
    state = spark.createDataFrame([('"h6_0_0"', YEAR, [1, 2])], accumulate.STATE_SCHEMA)
    assert rows(accumulate.sum_yearly_metric_array(state)) == [("h6_0_0", 3)]


def test_a_leg_takes_the_short_way_over_the_180th_meridian(spark):
    df = trajectory.legs(
        events(
            spark,
            ("a", "f", "landing", at(0), 179.9, 10.0, 100),
            ("b", "f", "landing", at(9), -179.9, 10.0, 100),
            ("c", "f", "landing", at(18), 175.0, 11.0, 100),
        )
    )
    paths = {r.id: [tuple(c) for c in r.grid_array] for r in hexagons.hex_paths(df, 8).collect()}
    own = {r.id: tuple(r.cell) for r in hexagons.hex_cells(df, 8).collect()}
    width = 0.2 * geo.KM_PER_DEGREE_LON / geo.STEP_KM
    assert set(paths) == {"b", "c"} and len(paths["b"]) < 1.2 * width
    for first, last in (("b", "a"), ("c", "b")):
        assert paths[first][0] == own[first] and paths[first][-1] == own[last]
        for q, r in paths[first][1:-1]:
            lat, lon = centre(q, r, 8)
            assert abs(lon) <= 180.01 and (lon > 174.9 or lon < -179.8) and 9.9 < lat < 11.1
    by_row = hexagons.path_cells(df, 8, "id").groupBy("id").count()
    assert rows(by_row) == [(i, len(p)) for i, p in sorted(paths.items())]


def test_paths_over_the_180th_meridian_agree_with_their_rows(spark):
    places = [(179.99, 10.0), (-179.99, 10.0), (-179.99, 10.0), (178.3, 12.5), (-170.0, -89.9), (169.0, 90.0), (0.0, 90.5)]
    df = trajectory.legs(
        events(spark, *((f"e{i}", "f", "landing", at(i), lon, lat, 100) for i, (lon, lat) in enumerate(places)))
    )
    for resolution in (3, 6):
        by_array = hexagons.hex_paths(df, resolution).select("id", F.explode("grid_array").alias("c")).select("id", "c.q", "c.r")
        assert rows(hexagons.path_cells(df, resolution, "id").select("id", "q", "r")) == rows(by_array)
    assert {r.id: r.grid_array for r in hexagons.hex_paths(df).collect()}["e6"] is None


def test_a_path_is_computed_once(spark):
    df = trajectory.legs(events(spark, ("a", "f", "landing", at(0), 179.9, 10.0, 1), ("b", "f", "landing", at(9), -179.9, 10.0, 1)))
    plan = hexagons.hex_paths(df)._jdf.queryExecution().analyzed().toString()
    # Lambdas compute what they repeat each time: one series of hops in the straight path and one in the one brought back.
    assert plan.count("sequence(") <= 2 and len(plan) < 40_000


def test_all_resolutions_at_once_equal_each_alone(spark):
    df = trajectory.legs(tracks(spark, ("f", 1, [(0, 0), (9, 2)]), ("g", 1, [(-9, 3), (4, -6)])))
    whole = hexagons.agg_by_resolutions(df, 0.1, 0.1, [7, 8, 9])
    for resolution in (7, 8, 9):
        alone = hexagons.agg_by_coordinates(df, 0.1, 0.1, resolution)
        assert rows(whole.where(F.col("resolution") == resolution), "hex", "count") == rows(alone)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [") == 2 + plan.count("WindowGroupLimit")  # the legs are made once


def test_legs_without_a_start_are_not_expanded(spark):
    df = trajectory.legs(events(spark, ("a", "f", "landing", at(0), 0.1, 0.1, 100), ("b", "f", "landing", at(9), None, 0.1, 100)))
    assert hexagons.points_near(df, 0.1, 0.1, 30).count() == 0
