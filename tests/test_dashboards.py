import re
from datetime import date

import pytest
from helpers import at, rows
from pyspark.sql import functions as F

from contrail.operators import ranges
from contrail.plans import dashboards

FLIGHTS = "id string, adep string, ades string, icao24 string, dof date"
POINTS = (
    "id string, flight_id string, type string, event_time timestamp_ntz, longitude double, latitude double,"
    " altitude int, dof date, time_passed double, distance_flown double"
)


def flights(spark, *entries):
    return spark.createDataFrame([(i, a, b, c, date(2024, 1, d)) for i, a, b, c, d in entries], FLIGHTS)


def points(spark, *entries):
    full = [(i, f, "landing", at(s), 1.0 * s, 2.0, alt, date(2024, 1, 1), 0.5, None) for i, f, s, alt in entries]
    return spark.createDataFrame(full, POINTS)


def test_breaks_are_shares_of_the_range_cut_towards_zero(spark):
    df = spark.createDataFrame([(-10,), (7,)], "v int")
    found = ranges.range_breaks(df, "v", [0.01, 0.5, 0.99, 1])
    assert rows(found) == [(0, -9), (1, -1), (2, 6), (3, 7)]
    bucketed = ranges.with_range_bucket(df.union(df.sparkSession.createDataFrame([(-1,), (None,)], "v int")), "v", [0.01, 0.5, 1])
    assert rows(bucketed) == [(-1, 2), (-10, 0), (7, 3), (None, 0)]


def test_hours_count_departures_and_arrivals_once(spark):
    legs = flights(spark, ("f", "A", "B", "p", 1), ("g", "B", "A", "p", 1), ("h", "A", "A", "p", 1))
    moves = spark.createDataFrame(
        [
            ("f", "take-off", at(0)),
            ("f", "landing", at(60)),
            ("g", "take-off", at(0)),
            ("g", "landing", at(3700)),
            ("h", "take-off", at(10)),
            ("h", "landing", at(20)),
        ],
        "flight_id string, type string, event_time timestamp_ntz",
    )
    hours = dashboards.hourly_traffic(legs, moves, "A").collect()
    assert [tuple(r) for r in hours] == [(0, 2), (1, 1)]


def test_pairs_leave_out_unknown_ends(spark):
    df = flights(spark, ("f", "A", "B", "p", 1), ("g", "A", "B", "p", 1), ("h", "A", None, "p", 1))
    assert rows(dashboards.airport_pairs(df)) == [("A", "B", 2)]


AIRPORTS = (
    "id int, icao_code string, airport string, type string, country string, latitude double, longitude double,"
    " municipality string, dbt_valid_to timestamp_ntz"
)


def airport(key, code, kind="large_airport", closed=None, country="C"):
    return (key, code, f"name {code}", kind, country, 1.0, 2.0, "m", closed)


def test_connections_use_current_versions_and_filter(spark):
    df = flights(spark, *((f"f{i}", "A", "B", "p", 1) for i in range(3)), ("g", "B", "A", "p", 1))
    dims = spark.createDataFrame([airport(1, "A", closed=at(0)), airport(1, "A", "small_airport"), airport(2, "B")], AIRPORTS)
    found = dashboards.flight_connections(df, dims, more_than=2)
    assert rows(found, "adep", "ades", "count", "adep_type") == [("A", "B", 3, "small_airport")]
    assert len(found.columns) == 15

    def kept(low, high, types, origins=("C",), destinations=("C",)):
        args = low, high, list(types), list(origins), list(destinations)
        return dashboards.filter_connections(found, *args).count()

    assert kept(3, 3, ["small_airport", "large_airport"]) == 1
    assert kept(4, 9, ["small_airport", "large_airport"]) == 0
    assert kept(0, 9, ["large_airport"]) == 0
    assert kept(0, 9, ["small_airport", "large_airport"], origins=["D"]) == 0


def test_picker_and_lookup(spark):
    dims = spark.createDataFrame(
        [airport(5, "B"), airport(3, "A"), airport(4, "A"), airport(9, "C", country="D"), airport(1, "A", closed=at(0))],
        AIRPORTS,
    )
    assert [r[0] for r in dashboards.airport_picker(dims, "C", ["large_airport"]).collect()] == ["name A", "name B"]
    assert dashboards.airport_lookup(dims.withColumn("latitude", F.col("id") * 1.0), "name A").first().latitude == 3.0
    assert [r[0] for r in dashboards.distinct_countries(dims).collect()] == ["C", "D"]


def test_busiest_aircraft_take_all_their_flights(spark):
    df = flights(
        spark,
        ("f1", "A", "B", "p", 1),
        ("f2", "A", "B", "p", 1),
        ("f3", "A", "B", "p", 20),
        ("f4", None, "B", "p", 1),
        ("g1", "A", "B", "q", 1),
    )
    track = points(spark, ("1", "f1", 5, 10), ("2", "f3", 3, 20), ("3", "f4", 1, 30), ("4", "g1", 1, 40))
    track = track.withColumn("dof", F.when(F.col("flight_id") == "f3", F.lit(date(2024, 1, 20))).otherwise(F.col("dof")))
    top = dashboards.busiest_top(df, date(2024, 1, 1), date(2024, 1, 1), rows=1)
    assert rows(top) == [("p", 2)]
    found = dashboards.busiest_aircraft(df, track, date(2024, 1, 1), date(2024, 1, 1)).collect()
    assert [(r.id, r.icao24, r.dof.day) for r in found if r.icao24 == "p"] == [("2", "p", 20), ("1", "p", 1)]


def test_default_aircraft_skips_every_second_of_six(spark):
    df = spark.createDataFrame([(c,) for c in "hgfedcba" for _ in range(2)], "icao24 string")
    assert rows(dashboards.default_aircraft(df)) == [("a",), ("c",), ("e",)]


def test_paths_are_ordered_lists_and_segments_their_pieces(spark):
    df = flights(spark, ("f", "A", "B", "p", 1))
    track = points(spark, ("b", "f", 10, 0), ("a", "f", 10, 100), ("c", "f", 0, 50), ("d", "f", 4000, 80), ("e", "f", 1, None))
    all_points = dashboards.busiest_points(df, track, date(2024, 1, 1), date(2024, 1, 1))
    chosen = dashboards.filter_points(
        all_points, spark.createDataFrame([("p",)], "icao24 string"), date(2024, 1, 1), date(2024, 1, 1)
    )
    path = dashboards.aircraft_paths(chosen).first()
    assert path.longitude == [0.0, 10.0, 10.0, 4000.0]
    assert path.altitude == [50, 100, 0, 80]
    assert path.bucket == [5, 7, 0, 6]
    assert [tuple(c) for c in path.coordinates] == [(x, 2.0) for x in path.longitude]
    pieces = dashboards.aircraft_paths(chosen, 3600).orderBy("segment").collect()
    assert [p.altitude for p in pieces] == [[50, 100, 0], [80]]


def test_days_prune_the_stored_track(spark, tmp_path):
    points(spark, ("a", "f", 10, 0)).write.partitionBy("dof").parquet(f"{tmp_path}/facts")
    track = spark.read.parquet(f"{tmp_path}/facts")
    df = flights(spark, ("f", "A", "B", "p", 1))
    first, last = date(2024, 1, 1), date(2024, 1, 10)
    chosen = dashboards.filter_points(
        dashboards.busiest_points(df, track, first, last, hot=spark.createDataFrame([], "flight_id string, pieces bigint")),
        spark.createDataFrame([("p",)], "icao24 string"), first, last,
    )
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*dof#\d+ >= 2024-01-01[^\]]*dof#\d+ <= 2024-01-10", plan)
    assert chosen.count() == 1


def test_fetch_is_bounded(spark):
    assert len(dashboards.fetch(spark.range(5), 5)) == 5
    with pytest.raises(ValueError):
        dashboards.fetch(spark.range(6), 5)


def test_heatmap_keeps_the_busiest_and_drops_zero(spark):
    totals = spark.createDataFrame([("a", 100), ("b", 0), ("c", 50), ("d", 1)], "hex string, count bigint")
    assert rows(dashboards.hex_heatmap(totals)) == [("a", 100, 7), ("c", 50, 6), ("d", 1, 1)]
    assert rows(dashboards.hex_heatmap(totals, rows=2)) == [("a", 100, 7), ("c", 50, 1)]
