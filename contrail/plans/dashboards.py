"""Dashboard queries over the marts. Every parameter is a typed argument bound as a literal."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window, functions as F

from contrail.functions.times import span_start
from contrail.operators.hexagons import agg_by_resolutions
from contrail.operators.ranges import AIRPORT_FRACTIONS, ALTITUDE_FRACTIONS, OVERVIEW_FRACTIONS, range_bucket, with_range_bucket
from contrail.operators.skew import hot_keys, split_join

# Fixed values.
OVERVIEW_ROWS = 80_000
TOP_ROWS = 10
MIN_CONNECTION_FLIGHTS = 10


def fetch(df: DataFrame, at_most: int = OVERVIEW_ROWS):
    """The result as a pandas frame. Fails, and fetches no more, when it has more rows than a page shows."""
    result = df.limit(at_most + 1).toPandas()
    if len(result) > at_most:
        raise ValueError(f"more than {at_most} rows: aggregate or limit the query first")
    return result


def hex_heatmap(totals: DataFrame, rows: int = OVERVIEW_ROWS) -> DataFrame:
    """The busiest cells with the bucket of their count."""
    top = totals.orderBy(F.desc("count"), "hex").limit(rows)
    # The limit has brought these rows into one partition already.
    whole = Window.partitionBy(F.lit(0))
    ends = F.struct(F.min("count").over(whole).alias("low"), F.max("count").over(whole).alias("high"))
    bucket = range_bucket(F.col("count"), F.col("ends"), OVERVIEW_FRACTIONS).alias("bucket")
    return top.withColumn("ends", ends).where(F.col("count") > 0).select("hex", "count", bucket)


def airport_page(legs: DataFrame, lat: float, lon: float, resolutions: Sequence[int]) -> DataFrame:
    """Low traffic per cell around an airport, at each resolution, with the bucket of its count among them.

    The circle bounds the number of cells, so one task can look over those of a resolution.
    """
    counts = agg_by_resolutions(legs, lat, lon, resolutions)
    alike = Window.partitionBy("resolution")
    ends = F.struct(F.min("count").over(alike).alias("low"), F.max("count").over(alike).alias("high"))
    bucket = range_bucket(F.col("count"), F.col("ends"), AIRPORT_FRACTIONS).alias("bucket")
    return counts.withColumn("ends", ends).where(F.col("count") > 0).select("hex", "count", bucket, "resolution")


def current_airports(airports: DataFrame) -> DataFrame:
    return airports.where(F.col("dbt_valid_to").isNull())


def airport_picker(airports: DataFrame, country: str, types: list[str]) -> DataFrame:
    """Distinct names of the current airports of a country, sorted."""
    kept = (F.col("country") == country) & F.col("type").isin(types)
    return current_airports(airports).where(kept).select("airport").distinct().orderBy("airport")


def airport_lookup(airports: DataFrame, name: str) -> DataFrame:
    """The current airport of that name; the lowest id where several share it."""
    return (
        current_airports(airports)
        .where(F.col("airport") == name)
        .orderBy("id")
        .limit(1)
        .select("airport", "icao_code", "type", "country", "latitude", "longitude")
    )


def hourly_traffic(
    flights: DataFrame, events: DataFrame, icao_code: str, hot: DataFrame | None = None
) -> DataFrame:
    """Distinct flights per hour of day that took off from or landed at the airport.

    Both tables are cut to what can match before the join. ``hot`` are the hot flights of the events
    where the caller knows them.
    """
    at_airport = flights.where((F.col("adep") == icao_code) | (F.col("ades") == icao_code)).select(
        "id", "adep", "ades"
    )
    moves = events.where(F.col("type").isin("take-off", "landing")).select("flight_id", "type", "event_time")
    departs = (F.col("adep") == icao_code) & (F.col("type") == "take-off")
    arrives = (F.col("ades") == icao_code) & (F.col("type") == "landing")
    hot = hot_keys(moves, "flight_id") if hot is None else hot
    joined = split_join(moves, at_airport, {"flight_id": "id"}, hot, ["event_time", "type"])
    return (
        joined.where(departs | arrives)
        .groupBy(F.hour("event_time").alias("hour"))
        .agg(F.count_distinct("flight_id").alias("count"))
        .orderBy("hour")
    )


def _flights_at(flights: DataFrame, icao_code: str) -> DataFrame:
    touches = (F.col("adep") == icao_code) | (F.col("ades") == icao_code)
    return flights.where(touches).select("id", F.col("icao24").alias("flown_by"))


def top_aircraft_types(
    flights: DataFrame, aircrafts: DataFrame, icao_code: str, rows: int = TOP_ROWS
) -> DataFrame:
    flown = _flights_at(flights, icao_code)
    keys = ["enginetype", "enginecount", "manufacturericao", "wtc", "typedesignator"]
    typed = aircrafts.where(F.col("typedesignator").isNotNull()).select("icao24", *keys)
    return (
        split_join(flown, typed, {"flown_by": "icao24"}, hot_keys(flown, "flown_by"), ["id"])
        .groupBy(*keys)
        .agg(F.count_distinct("id").alias("count"))
        .orderBy(F.desc("count"), *keys)
        .limit(rows)
    )


def top_operators(flights: DataFrame, aircrafts: DataFrame, icao_code: str, rows: int = TOP_ROWS) -> DataFrame:
    flown = _flights_at(flights, icao_code)
    operated = aircrafts.where(F.col("operatoricao") != "").select("icao24", "operatoricao")
    return (
        split_join(flown, operated, {"flown_by": "icao24"}, hot_keys(flown, "flown_by"), ["id"])
        .groupBy("operatoricao")
        .agg(F.count_distinct("id").alias("count"))
        .orderBy(F.desc("count"), "operatoricao")
        .limit(rows)
    )


def _routed(flights: DataFrame) -> DataFrame:
    return flights.dropna(subset=["adep", "ades"])


def airport_pairs(flights: DataFrame) -> DataFrame:
    return _routed(flights).groupBy("adep", "ades").agg(F.count("adep").alias("count"))


def flight_connections(
    flights: DataFrame, airports: DataFrame, more_than: int = MIN_CONNECTION_FLIGHTS
) -> DataFrame:
    """Busy airport pairs with the current data of both ends.

    Pairs are counted, and the rare ones dropped, before the two joins.
    """
    details = {"latitude": "lat", "longitude": "lon", "airport": "airport", "country": "country"}
    details |= {"municipality": "mun", "type": "type"}

    def end(prefix):
        columns = (F.col(name).alias(f"{prefix}_{short}") for name, short in details.items())
        return current_airports(airports).select(F.col("icao_code").alias(prefix), *columns)

    pairs = airport_pairs(flights).where(F.col("count") > more_than)
    return (
        pairs.join(end("adep"), "adep")
        .join(end("ades"), "ades")
        .select(
            "adep",
            "ades",
            "count",
            *(f"{prefix}_{short}" for short in details.values() for prefix in ("adep", "ades")),
        )
        .orderBy(F.desc("count"), "adep", "ades")
    )


def filter_connections(
    connections: DataFrame,
    fewest: int,
    most: int,
    types: list[str],
    origins: list[str],
    destinations: list[str],
) -> DataFrame:
    return connections.where(
        F.col("count").between(fewest, most)
        & F.col("adep_type").isin(types)
        & F.col("ades_type").isin(types)
        & F.col("adep_country").isin(origins)
        & F.col("ades_country").isin(destinations)
    )


def distinct_countries(airports: DataFrame) -> DataFrame:
    return current_airports(airports).select("country").distinct().orderBy("country")


def busiest_top(flights: DataFrame, first: date, last: date, rows: int = TOP_ROWS) -> DataFrame:
    """The aircraft with most flights in the days from ``first`` to ``last``, both included."""
    in_range = F.col("dof").between(F.lit(first), F.lit(last))
    return (
        _routed(flights)
        .where(in_range)
        .groupBy("icao24")
        .agg(F.count("id").alias("flight_count"))
        .orderBy(F.desc("flight_count"), "icao24")
        .limit(rows)
    )


def busiest_points(
    flights: DataFrame, events: DataFrame, first: date, last: date, hot: DataFrame | None = None
) -> DataFrame:
    """Track points of all flights of the busiest aircraft, not only of those in the day range."""
    # TOP_ROWS rows at most.
    top = F.broadcast(busiest_top(flights, first, last).select("icao24"))
    chosen = _routed(flights).join(top, "icao24", "left_semi").select(F.col("id").alias("flight_key"))
    flown = flights.select(F.col("id").alias("flight_key"), "icao24", "adep", "ades", F.col("dof").alias("flight_day"))
    flown = flown.join(chosen, "flight_key", "left_semi")
    hot = hot_keys(events, "flight_id") if hot is None else hot
    # An event carries its flight's day; joining on it too lets a filter on days prune the stored partitions.
    return split_join(events, flown, {"flight_id": "flight_key", "dof": "flight_day"}, hot, ["id"]).select(
        "icao24",
        "adep",
        "ades",
        "dof",
        "type",
        "event_time",
        "longitude",
        "latitude",
        "altitude",
        "time_passed",
        "distance_flown",
        "id",
    )


def busiest_aircraft(
    flights: DataFrame, events: DataFrame, first: date, last: date, hot: DataFrame | None = None
) -> DataFrame:
    return busiest_points(flights, events, first, last, hot).orderBy("icao24", "event_time", "id")


def default_aircraft(points: DataFrame) -> DataFrame:
    """First, third and fifth of the aircraft in sorted order, the preselection of the page."""
    # Six distinct aircraft at most reach the one-partition window.
    first_six = points.select("icao24").distinct().orderBy("icao24").limit(6)
    position = F.row_number().over(Window.orderBy("icao24"))
    return first_six.withColumn("position", position).where(F.col("position") % 2 == 1).select("icao24")


def filter_points(points: DataFrame, aircraft: DataFrame, first: date, last: date) -> DataFrame:
    """Points of the chosen aircraft (frame ``icao24``) and days that have an altitude."""
    in_range = F.col("dof").between(F.lit(first), F.lit(last))
    return points.where(in_range).dropna(subset=["altitude"]).join(aircraft, "icao24", "left_semi")


def aircraft_paths(points: DataFrame, segment_seconds: int | None = None) -> DataFrame:
    """One row per aircraft, day and route with time-ordered lists of its points.

    A path is a list by definition, as long as the aircraft's points of one day on one route.
    ``segment_seconds`` cuts longer ones into consecutive rows, one per time span that has points, so
    that no row grows with the data.
    """
    keys = ["icao24", "dof", "adep", "ades"]
    listed = ["longitude", "latitude", "time_passed", "altitude", "bucket"]
    bucketed = with_range_bucket(points, "altitude", ALTITUDE_FRACTIONS).dropna(subset=keys)
    if segment_seconds is not None:
        bucketed = bucketed.withColumn("segment", span_start(F.col("event_time"), segment_seconds))
        keys.append("segment")
    ordered = F.sort_array(F.collect_list(F.struct("event_time", "id", *listed)))
    return (
        bucketed.groupBy(*keys)
        .agg(ordered.alias("points"))
        .select(
            *keys,
            *(F.col(f"points.{name}").alias(name) for name in listed),
            F.transform("points", lambda p: F.struct(p["longitude"].alias("lon"), p["latitude"].alias("lat"))).alias(
                "coordinates"
            ),
        )
    )
