"""Traffic per hexagonal cell: paths between positions, distinct flights per cell."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from math import cos, radians

from pyspark.sql import Column, DataFrame, functions as F

from contrail.functions import geo
from contrail.functions.times import period_slot, year_start
from contrail.operators.trajectory import interpolated_points

HERE, THERE = ["latitude", "longitude"], ["prev_latitude", "prev_longitude"]


def hex_cells(points: DataFrame, resolution: int = geo.DEFAULT_RESOLUTION) -> DataFrame:
    """Add the cell id of each point."""
    cell = geo.hex_cell(F.col("latitude"), F.col("longitude"), resolution)
    return points.withColumn("cell", cell).withColumn("hex", geo.hex_id(F.col("cell"), resolution))


def _leg_ends(resolution: int) -> list[Column]:
    ends = geo.leg_ends(*map(F.col, HERE + THERE), resolution)
    return [end.alias(name) for name, end in ends.items()]


_ENDS = ["here", "there", "turned", "by"]


def hex_paths(lagged: DataFrame, resolution: int = geo.DEFAULT_RESOLUTION) -> DataFrame:
    """Per leg with four known coordinates the array of cells from its end back to its start.

    A leg across the 180th meridian takes the short way.
    """
    ends = {name: F.col(name) for name in _ENDS}
    return (
        lagged.dropna(subset=HERE + THERE)
        .select("id", "flight_id", *_leg_ends(resolution))
        .select("id", "flight_id", geo.leg_path(ends, resolution).alias("grid_array"))
    )


def path_cells(legs: DataFrame, resolution: int, *carried: str) -> DataFrame:
    """One row (flight_id, segment, carried, q, r) per cell of each leg's path.

    The same cells as exploding ``hex_paths``, but the hop number is expanded and the cells are
    computed on the expanded rows: generated code instead of an interpreted array lambda. Legs with an
    unknown or impossible coordinate give no row.
    """
    segment = F.col("segment") if "segment" in legs.columns else F.lit(None).cast("bigint")
    usable = geo.on_earth(*map(F.col, HERE)) & geo.on_earth(*map(F.col, THERE))
    keys = ["flight_id", "segment", *carried]
    steps = (
        legs.where(usable)
        .select("flight_id", segment.alias("segment"), *carried, *_leg_ends(resolution))
        .withColumn("hops", geo.hex_distance(F.col("here"), F.col("turned")))
        .withColumn("k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("hops"))))
    )
    # Cells of legs across the 180th meridian are brought back, but for the two ends. Each value that several
    # others need is a column, so that no expression is repeated inside another.
    path = geo.path_cell(*map(F.col, ["here", "turned", "hops", "k"]))
    on_plane = steps.select("*", path.alias("cell")).select("*", F.col("cell.q").alias("pq"), F.col("cell.r").alias("pr"))
    lat, lon = geo.centre(F.col("pq"), F.col("pr"), resolution)
    crossing = F.col("by") != 0
    placed = on_plane.withColumn("centre", F.when(crossing, lon)).withColumn("near", geo.near_side(F.col("centre")))
    back = placed.withColumn("back", geo.hex_cell(lat, F.col("near"), resolution))

    def final(name: str) -> Column:
        end = F.when(F.col("k") == 0, F.col(f"here.{name}")).when(F.col("k") == F.col("hops"), F.col(f"there.{name}"))
        far = end.otherwise(F.coalesce(f"back.{name}", f"p{name}"))
        return F.when(crossing, far).otherwise(F.col(f"p{name}")).alias(name)

    return back.select(*keys, final("q"), final("r"))


def count_flights(cells: DataFrame, *by: str) -> DataFrame:
    """Distinct flights per group of ``by``.

    Rows are first made distinct within (flight, segment). Frames from ``legs`` are partitioned that
    way already, so this needs no shuffle. An ordinary flight lives in one partition and can then simply
    be counted, summed up before the shuffle; only the few flights cut into segments keep their id
    through it to be counted once.
    """
    split_flight = F.when(F.col("segment").isNotNull(), F.col("flight_id"))
    once = cells.select("flight_id", "segment", *by).distinct()
    partial = once.groupBy(*by, split_flight.alias("split")).agg(F.count("flight_id").alias("flights"))
    return partial.groupBy(*by).agg(
        F.sum(F.when(F.col("split").isNull(), F.col("flights")).otherwise(1)).alias("count")
    )


def named(counts: DataFrame, resolution: int, *kept: str) -> DataFrame:
    cell = F.struct("q", "r")
    return counts.select(geo.hex_id(cell, resolution).alias("hex"), *kept, "count")


def hex_traffic(
    legs: DataFrame,
    resolution: int = geo.DEFAULT_RESOLUTION,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """Distinct flights per cell, of the flights whose day is in [start, end).

    A period's own count has both bounds, and the legs then have their day of flight. Leaving out ``start`` counts
    everything so far.
    """
    if start is not None:
        legs = legs.where(F.col("dof") >= F.lit(start))
    if end is not None:
        legs = legs.where(F.col("dof") < F.lit(end))
    return named(count_flights(path_cells(legs, resolution), "q", "r"), resolution)


def period_counts(legs: DataFrame, resolution: int = geo.DEFAULT_RESOLUTION) -> DataFrame:
    """Distinct flights per cell and 10-day period, all periods in one pass.

    A flight counts for the period of its day of flight, which all its legs have, whenever its events were.
    """
    dated = legs.withColumn("year_start", year_start(F.col("dof"))).withColumn("slot", period_slot(F.col("dof")))
    cells = path_cells(dated, resolution, "year_start", "slot")
    counts = count_flights(cells, "year_start", "slot", "q", "r")
    return named(counts, resolution, "year_start", "slot")


def points_near(legs: DataFrame, lat: float, lon: float, radius_km: float) -> DataFrame:
    """(flight_id, segment, lat, lon): the interpolated points of low legs within a circle.

    Interpolated points stay inside the rectangle of their leg's two ends, so legs whose rectangle
    misses the one around the circle are left out before the expansion, and points outside it before
    their distance is computed.
    """
    half_lat = radius_km / geo.KM_PER_DEGREE_LAT * 1.01
    known = legs.dropna(subset=HERE + THERE)

    def reaches(column, center, half):
        low, high = F.least(column, f"prev_{column}"), F.greatest(column, f"prev_{column}")
        return (low <= center + half) & (high >= center - half)

    near = known.where(reaches("latitude", lat, half_lat))
    at, beside = F.col("waypoint.lat"), F.col("waypoint.lon")
    inside = at.between(lat - half_lat, lat + half_lat)
    # A circle that holds a pole or crosses the 180th meridian has no simple range of longitudes.
    if abs(lat) + half_lat < 90:
        half_lon = radius_km / (geo.KM_PER_DEGREE_LON * cos(radians(abs(lat) + half_lat))) * 1.01
        if abs(lon) + half_lon < 180:
            near = near.where(reaches("longitude", lon, half_lon))
            inside = inside & beside.between(lon - half_lon, lon + half_lon)
    segment = F.col("segment") if "segment" in legs.columns else F.lit(None).cast("bigint")
    within = geo.haversine_km(at, beside, F.lit(lat), F.lit(lon)) <= radius_km
    points = interpolated_points(near).where(inside & within)
    return points.select("flight_id", segment.alias("segment"), at.alias("lat"), beside.alias("lon"))


def agg_by_coordinates(
    legs: DataFrame, lat: float, lon: float, resolution: int = 8, radius_km: float = 30.0
) -> DataFrame:
    """Distinct low flights per cell among the interpolated points around (lat, lon)."""
    cell = geo.hex_cell(F.col("lat"), F.col("lon"), resolution)
    cells = points_near(legs, lat, lon, radius_km).select("flight_id", "segment", cell.alias("cell"))
    return named(count_flights(cells.select("flight_id", "segment", "cell.q", "cell.r"), "q", "r"), resolution)


def agg_by_resolutions(
    legs: DataFrame, lat: float, lon: float, resolutions: Sequence[int], radius_km: float = 30.0
) -> DataFrame:
    """(resolution, hex, count): the same for several resolutions, the legs being expanded once.

    A point takes its cell of every resolution; the rows that this makes meet their like in the task
    that made them.
    """

    def at(resolution):
        cell = geo.hex_cell(F.col("lat"), F.col("lon"), resolution)
        return F.struct(F.lit(resolution).alias("resolution"), cell["q"].alias("q"), cell["r"].alias("r"))

    points = points_near(legs, lat, lon, radius_km)
    cells = points.select("flight_id", "segment", F.inline(F.array(*map(at, resolutions))))
    counts = count_flights(cells, "resolution", "q", "r")
    name = F.concat(F.lit("h"), F.concat_ws("_", "resolution", "q", "r"))
    return counts.select("resolution", name.alias("hex"), "count")
