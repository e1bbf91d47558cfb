"""Ordered positions per flight: previous event, surface filter, leg length, interpolation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from contrail.functions.geo import STEP_KM, haversine_km, step_count
from contrail.functions.times import clock_seconds, plus_seconds, seconds_between, share_of_seconds
from contrail.operators.skew import hot_keys, with_pieces

# Fixed values.
SURFACE_EVENTS = [
    "entry-parking_position",
    "entry-runway",
    "entry-taxiway",
    "exit-parking_position",
    "exit-runway",
    "exit-taxiway",
]
LOW_ALTITUDE = 3000

CARRIED = ["event_time", "longitude", "latitude", "altitude"]
EVENT_COLUMNS = ["id", "flight_id", "type", *CARRIED]


def legs(
    events: DataFrame, hot: DataFrame | None = None, segment_seconds: int = 3600, carried: Sequence[str] = ()
) -> DataFrame:
    """Each event with the time and position of the one before it in its flight.

    Events order by time, then id. An ordinary flight is one window group. A hot flight is cut into
    time segments, each a group of its own; the last event of the segment before is put in front of a
    segment, so the first event of it also finds its predecessor. ``segment`` is NULL for ordinary
    flights; (flight_id, segment) is how the result is partitioned. ``hot`` are the hot flights
    (``hot_keys``) where the caller knows them. ``carried`` names further columns to keep.
    """
    columns = [*EVENT_COLUMNS, *carried]
    hot = hot_keys(events, "flight_id") if hot is None else hot
    # Events without a time come last in a flight, hence in a last segment of their own.
    segment = F.coalesce(F.floor(clock_seconds(F.col("event_time")) / segment_seconds), F.lit(2**62))

    tagged = with_pieces(events.select(columns), ["flight_id"], hot).select(
        *columns, F.when(F.col("_pieces").isNotNull(), segment).alias("segment")
    )
    in_segment = (
        tagged.where(F.col("segment").isNotNull())
        .groupBy("flight_id", "segment")
        # As in the window below: a NULL id comes last.
        .agg(F.max_by(F.struct(columns), F.struct("event_time", F.col("id").isNull(), "id")).alias("last"))
    )
    by_segment = Window.partitionBy("flight_id").orderBy("segment")
    entering = (
        in_segment.select("flight_id", "segment", F.lag("last").over(by_segment).alias("last"))
        .where(F.col("last").isNotNull())
        .select(*(F.col(f"last.{name}") for name in columns), "segment", F.lit(0).alias("rank"))
    )
    in_order = Window.partitionBy("flight_id", "segment").orderBy(
        "rank", F.asc_nulls_last("event_time"), F.asc_nulls_last("id")
    )
    # The window would shuffle by the same keys. Naming the partition count keeps AQE from merging the
    # partitions by their size here: what follows, paths and interpolation, multiplies the rows.
    partitions = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        tagged.withColumn("rank", F.lit(1))
        .unionByName(entering)
        .repartition(partitions, "flight_id", "segment")
        .select("*", *(F.lag(name).over(in_order).alias(f"prev_{name}") for name in CARRIED))
        .where(F.col("rank") == 1)
        .drop("rank")
    )


def airborne(events: DataFrame) -> DataFrame:
    """Without surface events. Runs after ``legs``: a predecessor may still be a surface event."""
    return events.where(~F.col("type").isin(SURFACE_EVENTS))


def view_events_lagged(events: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    return legs(events, hot).drop("segment")


def view_events_filtered(events: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    return airborne(legs(events, hot)).drop("segment")


def with_leg_distance(lagged: DataFrame, step_km: float = STEP_KM) -> DataFrame:
    """Add the leg's ``distance_km`` and the number of ``steps`` it is cut into."""
    distance = haversine_km(*(F.col(c) for c in ("prev_latitude", "prev_longitude", "latitude", "longitude")))
    return lagged.withColumn("distance_km", distance).withColumn(
        "steps", step_count(F.col("distance_km"), step_km)
    )


def interpolated_points(
    lagged: DataFrame,
    max_altitude: int | None = LOW_ALTITUDE,
    max_steps: int | None = None,
    step_km: float = STEP_KM,
) -> DataFrame:
    """One row per interpolated step of each leg, with step number ``n`` and the struct ``waypoint``.

    Step 0 is the previous event's position; the event's own position starts the next leg. A leg with an
    unknown end has no length and no steps; the longest possible one has 21,747. ``max_steps``, where given,
    cuts a longer series there. The low-altitude filter runs before the expansion, and the series is a
    generator per leg, not a join.
    """
    low = F.lit(True)
    if max_altitude is not None:
        low = (F.col("prev_altitude") <= max_altitude) & (F.col("altitude") <= max_altitude)
    measured = with_leg_distance(lagged.where(low), step_km).where(F.col("steps") > 0)
    count = F.col("steps") if max_steps is None else F.least(F.col("steps"), F.lit(max_steps))
    stepped = measured.withColumn("n", F.explode(F.sequence(F.lit(0).cast("bigint"), count - 1)))

    def between(start, end):
        return F.col(start) + (F.col(end) - F.col(start)) * F.col("n") / F.col("steps")

    elapsed = share_of_seconds(
        seconds_between(F.col("prev_event_time"), F.col("event_time")), F.col("n"), F.col("steps")
    )
    return stepped.withColumn(
        "waypoint",
        F.struct(
            between("prev_latitude", "latitude").alias("lat"),
            between("prev_longitude", "longitude").alias("lon"),
            between("prev_altitude", "altitude").alias("alt"),
            plus_seconds(F.col("prev_event_time"), elapsed).alias("ts"),
        ),
    )


def view_interpolated_steps(lagged: DataFrame, max_steps: int | None = None) -> DataFrame:
    return interpolated_points(lagged, max_steps=max_steps).select(
        "id",
        "flight_id",
        "type",
        "event_time",
        "longitude",
        "latitude",
        "altitude",
        "distance_km",
        "steps",
        F.col("waypoint").alias("waypoints"),
    )
