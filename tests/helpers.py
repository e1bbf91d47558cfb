from datetime import datetime, timedelta


def rows(df, *columns):
    """Sorted tuples of the frame."""
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=repr)


def at(seconds, day=1):
    return datetime(2024, 1, day) + timedelta(seconds=seconds)


EVENTS = (
    "id string, flight_id string, type string, event_time timestamp_ntz, longitude double, latitude double, altitude int"
)


def events(spark, *entries):
    """Events from (id, flight_id, type, event_time, longitude, latitude, altitude)."""
    return spark.createDataFrame(list(entries), EVENTS)
