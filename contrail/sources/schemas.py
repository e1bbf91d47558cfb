"""Declared schemas of the raw tables and the columns their load gates require."""

from __future__ import annotations

from pyspark.sql.types import StructType


def _schema(strings: str, **other: str) -> StructType:
    """Columns in the given order, all text but those in ``other``."""
    schema = StructType()
    for name in strings.split():
        schema = schema.add(name, other.get(name, "string"))
    return schema


# Names and types of the raw columns.
FLIGHTS = _schema("id adep ades icao24 flt_id first_seen last_seen dof version")
EVENTS = _schema(
    "id flight_id type event_time longitude latitude altitude source version info",
    longitude="double",
    latitude="double",
    altitude="integer",
)
MEASUREMENTS = _schema("id event_id type value version", value="double")
AIRPORTS = _schema(
    "id ident type name latitude_deg longitude_deg elevation_ft continent iso_country iso_region municipality"
    " scheduled_service gps_code iata_code local_code home_link wikipedia_link keywords",
    id="integer",
    latitude_deg="double",
    longitude_deg="double",
    elevation_ft="integer",
)
AIRCRAFT_TYPES = _schema(
    "AircraftDescription Description Designator EngineCount EngineType ManufacturerCode ModelFullName WTC"
)
AIRCRAFTS = _schema(
    "icao24 timestamp acars adsb built categoryDescription country engines firstFlightDate firstSeen"
    " icaoAircraftClass lineNumber manufacturerIcao manufacturerName model modes nextReg operator"
    " operatorCallsign operatorIata operatorIcao owner prevReg regUntil registered registration selCal"
    " serialNumber status typecode vdl"
)

# Columns that must not be NULL after a load.
GATED_COLUMNS = {
    "flights": ["id", "icao24", "first_seen", "last_seen", "dof", "version"],
    "events": ["id", "flight_id", "type", "event_time", "longitude", "latitude", "source", "version"],
    "measurements": ["id", "event_id", "type", "value", "version"],
    "airports": ["id", "latitude_deg", "longitude_deg", "type", "name", "ident", "iso_country"],
    "aircrafts": ["icao24"],
    "aircraft_types": [
        "AircraftDescription",
        "Description",
        "Designator",
        "EngineCount",
        "EngineType",
        "ManufacturerCode",
        "ModelFullName",
        "WTC",
    ],
}
