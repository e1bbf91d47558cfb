"""The tests declared for each model, and their translation to checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, LongType, TimestampNTZType

from contrail.operators import quality
from contrail.operators.enrich import DISTANCE_FLOWN, TIME_PASSED
from contrail.operators.staging import AIRPORT_TYPES
from contrail.operators.trajectory import SURFACE_EVENTS

# The accepted values and ranges.
FLIGHT_EVENTS = [
    "first-xing-fl100",
    "first-xing-fl245",
    "first-xing-fl50",
    "first-xing-fl70",
    "first_seen",
    "landing",
    "last-xing-fl100",
    "last-xing-fl245",
    "last-xing-fl50",
    "last-xing-fl70",
    "last_seen",
    "level-end",
    "level-start",
    "take-off",
    "top-of-climb",
    "top-of-descent",
]
AIRCRAFT_KINDS = ["LandPlane", "Amphibian", "Helicopter", "Gyrocopter", "SeaPlane", "Tilt-wing"]
ENGINE_TYPES = ["Jet", "Turboprop/Turboshaft", "Piston", "Electric", "Rocket"]
WAKE_CATEGORIES = ["L", "M", "H", "J", "L/M"]
RAW_AIRPORT_TYPES = ["heliport", "closed", *AIRPORT_TYPES, "seaplane_base", "balloonport"]
LONGITUDES, LATITUDES = (-180, 180), (-90, 90)
ALTITUDE_LIMIT = 200_000
AMOUNTS = DISTANCES = STEPS = (0, 100_000)

TYPES = {
    "time": (TimestampNTZType(),),
    "date": (DateType(),),
    "float": (DoubleType(),),
    "number": (IntegerType(), LongType()),
}


def _present(*columns: str) -> list[dict]:
    return [{"kind": "not_null", "columns": [c]} for c in columns]


def _typed(kind: str, *columns: str) -> list[dict]:
    return [{"kind": "type", "columns": [c], "type": kind} for c in columns]


def _listed(column: str, values: list[str]) -> dict:
    return {"kind": "accepted_values", "columns": [column], "values": values}


def _range(column: str, low=None, high=None, strictly=False, if_present=False) -> dict:
    return {
        "kind": "between",
        "columns": [column],
        "low": low,
        "high": high,
        "strictly": strictly,
        "if_present": if_present,
    }


def _unique(*columns: str) -> dict:
    return {"kind": "unique", "columns": list(columns)}


def _position(prefix: str = "", if_present: bool = False) -> list[dict]:
    longitude, latitude, altitude = (prefix + name for name in ("longitude", "latitude", "altitude"))
    return [
        *_typed("float", longitude, latitude),
        *_typed("number", altitude),
        _range(longitude, *LONGITUDES, if_present=if_present),
        _range(latitude, *LATITUDES, if_present=if_present),
        _range(altitude, high=ALTITUDE_LIMIT, strictly=True, if_present=if_present),
    ]


_FLIGHTS = _present("id", "icao24", "first_seen", "last_seen", "dof")
_EVENTS = [
    *_present("id", "flight_id", "type", "event_time", "longitude", "latitude"),
    _listed("type", SURFACE_EVENTS + FLIGHT_EVENTS),
    *_position(),
]

DECLARED: dict[str, list[dict]] = {
    "stg_flights": _FLIGHTS,
    "stg_events": [*_EVENTS, *_typed("time", "event_time")],
    "stg_measurements": [
        *_present("id", "event_id", "type", "value"),
        _unique("id"),
        _listed("type", [DISTANCE_FLOWN, TIME_PASSED]),
        *_typed("float", "value"),
    ],
    "stg_aircrafts": _present("icao24"),
    "stg_aircraft_types": [
        *_present("ManufacturerCode", "Designator", "AircraftDescription", "EngineCount"),
        *_present("EngineType", "WTC", "ModelFullName", "Description"),
        _listed("AircraftDescription", AIRCRAFT_KINDS),
        _listed("EngineType", ENGINE_TYPES),
        _listed("WTC", WAKE_CATEGORIES),
        *_typed("number", "EngineCount"),
    ],
    "stg_airports": [
        *_present("id", "icao_code", "type", "iso_country", "airport", "latitude", "longitude"),
        _listed("type", RAW_AIRPORT_TYPES),
        *_typed("float", "latitude", "longitude"),
    ],
    "int_events": _present("dof"),
    "int_measurements": _present("event_id", "time_passed", "distance_flown"),
    "int_aircraft_types": [
        _unique("ManufacturerCode", "TypeDesignator", "AircraftType", "EngineCount", "EngineType", "WTC")
    ],
    "fct_flights": _FLIGHTS,
    "fct_events": [*_EVENTS, *_typed("float", "time_passed", "distance_flown")],
    "dim_aircrafts": [*_present("icao24"), *_typed("number", "enginecount")],
    "dim_airports": [
        *_present("icao_code", "type", "airport", "latitude", "longitude", "municipality"),
        *_present("country_code", "country", "continent"),
        _listed("type", AIRPORT_TYPES),
        *_typed("float", "latitude", "longitude"),
    ],
    "dim_customers": [
        _unique("id"),
        *_present("id", "first_name", "last_name", "country_name", "last_updated_dt", "dbt_valid_from"),
    ],
    "fact_orders": [
        _unique("id"),
        *_present("id", "user_id", "order_date", "status", "payment_methods", "amount"),
        {"kind": "relationships", "columns": ["user_id"], "to": "dim_customers", "field": "id"},
        _range("amount", *AMOUNTS),
    ],
    "view_events_lagged": [*_typed("time", "prev_event_time"), *_position("prev_", if_present=True)],
    "view_events_filtered": [*_present("type"), _listed("type", FLIGHT_EVENTS)],
    "view_interpolated_steps": [
        _range("distance_km", *DISTANCES, if_present=True),
        _range("steps", *STEPS, if_present=True),
    ],
    "agg_yearly_metric_array": [*_present("hex", "year_start", "metric_array"), *_typed("date", "year_start")],
    # Sums of whole counts stay whole here.
    "sum_yearly_metric_array": [*_present("hex", "count"), *_typed("number", "count")],
}


def label(test: dict) -> str:
    return f"{test['kind']}({', '.join(test['columns'])})"


def check(test: dict, models) -> quality.Check:
    """The check of a declared test; ``models`` has a model frame per attribute, for references."""
    columns = tuple(test["columns"])
    column = columns[0]
    match test["kind"]:
        case "not_null":
            return quality.Check("not_null", columns, quality.not_null(column))
        case "accepted_values":
            return quality.Check("accepted_values", columns, quality.accepted_values(column, test["values"]))
        case "between":
            where = F.col(column).isNotNull() if test["if_present"] else None
            fails = quality.between(column, test["low"], test["high"], test["strictly"], where)
            return quality.Check("between", columns, fails)
        case "type":
            return quality.Check("type", columns, types=TYPES[test["type"]])
        case "unique":
            return quality.Check("unique", columns)
        case "relationships":
            return quality.Check("relationships", columns, parent=(getattr(models, test["to"]), test["field"]))
    raise ValueError(f"unknown test {test['kind']}")


def declared(name: str) -> list[quality.Check]:
    """The checks of a model that refer to no other model."""
    return [check(t, None) for t in DECLARED[name]]


def model_report(models, name: str, df: DataFrame | None = None) -> DataFrame:
    """(test, failures) of one model."""
    df = getattr(models, name) if df is None else df
    return quality.run_checks(df, [check(t, models) for t in DECLARED[name]])
