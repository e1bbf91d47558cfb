"""For each registered query the DuckDB statement that must give the same rows."""

from __future__ import annotations

import re
from math import cos, radians, sqrt

from contrail.operators import ranges, staging
from contrail.plans import model_tests, registry
from contrail.sources import schemas
from contrail.sources.adapters import ADAPTERS, duckdb_view


def _list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _text(array: str, kind: str = "VARCHAR") -> str:
    return f"array_to_string(list_transform({array}, lambda x: coalesce(CAST(x AS {kind}), 'null')), ',')"


def _float(value: float) -> str:
    return f"{value!r}E0"


def _cell(source: str, keep: str) -> str:
    """Cells (q, r) of the fractional coordinates qf, rf of ``source``."""
    return f"""
    SELECT {keep},
      CAST(CASE WHEN dq > dr AND dq > ds THEN -r0 - s0 ELSE q0 END AS BIGINT) AS q,
      CAST(CASE WHEN dq > dr AND dq > ds THEN r0 WHEN dr > ds THEN -q0 - s0 ELSE r0 END AS BIGINT) AS r
    FROM (SELECT *, abs(q0 - qf) AS dq, abs(r0 - rf) AS dr, abs(s0 - (-qf - rf)) AS ds
      FROM (SELECT *, floor(qf + 0.5E0) AS q0, floor(rf + 0.5E0) AS r0, floor(-qf - rf + 0.5E0) AS s0
        FROM ({source})))"""


def _scale(resolution: int) -> list[str]:
    """Axial coordinates for a degree: of longitude along q, of latitude against q, of latitude along r."""
    edge = 0.9204 / sqrt(3) * sqrt(7) ** (8 - resolution)
    east, north = 111.32 * cos(radians(47.0)), 110.57
    return [_float(v) for v in (east * sqrt(3) / 3 / edge, north / 3 / edge, north * 2 / 3 / edge)]


def _point(lat: str, lon: str, resolution: int) -> str:
    qx, qy, ry = _scale(resolution)
    return f"{lon} * {qx} - {lat} * {qy} AS qf, {lat} * {ry} AS rf"


def _hex(resolution: int, q: str = "q", r: str = "r") -> str:
    return f"concat('h{resolution}_', {q}, '_', {r})"


def _path(resolution: int, source: str) -> str:
    """(id, flight_id, event_time, dof, k, q, r): the cells of each leg of ``source``.

    A start more than half the globe away is taken from the other side of the 180th meridian, and cells whose
    centre lies beyond that are those that hold the centre on the near side; the last cell is the start's own.
    """
    keep = "id, flight_id, event_time, dof"
    qx, qy, ry = _scale(resolution)
    ends = (
        f"{source} WHERE longitude IS NOT NULL AND latitude IS NOT NULL AND prev_longitude IS NOT NULL"
        " AND prev_latitude IS NOT NULL"
    )
    here = _cell(f"SELECT *, {_point('latitude', 'longitude', resolution)} FROM {ends}", f"{keep}, longitude, prev_latitude, prev_longitude")
    own = _cell(
        f"SELECT *, {_point('prev_latitude', 'prev_longitude', resolution)} FROM (SELECT {keep}, longitude, prev_latitude,"
        f" prev_longitude, q AS aq, r AS ar FROM ({here}))",
        f"{keep}, longitude, prev_latitude, prev_longitude, aq, ar",
    )
    by = "CASE WHEN longitude - prev_longitude > 180 THEN 360.0E0 WHEN longitude - prev_longitude < -180 THEN -360.0E0 ELSE 0.0E0 END"
    there = _cell(
        f"SELECT *, {_point('prev_latitude', '(prev_longitude + by_)', resolution)} FROM (SELECT {keep}, prev_latitude,"
        f" prev_longitude, aq, ar, q AS tq, r AS tr, {by} AS by_ FROM ({own}))",
        f"{keep}, aq, ar, tq, tr, by_",
    )
    hops = f"SELECT *, CAST((abs(q - aq) + abs(r - ar) + abs(q - aq + r - ar)) / 2 AS BIGINT) AS hops FROM ({there})"
    steps = f"SELECT *, unnest(range(0, hops + 1)) AS k FROM ({hops})"
    line = (
        f"SELECT {keep}, k, hops, aq, ar, tq, tr, by_, aq + (q - aq) * (CAST(k AS DOUBLE) / greatest(hops, 1)) + 1e-6 AS qf,"
        f" ar + (r - ar) * (CAST(k AS DOUBLE) / greatest(hops, 1)) + 2e-6 AS rf FROM ({steps})"
    )
    straight = _cell(line, f"{keep}, k, hops, aq, ar, tq, tr, by_")
    centre = f"SELECT *, r / {ry} AS clat, (q + r / {ry} * {qy}) / {qx} AS clon FROM ({straight}) WHERE by_ <> 0"
    near = "CASE WHEN clon > 180 THEN clon - 360.0E0 WHEN clon < -180 THEN clon + 360.0E0 END"
    back = _cell(
        f"SELECT * RENAME (q AS sq, r AS sr), {_point('clat', 'near_', resolution)} FROM (SELECT *, {near} AS near_ FROM ({centre}))",
        f"{keep}, k, hops, aq, ar, tq, tr, sq, sr, near_",
    )

    def crossing(first, own_, far, straight_):
        return f"CASE WHEN k = 0 THEN {first} WHEN k = hops THEN {own_} WHEN near_ IS NULL THEN {straight_} ELSE {far} END"

    return (
        f"SELECT {keep}, k, q, r FROM ({straight}) WHERE by_ = 0 UNION ALL SELECT {keep}, k,"
        f" {crossing('aq', 'tq', 'q', 'sq')}, {crossing('ar', 'tr', 'r', 'sr')} FROM ({back})"
    )


def _points(source: str, low: bool = True) -> str:
    """Interpolated points of the legs of ``source``."""
    altitude = "prev_altitude <= 3000 AND altitude <= 3000"
    return f"""
    SELECT *, prev_latitude + (latitude - prev_latitude) * n / steps AS lat,
      prev_longitude + (longitude - prev_longitude) * n / steps AS lon,
      prev_altitude + (altitude - prev_altitude) * n / steps AS alt,
      prev_event_time + to_seconds((2 * date_diff('second', prev_event_time, event_time) * n + steps) // (2 * steps)) AS ts
    FROM (SELECT *, unnest(range(0, steps)) AS n
      FROM ({source}) WHERE steps > 0 AND {altitude if low else 'TRUE'})"""


# The square of half the chord; an unknown coordinate makes it NULL, and the CASE keeps it so.
_CHORD = (
    "(power(sin((radians({lat2}) - radians({lat1})) / 2), 2)"
    " + power(sin((radians({lon2}) - radians({lon1})) / 2), 2) * cos(radians({lat1})) * cos(radians({lat2})))"
)
_DISTANCE = f"6371 * 2 * asin(sqrt(CASE WHEN {_CHORD} > 1.0E0 THEN 1.0E0 ELSE {_CHORD} END))"


def _km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return _DISTANCE.format(lat1=lat1, lon1=lon1, lat2=lat2, lon2=lon2)


# Events on the ground.
_SURFACE = (
    "('entry-parking_position', 'entry-runway', 'entry-taxiway', 'exit-parking_position', 'exit-runway', 'exit-taxiway')"
)
_LOADED, _RELOADED = "TIMESTAMP '2024-01-01'", "TIMESTAMP '2024-01-11'"
_AIRPORT_VALUES = "id, icao_code, type, iso_country, airport, latitude, longitude, elevation, municipality"
_STAGE_AIRPORTS = (
    "SELECT id, ident AS icao_code, type, iso_country, name AS airport, latitude_deg AS latitude,"
    " longitude_deg AS longitude, elevation_ft AS elevation, municipality FROM {source}"
    f" WHERE continent = 'EU' AND type IN {_list(staging.AIRPORT_TYPES)}"
)


def _version(start: str) -> str:
    return (
        f"md5(concat(id, '|', CAST({start} AS VARCHAR))) AS dbt_scd_id, {start} AS dbt_updated_at,"
        f" {start} AS dbt_valid_from"
    )


_SAME_AIRPORT = (
    "o.icao_code = n.icao_code AND o.type = n.type AND o.airport = n.airport AND o.latitude = n.latitude"
    " AND o.longitude = n.longitude AND o.elevation = n.elevation"
    " AND o.municipality IS NOT DISTINCT FROM n.municipality AND o.iso_country = n.iso_country"
)


def _next_snapshot(close_missing: bool) -> str:
    gone = f"n.id IS NULL AND {close_missing}"
    return f"""
    SELECT o.*, CASE WHEN ({gone}) OR (n.id IS NOT NULL AND NOT ({_SAME_AIRPORT})) THEN {_RELOADED} END AS dbt_valid_to
    FROM (SELECT * EXCLUDE (dbt_valid_to) FROM scd_airports) o LEFT JOIN next_airports n ON o.id = n.id
    UNION ALL
    SELECT n.*, md5(concat(n.id, '|', CAST({_RELOADED} AS VARCHAR))), {_RELOADED}, {_RELOADED}, CAST(NULL AS TIMESTAMP)
    FROM next_airports n LEFT JOIN stg_airports o ON o.id = n.id WHERE o.id IS NULL OR NOT ({_SAME_AIRPORT})"""


def _dated(events: str) -> str:
    """Events with the time, position and altitude of the one before in the flight."""
    before = ", ".join(
        f"lag({c}) OVER (PARTITION BY flight_id ORDER BY event_time, id) AS prev_{c}"
        for c in ("event_time", "longitude", "latitude", "altitude")
    )
    return f"SELECT id, flight_id, type, event_time, longitude, latitude, altitude, dof, {before} FROM {events}"


def _counted(cells: str) -> str:
    """Distinct flights per cell and period of the day of flight."""
    return f"SELECT q, r, CAST((dayofyear(dof) - 1) // 10 AS INT) AS slot, count(DISTINCT flight_id) AS count FROM {cells} GROUP BY ALL"


def _by_slot(counts: str) -> str:
    slots = ", ".join(f"coalesce(max(count) FILTER (slot = {i}), 0) AS s{i}" for i in range(3))
    return f"SELECT q, r, {slots} FROM {counts} GROUP BY q, r"


def _dim_airports(versions: str) -> str:
    return (
        "SELECT a.*, c.code AS country_code, c.name AS country, c.continent"
        f" FROM {versions} a JOIN country_codes c ON a.iso_country = c.code WHERE a.municipality IS NOT NULL"
    )


def _slots(*counts: str) -> str:
    return "[" + ", ".join(counts) + "]"


# The models; each may read those above it.
_MODELS = {
    "stg_flights": "SELECT id, upper(adep) AS adep, upper(ades) AS ades, upper(icao24) AS icao24,"
    " upper(flt_id) AS flt_id, CAST(first_seen AS TIMESTAMP) AS first_seen,"
    " CAST(last_seen AS TIMESTAMP) AS last_seen, CAST(dof AS DATE) AS dof FROM src_flights",
    "fct_flights": "SELECT * FROM stg_flights",
    "stg_events": "SELECT id, flight_id, type, event_time, longitude, latitude, altitude, info FROM src_events",
    "stg_measurements": "SELECT id, event_id, type, value FROM src_measurements",
    "stg_aircrafts": "SELECT upper(icao24) AS icao24, upper(operatoricao) AS operatoricao, country,"
    " upper(registration) AS registration, upper(manufacturericao) AS manufacturericao,"
    " manufacturername AS manufacturer, upper(typecode) AS typecode FROM src_aircrafts",
    "stg_aircraft_types": "SELECT * REPLACE (CAST(replace(EngineCount, 'C', '2') AS INT) AS EngineCount)"
    " FROM src_aircraft_types",
    "stg_airports": _STAGE_AIRPORTS.format(source="src_airports"),
    "int_events": "SELECT e.*, f.dof FROM stg_events e JOIN stg_flights f ON f.id = e.flight_id",
    "int_measurements": "SELECT event_id, max(value) FILTER (type = 'Time Passed (s)') AS time_passed,"
    " max(value) FILTER (type = 'Distance flown (NM)') AS distance_flown FROM stg_measurements GROUP BY event_id",
    "fct_events": "SELECT e.*, m.time_passed, m.distance_flown FROM int_events e"
    " LEFT JOIN int_measurements m ON e.id = m.event_id",
    "int_aircraft_types": "SELECT upper(ManufacturerCode) AS ManufacturerCode, upper(Designator) AS TypeDesignator,"
    " AircraftDescription AS AircraftType, WTC, EngineType, EngineCount FROM stg_aircraft_types"
    " WHERE AircraftDescription IN ('LandPlane')"
    " GROUP BY AircraftDescription, Designator, EngineCount, EngineType, ManufacturerCode, WTC",
    "dim_aircrafts": "SELECT a.icao24, a.operatoricao, a.country, a.registration, a.manufacturericao, a.manufacturer,"
    " t.TypeDesignator AS typedesignator, t.AircraftType AS aircrafttype, t.EngineCount AS enginecount,"
    " t.EngineType AS enginetype, t.WTC AS wtc FROM stg_aircrafts a LEFT JOIN int_aircraft_types t"
    " ON a.manufacturericao = t.ManufacturerCode AND a.typecode = t.TypeDesignator",
    "scd_airports": f"SELECT {_AIRPORT_VALUES}, {_version(_LOADED)}, CAST(NULL AS TIMESTAMP) AS dbt_valid_to"
    " FROM stg_airports",
    "src_airports_2": "SELECT * REPLACE (CASE WHEN id % 3 = 0 THEN elevation_ft + 1 ELSE elevation_ft END AS elevation_ft)"
    " FROM src_airports WHERE id % 10 <> 9",
    "next_airports": _STAGE_AIRPORTS.format(source="src_airports_2"),
    "scd_airports_2": _next_snapshot(False),
    "dim_airports": _dim_airports("scd_airports"),
    "dim_airports_2": _dim_airports("scd_airports_2"),
    "dim_customers": "SELECT s.id, s.first_name, s.last_name, c.name AS country_name, s.last_updated_dt,"
    " s.dbt_valid_from, s.dbt_valid_to FROM stg_customers s LEFT JOIN country_codes c ON s.country_code = c.code",
    "payment_methods_agg": "SELECT order_id, string_agg(payment_method, ', ' ORDER BY payment_method)"
    " AS payment_methods, sum(amount) AS amount FROM stg_payments GROUP BY order_id",
    "fact_orders": "SELECT o.id, o.user_id, o.order_date, o.status, p.payment_methods, p.amount"
    " FROM stg_orders o LEFT JOIN payment_methods_agg p ON o.id = p.order_id",
    "agg_orders": "SELECT order_date, status, sum(amount) AS total_amount FROM fact_orders GROUP BY order_date, status",
    "events_dated": _dated("int_events"),
    "view_events_lagged": "SELECT * EXCLUDE (dof) FROM events_dated",
    "filtered_dated": f"SELECT * FROM events_dated WHERE type NOT IN {_SURFACE}",
    "view_events_filtered": "SELECT * EXCLUDE (dof) FROM filtered_dated",
    "measured": "SELECT *, CAST(ceil(distance_km / 0.9204) AS BIGINT) AS steps FROM (SELECT *, "
    + _km("prev_latitude", "prev_longitude", "latitude", "longitude")
    + " AS distance_km FROM view_events_lagged)",
    "view_interpolated_steps": "SELECT id, flight_id, type, event_time, longitude, latitude, altitude, distance_km, steps"
    f" FROM ({_points('SELECT * FROM measured')})",
    "path_cells": _path(6, "filtered_dated"),
    "path_cells_8": _path(8, "filtered_dated"),
    "by_period": _counted("path_cells"),
    "by_hex": _by_slot("by_period"),
    "moved_events": "SELECT * REPLACE (CASE WHEN dof BETWEEN DATE '2024-01-08' AND DATE '2024-01-14' THEN longitude + 0.25E0"
    " ELSE longitude END AS longitude) FROM int_events",
    "moved_dated": _dated("moved_events"),
    "moved_filtered": f"SELECT * FROM moved_dated WHERE type NOT IN {_SURFACE}",
    "moved_cells": _path(6, "moved_filtered"),
    "moved_period": _counted("moved_cells"),
    "moved_hex": _by_slot("moved_period"),
    "meridian_events": "SELECT * REPLACE (CASE WHEN longitude + 174.5E0 > 180 THEN longitude + 174.5E0 - 360.0E0"
    " ELSE longitude + 174.5E0 END AS longitude) FROM int_events",
    "meridian_dated": _dated("meridian_events"),
    "meridian_filtered": f"SELECT * FROM meridian_dated WHERE type NOT IN {_SURFACE}",
    "meridian_cells": _path(6, "meridian_filtered"),
    "so_far": "SELECT q, r, count(DISTINCT flight_id) FILTER (dof < DATE '2024-01-11') AS u0,"
    " count(DISTINCT flight_id) FILTER (dof < DATE '2024-01-21') AS u1, count(DISTINCT flight_id) AS u2"
    " FROM path_cells GROUP BY q, r",
    "agg_yearly_metric_array": f"SELECT {_hex(6)} AS hex, DATE '2024-01-01' AS year_start, {_slots('s0', 's1', 's2')}"
    " AS metric_array FROM by_hex",
    "sum_yearly_metric_array": "SELECT hex, CAST(list_sum(metric_array) AS BIGINT) AS count FROM agg_yearly_metric_array",
    "airport_pairs": "SELECT adep, ades, count(adep) AS count FROM stg_flights"
    " WHERE adep IS NOT NULL AND ades IS NOT NULL GROUP BY adep, ades",
    "flight_connections": "SELECT p.*, d1.latitude AS adep_lat, d1.longitude AS adep_lon, d2.latitude AS ades_lat,"
    " d2.longitude AS ades_lon, d1.airport AS adep_airport, d2.airport AS ades_airport, d1.country AS adep_country,"
    " d2.country AS ades_country, d1.municipality AS adep_mun, d2.municipality AS ades_mun, d1.type AS adep_type,"
    " d2.type AS ades_type FROM airport_pairs p"
    " JOIN dim_airports d1 ON p.adep = d1.icao_code AND d1.dbt_valid_to IS NULL"
    " JOIN dim_airports d2 ON p.ades = d2.icao_code AND d2.dbt_valid_to IS NULL WHERE count > 10",
    "busiest_top10": "SELECT icao24, count(id) AS flight_count FROM stg_flights"
    " WHERE dof BETWEEN DATE '2024-01-01' AND DATE '2024-02-01' AND adep IS NOT NULL AND ades IS NOT NULL"
    " GROUP BY icao24 ORDER BY flight_count DESC, icao24 LIMIT 10",
    "busiest_aircraft": "SELECT f.icao24, f.adep, f.ades, f.dof, e.type, e.event_time, e.longitude, e.latitude, e.altitude,"
    " e.time_passed, e.distance_flown, e.id FROM fct_events e JOIN stg_flights f ON e.flight_id = f.id"
    " WHERE e.flight_id IN (SELECT id FROM stg_flights WHERE icao24 IN (SELECT icao24 FROM busiest_top10)"
    " AND adep IS NOT NULL AND ades IS NOT NULL)",
    "heat_top": "SELECT * FROM sum_yearly_metric_array ORDER BY count DESC, hex LIMIT 80000",
    "chosen_points": "SELECT * FROM busiest_aircraft WHERE dof BETWEEN DATE '2024-01-01' AND DATE '2024-01-10'"
    " AND altitude IS NOT NULL",
}


def _breaks(source: str, column: str, fractions) -> str:
    """(position, value) of the range breaks."""
    rows = " UNION ALL ".join(
        f"SELECT CAST({i} AS INT) AS position, CAST(trunc(lo + (hi - lo) * {_float(float(f))}) AS BIGINT) AS value FROM ends"
        for i, f in enumerate(fractions)
    )
    return f"WITH ends AS (SELECT min({column}) AS lo, max({column}) AS hi FROM {source}) {rows}"


def _bucket(source: str, column: str, fractions) -> str:
    flags = " + ".join(
        f"CAST({column} >= trunc(lo + (hi - lo) * {_float(float(f))}) AS INT)" for f in fractions
    )
    return (
        f"SELECT *, CAST({flags} AS INT) AS bucket FROM {source},"
        f" (SELECT min({column}) AS lo, max({column}) AS hi FROM {source})"
    )


def _decimals(name: str, order: str = "event_time, id") -> str:
    return _text(f"list(CAST({name} AS DECIMAL(18, 6)) ORDER BY {order})")


def _paths(extra: str = "") -> str:
    keys = "icao24, CAST(dof AS VARCHAR) AS dof, adep, ades" + (f", {extra} AS segment" if extra else "")
    lists = ", ".join(f"{_decimals(c)} AS {c}" for c in ("longitude", "latitude", "time_passed"))
    whole = ", ".join(f"{_text(f'list({c} ORDER BY event_time, id)')} AS {c}" for c in ("altitude", "bucket"))
    pair = "concat(CAST(longitude AS DECIMAL(18, 6)), ' ', CAST(latitude AS DECIMAL(18, 6)))"
    bucketed = _bucket("chosen_points", "altitude", ranges.ALTITUDE_FRACTIONS)
    group = "icao24, chosen.dof, adep, ades" + (f", {extra}" if extra else "")
    return (
        f"SELECT {keys}, {lists}, {whole}, {_text(f'list({pair} ORDER BY event_time, id)')} AS coordinates"
        f" FROM ({bucketed}) chosen GROUP BY {group}"
    )


def _gates() -> str:
    selects = []
    for source, columns in schemas.GATED_COLUMNS.items():
        for column in columns:
            selects.append(
                f"SELECT '{source}' AS source, '{column}_is_not_null_check' AS check_name,"
                f" count(*) FILTER ({column} IS NULL) = 0 AS passed FROM src_{source}"
            )
        selects.append(f"SELECT '{source}', 'is_there_data_check', count(*) > 0 FROM src_{source}")
    return " UNION ALL ".join(selects)


def _profile(table: str, columns: list[str], key: str) -> str:
    repeated = f"(SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT {key} FROM {table})) FROM {table})"
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) AS rows, count(*) FILTER ({c} IS NULL) AS missing,"
        f" count(DISTINCT {c}) AS distinct_values, min({c}) AS low, max({c}) AS high, {repeated} AS repeated_keys FROM {table}"
        for c in columns
    )


def _failures(model: str, test: dict) -> str:
    columns = test["columns"]
    column = columns[0]
    name = model_tests.label(test)
    counted = f"SELECT '{name}' AS test, count(*) AS failures FROM "
    match test["kind"]:
        case "not_null":
            return counted + f"{model} WHERE {column} IS NULL"
        case "accepted_values":
            return counted + f"{model} WHERE {column} NOT IN {_list(test['values'])}"
        case "between":
            less = "<" if test["strictly"] else "<="
            ends = [f"{test['low']} {less} {column}"] if test["low"] is not None else []
            ends += [f"{column} {less} {test['high']}"] if test["high"] is not None else []
            return counted + f"{model} WHERE NOT ({' AND '.join(ends)})"
        case "type":
            return f"SELECT '{name}' AS test, CAST(0 AS BIGINT) AS failures"
        case "unique":
            known = " AND ".join(f"{c} IS NOT NULL" for c in columns)
            listed = ", ".join(columns)
            return counted + f"(SELECT {listed} FROM {model} WHERE {known} GROUP BY {listed} HAVING count(*) > 1)"
        case "relationships":
            parent, field = test["to"], test["field"]
            return counted + f"{model} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {field} FROM {parent})"
    raise ValueError(test["kind"])


_RAW_FLIGHTS = ["id", "adep", "ades", "icao24", "flt_id", "first_seen", "last_seen", "dof", "version"]
_EVENT_OUT = "id, flight_id, type, event_time, longitude, latitude, altitude, info, CAST(dof AS VARCHAR) AS dof"
_FACT_OUT = _EVENT_OUT + ", time_passed, distance_flown"
_FLIGHT_OUT = "id, adep, ades, icao24, flt_id, first_seen, last_seen, CAST(dof AS VARCHAR) AS dof"
_JAN = "DATE '2024-01-{:02d}'"


def _dof(first: int, last: int) -> str:
    return f"dof BETWEEN {_JAN.format(first)} AND {_JAN.format(last)}"


def _loaded(*counts: str) -> str:
    """The slots up to the last period whose flights have events."""
    return f"list_slice({_slots(*counts)}, 1, (SELECT max((dayofyear(dof) - 1) // 10) + 1 FROM int_events))"


def _arrays(array: str, source: str) -> str:
    return f"SELECT {_hex(6)} AS hex, '2024-01-01' AS year_start, {_text(array)} AS metric_array FROM {source}"


def _airport_hexes(resolution: int) -> str:
    near = f"SELECT *, {_point('lat', 'lon', resolution)} FROM ({_points('SELECT * FROM measured')})"
    near += f" WHERE {_km('lat', 'lon', _float(registry.LAT), _float(registry.LON))} <= 30"
    cells = _cell(near, "flight_id")
    return f"SELECT {_hex(resolution)} AS hex, count(DISTINCT flight_id) AS count FROM ({cells}) GROUP BY q, r"


def _airport_page() -> str:
    return " UNION ALL ".join(
        f"SELECT hex, count, bucket, CAST({r} AS INT) AS resolution FROM"
        f" ({_bucket(f'({_airport_hexes(r)})', 'count', [0.01, 0.05, 0.1, 0.25, 0.4, 0.5, 1])}) WHERE count > 0"
        for r in (6, 7, 8, 9, 10)
    )


def _statements() -> dict[str, str]:
    busiest_out = (
        "icao24, adep, ades, CAST(dof AS VARCHAR) AS dof, type, event_time, longitude, latitude, altitude,"
        " time_passed, distance_flown, id"
    )
    altitudes = "(SELECT * FROM stg_events WHERE altitude IS NOT NULL)"
    statements = {
        "scan_flights": "SELECT * FROM src_flights",
        "stg_flights": f"SELECT {_FLIGHT_OUT} FROM stg_flights",
        "stg_events": "SELECT * FROM stg_events",
        "stg_measurements": "SELECT * FROM stg_measurements",
        "stg_aircrafts": "SELECT * FROM stg_aircrafts",
        "stg_aircraft_types": "SELECT * FROM stg_aircraft_types",
        "stg_airports": "SELECT * FROM stg_airports",
        "int_events": f"SELECT {_EVENT_OUT} FROM int_events",
        "orphan_events": "SELECT * FROM stg_events e WHERE NOT EXISTS"
        " (SELECT 1 FROM stg_flights f WHERE f.id = e.flight_id AND f.adep IS NOT NULL AND f.ades IS NOT NULL)",
        "int_measurements": "SELECT * FROM int_measurements",
        "int_aircraft_types": "SELECT * FROM int_aircraft_types",
        "fct_events": f"SELECT {_FACT_OUT} FROM fct_events",
        "dim_aircrafts": "SELECT * FROM dim_aircrafts",
        "dim_airports": "SELECT * FROM dim_airports",
        "dim_customers": "SELECT * REPLACE (CAST(last_updated_dt AS VARCHAR) AS last_updated_dt,"
        " CAST(dbt_valid_from AS VARCHAR) AS dbt_valid_from, CAST(dbt_valid_to AS VARCHAR) AS dbt_valid_to)"
        " FROM dim_customers",
        "payment_methods_agg": "SELECT * REPLACE (round(amount, 2) AS amount) FROM payment_methods_agg",
        "fact_orders": "SELECT * REPLACE (CAST(order_date AS VARCHAR) AS order_date, round(amount, 2) AS amount)"
        " FROM fact_orders",
        "agg_orders": "SELECT CAST(order_date AS VARCHAR) AS order_date, status, round(total_amount, 2) AS total_amount"
        " FROM agg_orders",
        "events_lagged": "SELECT * FROM view_events_lagged",
        "events_filtered": "SELECT * FROM view_events_filtered",
        "leg_distance": "SELECT id, flight_id, round(distance_km, 6) AS distance_km, steps FROM measured",
        "number_series": f"SELECT n, count(*) AS legs FROM ({_points('SELECT * FROM measured', low=False)}) GROUP BY n",
        "interpolated_steps": "SELECT flight_id, count(*) AS points, count(DISTINCT id) AS legs,"
        " CAST(sum(n) AS BIGINT) AS sum_n, CAST(sum(steps) AS BIGINT) AS sum_steps,"
        + "".join(f" CAST(sum(CAST(floor({c} * 1e6) AS BIGINT)) AS BIGINT) AS sum_{c}," for c in ("lat", "lon", "alt"))
        + " min(ts) AS first_ts, max(ts) AS last_ts, max(round(distance_km, 6)) AS longest_km"
        f" FROM ({_points('SELECT * FROM measured')}) GROUP BY flight_id",
        "interpolated_waypoints": "SELECT id, n, steps, round(distance_km, 6) AS distance_km,"
        + "".join(f" CAST(floor({c} * 1e6) AS BIGINT) AS {c}," for c in ("lat", "lon", "alt"))
        + f" ts FROM ({_points('SELECT * FROM measured')})",
        "hex_cells": f"SELECT id, latitude, longitude, {_hex(6)} AS hex FROM ("
        + _cell(f"SELECT *, {_point('latitude', 'longitude', 6)} FROM stg_events", "id, latitude, longitude")
        + ")",
        "hex_paths": f"SELECT id, flight_id, CAST(count(*) AS INT) AS cells, string_agg({_hex(6)}, ',' ORDER BY k) AS path"
        " FROM path_cells GROUP BY id, flight_id",
        "hex_traffic": f"SELECT {_hex(6)} AS hex, count(DISTINCT flight_id) AS count FROM path_cells GROUP BY q, r",
        "hex_traffic_res8": f"SELECT {_hex(8)} AS hex, count(DISTINCT flight_id) AS count FROM path_cells_8 GROUP BY q, r",
        "airport_hexes": _airport_hexes(8),
        "airport_page": _airport_page(),
        "period_counts": f"SELECT {_hex(6)} AS hex, '2024-01-01' AS year_start, slot, count FROM by_period",
        "metric_array_step": _arrays(_slots("s0", "s1", "s2"), "by_hex"),
        "metric_array_rerun": _arrays(_loaded("coalesce(u1, 0)", "s1", "s2"), "by_hex LEFT JOIN so_far USING (q, r)"),
        "metric_array_append": _arrays(_slots("u0", "u1", "u2"), "so_far"),
        "metric_array_full": _arrays(_loaded("s0", "s1", "s2"), "by_hex"),
        "hex_year_totals": "SELECT * FROM sum_yearly_metric_array",
        "batch_bounds": "SELECT CAST(min(dof) AS VARCHAR) AS lo, CAST(max(dof) AS VARCHAR) AS hi,"
        " CAST(CAST(date_trunc('month', min(dof)) AS DATE) AS VARCHAR) AS month FROM int_events",
        "replace_range": f"SELECT {_EVENT_OUT} FROM int_events WHERE NOT ({_dof(11, 20)}) UNION ALL"
        f" SELECT * REPLACE (altitude + 1 AS altitude) FROM (SELECT {_EVENT_OUT} FROM int_events"
        f" WHERE {_dof(11, 20)} AND day(dof) <> 13)",
        "replace_month": "WITH moved AS (SELECT * REPLACE (CAST(dof + INTERVAL 20 DAY AS DATE) AS dof) FROM stg_flights)"
        f" SELECT {_FLIGHT_OUT} FROM moved WHERE month(dof) = 2 OR day(dof) % 2 = 0",
        "merge_upsert": "WITH known AS (SELECT * FROM stg_flights WHERE adep IS NOT NULL AND ades IS NOT NULL),"
        f" old AS (SELECT adep, ades, count(*) AS flights, min(dof) AS first_day FROM known WHERE {_dof(1, 20)} GROUP BY ALL),"
        f" new AS (SELECT adep, ades, count(*) AS flights, min(dof) AS first_day FROM known WHERE {_dof(11, 31)} GROUP BY ALL)"
        " SELECT adep, ades, coalesce(new.flights, old.flights) AS flights,"
        " CAST(coalesce(old.first_day, new.first_day) AS VARCHAR) AS first_day FROM old FULL JOIN new USING (adep, ades)",
        "scd2_airports": "SELECT * FROM scd_airports_2",
        "scd2_close_missing": _next_snapshot(True),
        "hex_heatmap": "SELECT hex, count, bucket FROM ("
        + _bucket("heat_top", "count", ranges.OVERVIEW_FRACTIONS)
        + ") WHERE count > 0",
        "range_breaks": _breaks(altitudes, "altitude", ranges.ALTITUDE_FRACTIONS),
        "range_buckets": f"SELECT id, altitude, bucket FROM ({_bucket(altitudes, 'altitude', ranges.ALTITUDE_FRACTIONS)})",
        "current_airports": "SELECT airport, icao_code, type, country, elevation, latitude, longitude"
        " FROM dim_airports_2 WHERE dbt_valid_to IS NULL",
        "airport_picker": "SELECT DISTINCT airport FROM dim_airports WHERE country = 'NATION_15'",
        "airport_lookup": "SELECT airport, icao_code, type, country, latitude, longitude FROM dim_airports"
        " WHERE airport = 'Supplier#000000000' ORDER BY id LIMIT 1",
        "hourly_traffic": "SELECT CAST(hour(e.event_time) AS INT) AS hour, count(DISTINCT flight_id) AS count"
        " FROM stg_flights f JOIN int_events e ON f.id = e.flight_id WHERE (f.adep = 'AP0' AND e.type = 'take-off')"
        " OR (f.ades = 'AP0' AND e.type = 'landing') GROUP BY 1",
        "top_aircraft_types": "SELECT enginetype, enginecount, manufacturericao, wtc, typedesignator,"
        " count(DISTINCT f.id) AS count FROM stg_flights f JOIN dim_aircrafts a ON f.icao24 = a.icao24"
        " WHERE (adep = 'AP0' OR ades = 'AP0') AND typedesignator IS NOT NULL GROUP BY 1, 2, 3, 4, 5"
        " ORDER BY count DESC, 1, 2, 3, 4, 5 LIMIT 10",
        "top_operators": "SELECT operatoricao, count(DISTINCT f.id) AS count FROM stg_flights f"
        " JOIN dim_aircrafts a ON f.icao24 = a.icao24 WHERE (adep = 'AP0' OR ades = 'AP0') AND operatoricao <> ''"
        " GROUP BY 1 ORDER BY count DESC, 1 LIMIT 10",
        "airport_pairs": "SELECT * FROM airport_pairs",
        "flight_connections": "SELECT * FROM flight_connections",
        "connections_filtered": "SELECT * FROM flight_connections WHERE count BETWEEN 30 AND 25000"
        " AND adep_type IN ('large_airport', 'medium_airport') AND ades_type IN ('large_airport', 'medium_airport')"
        f" AND adep_country IN {_list(registry.COUNTRIES[5:])} AND ades_country IN {_list(registry.COUNTRIES[:20])}",
        "distinct_countries": "SELECT DISTINCT country FROM dim_airports",
        "busiest_top10": "SELECT * FROM busiest_top10",
        "busiest_aircraft": f"SELECT {busiest_out} FROM busiest_aircraft",
        "default_aircraft": "SELECT icao24 FROM (SELECT icao24, row_number() OVER (ORDER BY icao24) AS position"
        " FROM (SELECT DISTINCT icao24 FROM busiest_aircraft)) WHERE position IN (1, 3, 5)",
        "aircraft_paths": _paths(),
        "aircraft_path_segments": _paths("date_trunc('hour', event_time)"),
        "dq_load_gate": _gates(),
        "dq_not_null": "SELECT id, icao24, CAST(dof AS VARCHAR) AS dof FROM stg_flights WHERE ades IS NULL",
        "dq_unique": "SELECT id, count(*) AS rows FROM stg_payments GROUP BY id HAVING count(*) > 1",
        "dq_accepted_values": f"SELECT id, type FROM stg_events WHERE type NOT IN {_list(model_tests.FLIGHT_EVENTS)}",
        "dq_relationships": "SELECT id, user_id, CAST(order_date AS VARCHAR) AS order_date, status FROM stg_orders"
        " WHERE id NOT IN (SELECT order_id FROM stg_payments)",
        "dq_between": "SELECT id, longitude, altitude FROM stg_events"
        " WHERE longitude >= 5.5E0 AND (altitude <= 100 OR altitude >= 3000)",
        "dq_compound_unique": "SELECT order_id, payment_method, count(*) AS rows FROM stg_payments"
        " GROUP BY ALL HAVING count(*) > 1",
        "profile_flights": _profile("src_flights", _RAW_FLIGHTS, "icao24, dof"),
        "stream_ingest": f"SELECT {_FACT_OUT} FROM fct_events",
        "stream_replace": f"SELECT * REPLACE (CASE WHEN CAST(dof AS DATE) BETWEEN {_JAN.format(11)} AND {_JAN.format(20)}"
        f" THEN altitude + 1 ELSE altitude END AS altitude) FROM (SELECT {_FACT_OUT} FROM fct_events)",
        "stream_backlog": f"SELECT * REPLACE (CASE WHEN CAST(dof AS DATE) BETWEEN {_JAN.format(11)} AND {_JAN.format(20)}"
        f" THEN altitude + 1 ELSE altitude END AS altitude) FROM (SELECT {_FACT_OUT} FROM fct_events)",
        "stream_arrays": _arrays(_loaded("s0", "s1", "s2"), "by_hex"),
        "stream_arrays_corrected": _arrays(_loaded("s0", "s1", "s2"), "moved_hex"),
        "flight_set_counts": f"SELECT {_hex(6)} AS hex, '2024-01-01' AS year_start, slot, count FROM by_period",
        "meridian_paths": f"SELECT id, flight_id, CAST(count(*) AS INT) AS cells, string_agg({_hex(6)}, ',' ORDER BY k) AS path"
        " FROM meridian_cells GROUP BY id, flight_id",
        "meridian_traffic": f"SELECT {_hex(6)} AS hex, count(DISTINCT flight_id) AS count FROM meridian_cells GROUP BY q, r",
        "stored_months": "WITH moved AS (SELECT * REPLACE (CAST(dof + INTERVAL 20 DAY AS DATE) AS dof) FROM stg_flights)"
        f" SELECT {_FLIGHT_OUT} FROM moved WHERE month(dof) = 2 OR day(dof) % 2 = 0",
        "stored_merge": "SELECT adep, count(*) * CASE WHEN day(dof) >= 11 THEN 2 ELSE 1 END AS flights,"
        " min(first_seen) AS earliest, CAST(dof AS VARCHAR) AS dof FROM stg_flights WHERE adep IS NOT NULL GROUP BY adep, dof",
        "monthly_run_flights": f"SELECT {_FLIGHT_OUT} FROM stg_flights",
        # An empty text is a NULL once it has gone through a CSV file.
        "monthly_run_aircrafts": "SELECT * REPLACE (nullif(operatoricao, '') AS operatoricao) FROM dim_aircrafts",
        "period_run_events": f"SELECT {_FACT_OUT} FROM fct_events",
        "period_run_arrays": _arrays(_loaded("s0", "s1", "s2"), "by_hex"),
        "period_run_airports": "SELECT * FROM dim_airports_2",
        "period_run_checks": " UNION ALL ".join(_failures("fct_events", test) for test in model_tests.DECLARED["fct_events"]),
    }
    for model, tests in model_tests.DECLARED.items():
        statements[f"tests_{model}"] = " UNION ALL ".join(_failures(model, test) for test in tests)
    return statements


def _with_models(statement: str) -> str:
    """Put the adapters and models that the statement reads in front of it."""
    known = {**{name: duckdb_view(name) for name in ADAPTERS}, **_MODELS}
    needed: set[str] = set()

    def collect(text):
        for name in set(re.findall(r"\w+", text)) & known.keys() - needed:
            needed.add(name)
            collect(known[name])

    collect(statement)
    views = ", ".join(f"{name} AS ({known[name]})" for name in known if name in needed)
    return f"WITH {views} SELECT * FROM ({statement})"


def oracle_sql() -> dict[str, str]:
    return {name: _with_models(statement) for name, statement in _statements().items()}
