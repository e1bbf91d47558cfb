"""Great-circle distance and a planar hexagonal grid.

The grid lies on equirectangular kilometres around one reference latitude, so a cell is found with
``+ - * / floor abs`` alone. Cells are addressed by axial coordinates (q, r). They are not H3 cells:
the widths match, the ids do not, and east-west widths drift away from the reference latitude.
"""

from __future__ import annotations

from math import cos, radians, sqrt

from pyspark.sql import Column, functions as F

from contrail.functions.arrays import let

# Fixed values.
EARTH_RADIUS_KM = 6371
STEP_KM = 0.9204  # width of a resolution-8 cell
KM_PER_DEGREE_LON = 111.32  # at the equator
KM_PER_DEGREE_LAT = 110.57
REFERENCE_LATITUDE = 47.0
DEFAULT_RESOLUTION = 6

# Moves a path off cell edges, where rounding could go either way.
NUDGE_Q = 1e-6
NUDGE_R = 2e-6


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.sin((F.radians(lat2) - F.radians(lat1)) / 2)
    half_lon = F.sin((F.radians(lon2) - F.radians(lon1)) / 2)
    chord = half_lat * half_lat + half_lon * half_lon * F.cos(F.radians(lat1)) * F.cos(F.radians(lat2))
    # Rounding may push antipodal points just above 1, where asin has no value. An unknown coordinate must
    # stay unknown, which F.least would hide.
    known = lat1.isNotNull() & lon1.isNotNull() & lat2.isNotNull() & lon2.isNotNull()
    return F.when(known, F.asin(F.sqrt(F.least(F.lit(1.0), chord))) * (2 * EARTH_RADIUS_KM))


def step_count(distance_km: Column, step_km: float = STEP_KM) -> Column:
    return F.ceil(distance_km / F.lit(step_km))


def cell_edge_km(resolution: int) -> float:
    """Edge length; one resolution step changes it by the square root of seven."""
    return STEP_KM / sqrt(3) * sqrt(7) ** (8 - resolution)


def axial_scale(resolution: int) -> tuple[float, float, float]:
    """Factors (qx, qy, ry) with q = lon * qx - lat * qy and r = lat * ry."""
    edge = cell_edge_km(resolution)
    km_lon = KM_PER_DEGREE_LON * cos(radians(REFERENCE_LATITUDE))
    return km_lon * sqrt(3) / 3 / edge, KM_PER_DEGREE_LAT / 3 / edge, KM_PER_DEGREE_LAT * 2 / 3 / edge


def nearest_cell(qf: Column, rf: Column) -> Column:
    """Round fractional axial coordinates to the cell struct<q, r>.

    Of the three cube coordinates the one with the largest rounding error follows from the others.
    """
    sf = -qf - rf
    q, r, s = (F.floor(v + 0.5) for v in (qf, rf, sf))
    q_off, r_off, s_off = F.abs(q - qf), F.abs(r - rf), F.abs(s - sf)
    q_worst = (q_off > r_off) & (q_off > s_off)
    r_worst = ~q_worst & (r_off > s_off)
    return F.struct(
        F.when(q_worst, -r - s).otherwise(q).alias("q"),
        F.when(r_worst, -q - s).otherwise(r).alias("r"),
    )


def nearest_cells(points: Column) -> Column:
    """``nearest_cell`` of each struct<qf, rf> of an array; NULL for NULL.

    One pass for each layer of values that several others need, as ``let`` explains.
    """
    third = F.transform(points, lambda p: F.struct(p["qf"], p["rf"], (-p["qf"] - p["rf"]).alias("sf")))
    whole = F.transform(third, lambda p: F.struct(p["qf"], p["rf"], p["sf"], *(F.floor(p[f"{v}f"] + 0.5).alias(v) for v in "qrs")))
    off = F.transform(
        whole, lambda p: F.struct(p["q"], p["r"], p["s"], *(F.abs(p[v] - p[f"{v}f"]).alias(f"{v}_off") for v in "qrs"))
    )

    def cell(p: Column) -> Column:
        q, r, s = p["q"], p["r"], p["s"]
        q_worst = (p["q_off"] > p["r_off"]) & (p["q_off"] > p["s_off"])
        by_r = F.when(p["r_off"] > p["s_off"], F.struct(q.alias("q"), (-q - s).alias("r")))
        plain = by_r.otherwise(F.struct(q.alias("q"), r.alias("r")))
        return F.when(q.isNotNull(), F.when(q_worst, F.struct((-r - s).alias("q"), r.alias("r"))).otherwise(plain))

    return F.transform(off, cell)


def on_earth(lat: Column, lon: Column) -> Column:
    """Coordinates a cell exists for; this also bounds the length of every path."""
    return lat.between(-90.0, 90.0) & lon.between(-180.0, 180.0)


def hex_cell(lat: Column, lon: Column, resolution: int = DEFAULT_RESOLUTION) -> Column:
    """Cell struct<q, r> of a point; NULL off the globe."""
    qx, qy, ry = axial_scale(resolution)
    return F.when(on_earth(lat, lon), nearest_cell(lon * F.lit(qx) - lat * F.lit(qy), lat * F.lit(ry)))


def hex_id(cell: Column, resolution: int = DEFAULT_RESOLUTION) -> Column:
    """Readable cell id: resolution, q and r."""
    return F.concat_ws("_", F.lit(f"h{resolution}"), cell["q"].cast("string"), cell["r"].cast("string"))


def hex_distance(a: Column, b: Column) -> Column:
    """Cells to cross from ``a`` to ``b``."""
    dq, dr = b["q"] - a["q"], b["r"] - a["r"]
    return F.floor((F.abs(dq) + F.abs(dr) + F.abs(dq + dr)) / 2)


def path_cell(a: Column, b: Column, hops: Column, k: Column) -> Column:
    """The k-th of the ``hops`` + 1 cells on the straight line from ``a`` to ``b``."""
    part = k / F.greatest(hops, F.lit(1))
    return nearest_cell(
        a["q"] + (b["q"] - a["q"]) * part + NUDGE_Q,
        a["r"] + (b["r"] - a["r"]) * part + NUDGE_R,
    )


def turn(lon: Column, prev_lon: Column) -> Column:
    """What to add to ``prev_lon`` so that the way to ``lon`` is the short one, which may cross the 180th meridian."""
    ahead = lon - prev_lon
    return F.when(ahead > 180, 360.0).when(ahead < -180, -360.0).otherwise(0.0)


def turned_cell(lat: Column, lon: Column, by: Column, resolution: int = DEFAULT_RESOLUTION) -> Column:
    """Cell of a point on the plane continued beyond the 180th meridian; NULL off the globe."""
    qx, qy, ry = axial_scale(resolution)
    return F.when(on_earth(lat, lon), nearest_cell((lon + by) * F.lit(qx) - lat * F.lit(qy), lat * F.lit(ry)))


def centre(q: Column, r: Column, resolution: int = DEFAULT_RESOLUTION) -> tuple[Column, Column]:
    """Latitude and longitude of a cell's centre; the longitude may lie beyond the 180th meridian."""
    qx, qy, ry = axial_scale(resolution)
    lat = r / F.lit(ry)
    return lat, (q + lat * F.lit(qy)) / F.lit(qx)


def near_side(lon: Column) -> Column:
    """A longitude beyond the 180th meridian as one on the globe; NULL for any other."""
    return F.when(lon > 180, lon - 360.0).when(lon < -180, lon + 360.0)


def leg_ends(lat: Column, lon: Column, prev_lat: Column, prev_lon: Column, resolution: int) -> dict[str, Column]:
    """``here`` and ``there``, the cells of a leg's ends, ``turned``, that of its start as seen from its end, and ``by``."""
    by = turn(lon, prev_lon)
    return {
        "here": hex_cell(lat, lon, resolution),
        "there": hex_cell(prev_lat, prev_lon, resolution),
        "turned": turned_cell(prev_lat, prev_lon, by, resolution),
        "by": by,
    }


def hex_path(a: Column, b: Column) -> Column:
    """All cells from ``a`` to ``b``, both included, as an array; NULL when an end is NULL.

    The same cells as ``path_cell`` of each hop.
    """
    ahead = (b["q"] - a["q"]).alias("dq"), (b["r"] - a["r"]).alias("dr")
    line = F.struct(a["q"].alias("q"), a["r"].alias("r"), *ahead, hex_distance(a, b).alias("hops"))

    def cells(line: Column) -> Column:
        def point(k: Column) -> Column:
            part = k / F.greatest(line["hops"], F.lit(1))
            return F.struct(
                (line["q"] + line["dq"] * part + NUDGE_Q).alias("qf"), (line["r"] + line["dr"] * part + NUDGE_R).alias("rf")
            )

        return nearest_cells(F.transform(F.sequence(F.lit(0).cast("bigint"), line["hops"]), point))

    return F.when(a.isNotNull() & b.isNotNull(), let(line, cells))


def leg_path(ends: dict[str, Column], resolution: int = DEFAULT_RESOLUTION) -> Column:
    """All cells of a leg from its end back to its start as an array; NULL when an end is NULL.

    A leg across the 180th meridian goes to ``turned``, and its cells are brought back to the ones that hold their
    centres; both ends stay the cells that they are.
    """
    qx, qy, ry = axial_scale(resolution)

    def brought_back(cells: Column) -> Column:
        centres = F.transform(F.transform(cells, lambda c: F.struct(c["q"].alias("q"), (c["r"] / F.lit(ry)).alias("lat"))), beyond)
        back = nearest_cells(F.transform(centres, near))
        inner = F.zip_with(cells, back, lambda cell, held: F.coalesce(held, cell))
        # A path across the meridian may still have one cell only, as both ends do then.
        middle = F.slice(inner, 2, F.greatest(F.size(inner) - 2, F.lit(0)))
        last = F.when(F.size(inner) > 1, F.array(ends["there"])).otherwise(F.slice(inner, 1, 0))
        return F.concat(F.array(ends["here"]), middle, last)

    def beyond(c: Column) -> Column:
        return F.struct(c["lat"].alias("lat"), near_side((c["q"] + c["lat"] * F.lit(qy)) / F.lit(qx)).alias("lon"))

    def near(c: Column) -> Column:
        point = F.struct((c["lon"] * F.lit(qx) - c["lat"] * F.lit(qy)).alias("qf"), (c["lat"] * F.lit(ry)).alias("rf"))
        return F.when(on_earth(c["lat"], c["lon"]), point)

    cells = hex_path(ends["here"], ends["turned"])
    known = ends["here"].isNotNull() & ends["turned"].isNotNull()
    return F.when(ends["by"] == 0, cells).otherwise(F.when(known, let(cells, brought_back)))
