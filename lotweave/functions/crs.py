"""Closed-form coordinate transforms as Column expressions over vertices.

GRS80 and WGS84 are treated as one datum. Only vertices move; segments are not
densified. Formulas: J. P. Snyder, Map Projections - A Working Manual (USGS 1395).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotweave.functions.geometry import let, map_vertices, point

MERCATOR_RADIUS = 6378137.0
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257222101
E2 = FLATTENING * (2 - FLATTENING)
ECC = math.sqrt(E2)
FOOT = 0.3048

# Projection parameters in degrees (EPSG registry).
ALBERS_5070 = {"lat1": 29.5, "lat2": 45.5, "lat0": 23.0, "lon0": -96.0}
LAMBERT_OREGON_NORTH = {"lat1": 46.0, "lat2": 44 + 1 / 3, "lat0": 43 + 2 / 3, "lon0": -120.5, "x0": 2500000.0}
LAMBERT_FEET_SRIDS = (2269, 2913)


def _m(phi: float) -> float:
    return math.cos(phi) / math.sqrt(1 - E2 * math.sin(phi) ** 2)


def _q(phi: float) -> float:
    s = math.sin(phi)
    return (1 - E2) * (s / (1 - E2 * s * s) - math.log((1 - ECC * s) / (1 + ECC * s)) / (2 * ECC))


def _t(phi: float) -> float:
    s = math.sin(phi)
    return math.tan(math.pi / 4 - phi / 2) / ((1 - ECC * s) / (1 + ECC * s)) ** (ECC / 2)


def albers_constants() -> dict[str, float]:
    p = {k: math.radians(v) for k, v in ALBERS_5070.items()}
    m1, m2 = _m(p["lat1"]), _m(p["lat2"])
    q1, q2, q0 = _q(p["lat1"]), _q(p["lat2"]), _q(p["lat0"])
    n = (m1 * m1 - m2 * m2) / (q2 - q1)
    c = m1 * m1 + n * q1
    return {"n": n, "c": c, "rho0": SEMI_MAJOR * math.sqrt(c - n * q0) / n}


def lambert_constants() -> dict[str, float]:
    p = LAMBERT_OREGON_NORTH
    lat1, lat2, lat0 = (math.radians(p[k]) for k in ("lat1", "lat2", "lat0"))
    m1, m2 = _m(lat1), _m(lat2)
    t1, t2, t0 = _t(lat1), _t(lat2), _t(lat0)
    n = (math.log(m1) - math.log(m2)) / (math.log(t1) - math.log(t2))
    f = m1 / (n * t1**n)
    return {"n": n, "f": f, "rho0": SEMI_MAJOR * f * t0**n}


def mercator_to_degrees(v: Column) -> Column:
    lon = v["x"] / MERCATOR_RADIUS * (180 / math.pi)
    lat = (2 * F.atan(F.exp(v["y"] / MERCATOR_RADIUS)) - math.pi / 2) * (180 / math.pi)
    return point(lon, lat)


def degrees_to_mercator(v: Column) -> Column:
    x = v["x"] * (math.pi / 180) * MERCATOR_RADIUS
    y = F.log(F.tan(v["y"] * (math.pi / 360) + math.pi / 4)) * MERCATOR_RADIUS
    return point(x, y)


def degrees_to_albers(v: Column) -> Column:
    k = albers_constants()

    def polar(s):
        q = (1 - E2) * (s / (1 - E2 * s * s) - F.log((1 - ECC * s) / (1 + ECC * s)) / (2 * ECC))
        return F.struct(
            (SEMI_MAJOR * F.sqrt(k["c"] - k["n"] * q) / k["n"]).alias("rho"),
            (k["n"] * (v["x"] - ALBERS_5070["lon0"]) * (math.pi / 180)).alias("theta"),
        )

    return let(
        let(F.sin(v["y"] * (math.pi / 180)), polar),
        lambda p: point(p["rho"] * F.sin(p["theta"]), k["rho0"] - p["rho"] * F.cos(p["theta"])),
    )


def albers_to_degrees(v: Column) -> Column:
    k = albers_constants()
    dy = k["rho0"] - v["y"]
    rho = F.hypot(v["x"], dy)
    theta = F.atan2(v["x"], dy)
    q = (k["c"] - (rho * k["n"] / SEMI_MAJOR) * (rho * k["n"] / SEMI_MAJOR)) / k["n"]
    e4, e6 = E2 * E2, E2 * E2 * E2

    def latitude(beta):
        phi = (
            beta
            + (E2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * F.sin(2 * beta)
            + (23 * e4 / 360 + 251 * e6 / 3780) * F.sin(4 * beta)
            + (761 * e6 / 45360) * F.sin(6 * beta)
        )
        return point(ALBERS_5070["lon0"] + theta / k["n"] * (180 / math.pi), phi * (180 / math.pi))

    return let(F.asin(q / _q(math.pi / 2)), latitude)


def degrees_to_lambert_feet(v: Column) -> Column:
    k, p = lambert_constants(), LAMBERT_OREGON_NORTH
    phi = v["y"] * (math.pi / 180)
    s = F.sin(phi)
    t = F.tan(math.pi / 4 - phi / 2) / F.pow((1 - ECC * s) / (1 + ECC * s), F.lit(ECC / 2))
    rho = SEMI_MAJOR * k["f"] * F.pow(t, F.lit(k["n"]))
    theta = k["n"] * (v["x"] - p["lon0"]) * (math.pi / 180)
    return point((p["x0"] + rho * F.sin(theta)) / FOOT, (k["rho0"] - rho * F.cos(theta)) / FOOT)


def lambert_feet_to_degrees(v: Column) -> Column:
    k, p = lambert_constants(), LAMBERT_OREGON_NORTH
    dx = v["x"] * FOOT - p["x0"]
    dy = k["rho0"] - v["y"] * FOOT
    t = F.pow(F.hypot(dx, dy) / (SEMI_MAJOR * k["f"]), F.lit(1 / k["n"]))
    e4, e6, e8 = E2**2, E2**3, E2**4
    lon = p["lon0"] + F.atan2(dx, dy) / k["n"] * (180 / math.pi)

    def latitude(chi):
        phi = (
            chi
            + (E2 / 2 + 5 * e4 / 24 + e6 / 12 + 13 * e8 / 360) * F.sin(2 * chi)
            + (7 * e4 / 48 + 29 * e6 / 240 + 811 * e8 / 11520) * F.sin(4 * chi)
            + (7 * e6 / 120 + 81 * e8 / 1120) * F.sin(6 * chi)
            + (4279 * e8 / 161280) * F.sin(8 * chi)
        )
        return point(lon, phi * (180 / math.pi))

    return let(math.pi / 2 - 2 * F.atan(t), latitude)


_TO_DEGREES = {3857: mercator_to_degrees, 4326: lambda v: v, 5070: albers_to_degrees}
_FROM_DEGREES = {3857: degrees_to_mercator, 4326: lambda v: v, 5070: degrees_to_albers}
for _srid in LAMBERT_FEET_SRIDS:
    _TO_DEGREES[_srid] = lambert_feet_to_degrees
    _FROM_DEGREES[_srid] = degrees_to_lambert_feet


def reproject_point(v: Column, source: int, target: int) -> Column:
    if source == target:
        return v
    for srid in (source, target):
        if srid not in _TO_DEGREES:
            raise ValueError(f"unsupported SRID {srid}; known: {sorted(_TO_DEGREES)}")
    if 4326 in (source, target):
        return let(v, _TO_DEGREES[source] if target == 4326 else _FROM_DEGREES[target])
    return let(let(v, _TO_DEGREES[source]), _FROM_DEGREES[target])


def reproject(geom: Column, source: int, target: int) -> Column:
    """Move every vertex from one reference system to another."""
    if source == target:
        return geom
    reproject_point(point(F.lit(0.0), F.lit(0.0)), source, target)  # rejects unknown SRIDs now
    return map_vertices(geom, lambda v: reproject_point(v, source, target))
