"""Coordinate systems and geometry as column arithmetic. Points are pairs of Columns or struct(lng, lat)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The published constants of the two conversions.
AXIS, FLATNESS = 6378245.0, 0.00669342162296594323
TURN = math.pi * 3000.0 / 180.0
BD_LNG, BD_LAT = 0.0065, 0.006
CHINA = (73.66, 135.05, 3.86, 53.55)
EARTH_M = 6370996.81
#: Degrees of longitude and latitude that an edge of one kilometre takes.
LNG_KM, LAT_KM = 0.01167, 0.009009009


def _point(lng: Column, lat: Column) -> Column:
    return F.struct(lng.alias("lng"), lat.alias("lat"))


def gcj02_to_bd09(lng: Column, lat: Column) -> Column:
    z = F.sqrt(lng * lng + lat * lat) + 0.00002 * F.sin(lat * TURN)
    t = F.atan2(lat, lng) + 0.000003 * F.cos(lng * TURN)
    return _point(z * F.cos(t) + BD_LNG, z * F.sin(t) + BD_LAT)


def bd09_to_gcj02(lng: Column, lat: Column) -> Column:
    x, y = lng - BD_LNG, lat - BD_LAT
    z = F.sqrt(x * x + y * y) - 0.00002 * F.sin(y * TURN)
    t = F.atan2(y, x) - 0.000003 * F.cos(x * TURN)
    return _point(z * F.cos(t), z * F.sin(t))


def outside_china(lng: Column, lat: Column) -> Column:
    w, e, s, n = CHINA
    return ~((lng > w) & (lng < e) & (lat > s) & (lat < n))


def _waves(v: Column, terms: tuple) -> Column:
    return sum((a * F.sin(v * (math.pi * f)) for a, f in terms), F.lit(0.0)) * 2.0 / 3.0


# The published coefficients of the offset (amplitude and frequency of each wave; terms of the polynomials).
def _offset(lng: Column, lat: Column) -> tuple[Column, Column]:
    x, y = lng - 105.0, lat - 35.0
    fast = _waves(x, ((20.0, 6.0), (20.0, 2.0)))
    north = -100.0 + 2.0 * x + 3.0 * y + 0.2 * y * y + 0.1 * x * y + 0.2 * F.sqrt(F.abs(x)) + fast + _waves(y, ((20.0, 1.0), (40.0, 1 / 3))) + _waves(y, ((160.0, 1 / 12), (320.0, 1 / 30)))
    east = 300.0 + x + 2.0 * y + 0.1 * x * x + 0.1 * x * y + 0.1 * F.sqrt(F.abs(x)) + fast + _waves(x, ((20.0, 1.0), (40.0, 1 / 3))) + _waves(x, ((150.0, 1 / 12), (300.0, 1 / 30)))
    angle = F.radians(lat)
    bend = 1 - FLATNESS * F.sin(angle) * F.sin(angle)
    return east * 180.0 / (AXIS / F.sqrt(bend) * F.cos(angle) * math.pi), north * 180.0 / (AXIS * (1 - FLATNESS) / (bend * F.sqrt(bend)) * math.pi)


def wgs84_to_gcj02(lng: Column, lat: Column) -> Column:
    """Unchanged outside China."""
    east, north = _offset(lng, lat)
    out = outside_china(lng, lat)
    return _point(F.when(out, lng).otherwise(lng + east), F.when(out, lat).otherwise(lat + north))


def gcj02_to_wgs84(lng: Column, lat: Column) -> Column:
    """One-step inverse (approximate)."""
    east, north = _offset(lng, lat)
    out = outside_china(lng, lat)
    return _point(F.when(out, lng).otherwise(lng - east), F.when(out, lat).otherwise(lat - north))


def bd09_to_wgs84(lng: Column, lat: Column) -> Column:
    p = bd09_to_gcj02(lng, lat)
    return gcj02_to_wgs84(p["lng"], p["lat"])


def wgs84_to_bd09(lng: Column, lat: Column) -> Column:
    p = wgs84_to_gcj02(lng, lat)
    return gcj02_to_bd09(p["lng"], p["lat"])


def square_around(x: Column, y: Column, edge: float) -> Column:
    """Box of an edge in kilometres around a center."""
    dx, dy = 0.5 * LNG_KM * edge, 0.5 * LAT_KM * edge
    return F.struct((x - dx).alias("lng_min"), (y - dy).alias("lat_min"), (x + dx).alias("lng_max"), (y + dy).alias("lat_max"))


def traffic_square(x: Column, y: Column) -> Column:
    """The fixed box of the traffic requests."""
    dx, dy = 0.0292768, 0.027027027  # fixed values
    return F.struct((x - dx).alias("lng_min"), (y - dy).alias("lat_min"), (x + dx).alias("lng_max"), (y + dy).alias("lat_max"))


def rounded_bounds(x: Column, y: Column, edge: float) -> Column:
    """lat_min,lng_min,lat_max,lng_max at three decimals; null unless all are positive."""
    b = square_around(x, y, edge)
    names = ("lat_min", "lng_min", "lat_max", "lng_max")
    return F.when(F.least(*(b[n] for n in names)) > 0, F.format_string("%.3f,%.3f,%.3f,%.3f", *(b[n] for n in names)))


def distance_m(a: Column, b: Column) -> Column:
    """Great circle by arc cosine; longitudes wrapped to half turns, latitudes held within 74 degrees."""
    wrap = lambda v: F.pmod(v + 180.0, F.lit(360.0)) - 180.0
    hold = lambda v: F.least(F.greatest(v, F.lit(-74.0)), F.lit(74.0))
    la, lb = F.radians(hold(a["lat"])), F.radians(hold(b["lat"]))
    turn = F.radians(wrap(b["lng"]) - wrap(a["lng"]))
    cosine = F.sin(la) * F.sin(lb) + F.cos(la) * F.cos(lb) * F.cos(turn)
    return EARTH_M * F.acos(F.least(F.greatest(cosine, F.lit(-1.0)), F.lit(1.0)))


def polyline_length_m(points: Column) -> Column:
    """Sum over neighbouring points; fewer than two give 0."""
    n = F.size(points)
    pairs = F.zip_with(F.slice(points, 1, F.greatest(n - 1, F.lit(0))), F.slice(points, 2, F.greatest(n - 1, F.lit(0))), distance_m)
    return F.when(n >= 2, F.aggregate(pairs, F.lit(0.0), lambda s, d: s + d)).otherwise(0.0)


def in_circle(p: Column, center: Column, radius: Column) -> Column:
    return distance_m(p, center) <= radius


def on_polyline(p: Column, points: Column, tolerance: float = 2e-10) -> Column:
    """Whether a point lies on some segment."""
    n = F.greatest(F.size(points) - 1, F.lit(0))
    ends = F.zip_with(F.slice(points, 1, n), F.slice(points, 2, n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    def on(e: Column) -> Column:
        a, b = e["a"], e["b"]
        cross = (b["lng"] - a["lng"]) * (p["lat"] - a["lat"]) - (p["lng"] - a["lng"]) * (b["lat"] - a["lat"])
        return (F.abs(cross) < tolerance) & p["lng"].between(F.least(a["lng"], b["lng"]), F.greatest(a["lng"], b["lng"])) & p["lat"].between(F.least(a["lat"], b["lat"]), F.greatest(a["lat"], b["lat"]))

    return (F.size(points) > 1) & F.exists(ends, on)


def polygon_edges(points: Column) -> Column:
    """array<struct(px, py, qx, qy)>: the edges of a closed polygon of struct(lng, lat)."""
    after = F.concat(F.slice(points, 2, F.size(points)), F.slice(points, 1, 1))
    return F.zip_with(points, after, lambda a, b: F.struct(a["lng"].alias("px"), a["lat"].alias("py"), b["lng"].alias("qx"), b["lat"].alias("qy")))


def in_polygon(x: Column, y: Column, edges: Column, tolerance: float = 2e-10) -> Column:
    """Whether a point is inside a polygon, borders included: on an edge, or an odd number of edges to its east."""

    def on(e: Column) -> Column:
        cross = (e["qx"] - e["px"]) * (y - e["py"]) - (x - e["px"]) * (e["qy"] - e["py"])
        near = lambda v, a, b: v.between(F.least(a, b) - tolerance, F.greatest(a, b) + tolerance)
        return (F.abs(cross) <= tolerance) & near(x, e["px"], e["qx"]) & near(y, e["py"], e["qy"])

    def east(e: Column) -> Column:
        at = e["px"] + F.try_divide((y - e["py"]) * (e["qx"] - e["px"]), e["qy"] - e["py"])
        return ((e["py"] > y) != (e["qy"] > y)) & (x < at)

    return F.exists(edges, on) | (F.size(F.filter(edges, east)) % 2 == 1)


TAU = 2 * math.pi


def polygon_area_m2(points: Column) -> Column:
    """Area of a spherical polygon by its angle excess; null and fewer than three points give 0.

    The angle at a corner is that between the planes through it and its neighbours; the smaller of both sides counts.
    """
    dot = lambda a, b: a["x"] * b["x"] + a["y"] * b["y"] + a["z"] * b["z"]
    cross = lambda a, b: F.struct((a["y"] * b["z"] - a["z"] * b["y"]).alias("x"), (a["z"] * b["x"] - a["x"] * b["z"]).alias("y"), (a["x"] * b["y"] - a["y"] * b["x"]).alias("z"))

    def unit(p: Column) -> Column:
        lng, lat = F.radians(p["lng"]), F.radians(p["lat"])
        return F.struct((F.cos(lat) * F.cos(lng)).alias("x"), (F.cos(lat) * F.sin(lng)).alias("y"), F.sin(lat).alias("z"))

    def angle(c: Column) -> Column:
        return F.pmod(F.atan2(dot(cross(c["right"], c["left"]), c["at"]), dot(c["left"], c["right"])), F.lit(TAU))

    n = F.size(points)

    def angles(at: Column) -> Column:
        before = F.concat(F.slice(at, n, 1), F.slice(at, 1, F.greatest(n - 1, F.lit(0))))
        after = F.concat(F.slice(at, 2, F.greatest(n - 1, F.lit(0))), F.slice(at, 1, 1))
        left = F.zip_with(before, at, lambda b, p: F.struct(p.alias("at"), cross(b, p).alias("left")))
        corners = F.zip_with(left, after, lambda c, a: F.struct(c["at"].alias("at"), c["left"].alias("left"), cross(a, c["at"]).alias("right")))
        return F.transform(corners, angle)

    def area(total: Column) -> Column:
        flat = (n - 2) * math.pi
        return F.abs(F.least(total - flat, TAU * n - total - flat)) * EARTH_M**2

    # Values used more than once are bound as the element of an array, so that they are computed once.
    once = lambda value, use: F.transform(F.array(value), use)[0]
    total = F.aggregate(once(F.transform(points, unit), angles), F.lit(0.0), lambda s, v: s + v)
    return F.when(n >= 3, once(total, area)).otherwise(0.0)
