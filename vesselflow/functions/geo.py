"""Geometry and tile functions as Column expressions. A ring is array<array<double>> of (lon, lat), closed."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6371008.77
MAJOR_M, FLATTENING = 6378137.0, 1 / 298.257223563
ECC2 = FLATTENING * (2 - FLATTENING)
MAX_LAT = 85.05112878


def _x(p: Column) -> Column:
    return F.get(p, F.lit(0))


def _y(p: Column) -> Column:
    return F.get(p, F.lit(1))


def edges(ring: Column) -> Column:
    """array<struct<a, b>> of the ring's sides."""
    n = F.size(ring) - 1
    return F.zip_with(F.slice(ring, 1, n), F.slice(ring, 2, n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def all_edges(rings: Column) -> Column:
    """Sides of all rings of a polygon: by the even-odd rule over them, what lies in a hole lies outside."""
    return F.flatten(F.transform(rings, edges))


def area(rings: Column) -> Column:
    """Planar area in square degrees: the first ring's less the holes'."""
    return F.aggregate(rings, F.lit(0.0), lambda s, r: s - ring_area(r)) + 2 * ring_area(F.get(rings, F.lit(0)))


def touches(e: Column, box: Column) -> Column:
    """Whether a side meets a box (struct<xmin, ymin, xmax, ymax>), borders included."""
    ax, ay, bx, by = _x(e["a"]), _y(e["a"]), _x(e["b"]), _y(e["b"])
    over = (F.greatest(ax, bx) >= box["xmin"]) & (F.least(ax, bx) <= box["xmax"]) & (F.greatest(ay, by) >= box["ymin"]) & (F.least(ay, by) <= box["ymax"])
    # The corners aren't all on one side of the line.
    turns = [(bx - ax) * (box[y] - ay) - (by - ay) * (box[x] - ax) for x in ("xmin", "xmax") for y in ("ymin", "ymax")]
    return over & (F.least(*turns) <= 0) & (F.greatest(*turns) >= 0)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)


def ring_area(ring: Column) -> Column:
    """Planar area in square degrees."""
    return F.abs(_sum(F.transform(edges(ring), lambda e: _x(e["a"]) * _y(e["b"]) - _x(e["b"]) * _y(e["a"])))) / 2


def centroid(ring: Column) -> Column:
    """struct<lon, lat> of the polygon's centroid; of the first point where the area is 0."""
    cross = lambda e: _x(e["a"]) * _y(e["b"]) - _x(e["b"]) * _y(e["a"])
    twice = _sum(F.transform(edges(ring), cross))
    part = lambda at: _sum(F.transform(edges(ring), lambda e: (at(e["a"]) + at(e["b"])) * cross(e))) / F.nullif(3 * twice, F.lit(0.0))
    first = F.get(ring, F.lit(0))
    return F.struct(F.coalesce(part(_x), _x(first)).alias("lon"), F.coalesce(part(_y), _y(first)).alias("lat"))


def envelope(ring: Column, grow: float = 0.0) -> Column:
    """struct<xmin, ymin, xmax, ymax>, grown by so many degrees on every side."""
    xs, ys = F.transform(ring, _x), F.transform(ring, _y)
    return F.struct(
        (F.array_min(xs) - grow).alias("xmin"), (F.array_min(ys) - grow).alias("ymin"), (F.array_max(xs) + grow).alias("xmax"), (F.array_max(ys) + grow).alias("ymax")
    )


def covers(ring: Column, lon: Column, lat: Column) -> Column:
    """Whether the polygon contains the point, its boundary included; null where a coordinate is null."""
    return covered_by(edges(ring), lon, lat)


def covered_by(sides: Column, lon: Column, lat: Column) -> Column:
    """`covers` for the `edges` of a ring, in one pass over them."""

    def on_side(e: Column) -> Column:
        ax, ay, bx, by = _x(e["a"]), _y(e["a"]), _x(e["b"]), _y(e["b"])
        straight = (bx - ax) * (lat - ay) == (by - ay) * (lon - ax)
        return straight & lon.between(F.least(ax, bx), F.greatest(ax, bx)) & lat.between(F.least(ay, by), F.greatest(ay, by))

    def crossed(e: Column) -> Column:
        ax, ay, bx, by = _x(e["a"]), _y(e["a"]), _x(e["b"]), _y(e["b"])
        at = ax + (bx - ax) * (lat - ay) / F.nullif(by - ay, F.lit(0.0))
        return ((ay > lat) != (by > lat)) & (lon < at)

    # 0 and 1: outside and inside by the sides so far; 2: on a side.
    step = lambda s, e: F.when((s == 2) | on_side(e), 2).when(crossed(e), 1 - s).otherwise(s)
    return F.when(lon.isNotNull() & lat.isNotNull(), F.aggregate(sides, F.lit(0), step) > 0)


def mean_radius_m(ring: Column) -> Column:
    """Mean great-circle distance of the ring's corners from the mean of the corners."""
    lon, lat = _centre(ring)
    return _mean(F.transform(_corners(ring), lambda p: sphere_m(lon, lat, _x(p), _y(p))))


def resampled(ring: Column, sides: int) -> Column:
    """Ring of so many corners (3 to 200) around the mean of the ring's corners, at their mean distance from it."""
    lon, lat = _centre(ring)
    d, phi, steps = mean_radius_m(ring) / EARTH_M, F.radians(lat), max(3, min(200, sides))

    def corner(k: Column) -> Column:
        t = 2 * math.pi * k / steps
        y = F.asin(F.sin(phi) * F.cos(d) + F.cos(phi) * F.sin(d) * F.cos(t))
        x = F.atan2(F.sin(t) * F.sin(d) * F.cos(phi), F.cos(d) - F.sin(phi) * F.sin(y))
        return F.array(lon + F.degrees(x), F.degrees(y))

    return F.transform(F.sequence(F.lit(0), F.lit(steps)), lambda k: corner(F.pmod(k, F.lit(steps))))


def _corners(ring: Column) -> Column:
    return F.slice(ring, 1, F.size(ring) - 1)


def _mean(values: Column) -> Column:
    return _sum(values) / F.size(values)


def _centre(ring: Column) -> tuple[Column, Column]:
    return _mean(F.transform(_corners(ring), _x)), _mean(F.transform(_corners(ring), _y))


def sphere_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance in metres."""
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), F.lit(2.0)) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2.0))
    return 2 * EARTH_M * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def sphere_m_of(lon1: float, lat1: float, lon2: float, lat2: float) -> float:
    """The same for plain numbers."""
    a, b = math.radians(lat1), math.radians(lat2)
    h = math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_M * math.asin(min(1.0, math.sqrt(h)))


def local_m_of(lon1: float, lat1: float, lon2: float, lat2: float) -> float:
    """Ellipsoidal distance in metres by the radii of curvature at the middle latitude; for short distances."""
    phi = math.radians((lat1 + lat2) / 2)
    w = 1 - ECC2 * math.sin(phi) ** 2
    north = MAJOR_M * (1 - ECC2) / w**1.5 * math.radians(lat2 - lat1)
    east = MAJOR_M / math.sqrt(w) * math.cos(phi) * math.radians(lon2 - lon1)
    return math.hypot(north, east)


def angle_between(a: Column, b: Column) -> Column:
    """Least turn between two headings in degrees."""
    d = F.abs(a - b)
    return F.least(d, 360 - d)


# Web-Mercator tiles


def tile_x(lon: Column, zoom: Column) -> Column:
    return ((lon + 180.0) / 360.0 * F.pow(F.lit(2.0), zoom)).cast("int")


def tile_y(lat: Column, zoom: Column) -> Column:
    r = F.radians(F.greatest(F.lit(-MAX_LAT), F.least(F.lit(MAX_LAT), lat)))
    return ((1 - F.log(F.tan(r) + 1 / F.cos(r)) / math.pi) / 2 * F.pow(F.lit(2.0), zoom)).cast("int")


def flip_y(y: Column, zoom: Column) -> Column:
    """XYZ row to TMS row and back."""
    return (F.pow(F.lit(2.0), zoom).cast("int") - 1 - y).cast("int")


def wrap_lon(lon: Column) -> Column:
    """To [-180, 180)."""
    return F.pmod(lon + 180.0, F.lit(360.0)) - 180.0


def polygon_json(ring: Column) -> Column:
    """GeoJSON text of the polygon."""
    return F.to_json(F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")))


# Generators for fixtures


def rectangle(xmin: float, ymin: float, xmax: float, ymax: float) -> list[list[float]]:
    return [[float(x), float(y)] for x, y in ((xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax), (xmin, ymin))]


def slab_at_lon(lon: float, south: float, north: float, width: float) -> list[list[float]]:
    """Thin rectangle along a meridian, such as a gate."""
    return rectangle(lon - width / 2, south, lon + width / 2, north)


def slab_at_lat(lat: float, west: float, east: float, height: float) -> list[list[float]]:
    """Thin rectangle along a parallel."""
    return rectangle(west, lat - height / 2, east, lat + height / 2)


def circle(lon: float, lat: float, radius_nm: float, steps: int = 48) -> list[list[float]]:
    """Ring of points at a great-circle distance from the centre."""
    d, phi, lam = radius_nm * 1852 / EARTH_M, math.radians(lat), math.radians(lon)
    out = []
    for k in range(steps):
        t = 2 * math.pi * k / steps
        y = math.asin(math.sin(phi) * math.cos(d) + math.cos(phi) * math.sin(d) * math.cos(t))
        x = lam + math.atan2(math.sin(t) * math.sin(d) * math.cos(phi), math.cos(d) - math.sin(phi) * math.sin(y))
        out.append([math.degrees(x), math.degrees(y)])
    return [*out, out[0]]


def simplify_ring(ring: list[list[float]], tolerance: float) -> list[list[float]]:
    """Douglas-Peucker on a closed ring; never fewer than four points, so that a polygon stays one."""
    if len(ring) <= 4:
        return ring
    far = max(range(1, len(ring) - 1), key=lambda i: math.dist(ring[0], ring[i]))
    keep = {0, far, len(ring) - 1}
    off: list[tuple[float, int]] = []
    todo = [(0, far), (far, len(ring) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        p, q = ring[a], ring[b]
        length = math.dist(p, q)
        gap = lambda r: abs((q[0] - p[0]) * (p[1] - r[1]) - (p[0] - r[0]) * (q[1] - p[1])) / length if length else math.dist(p, r)  # noqa: B023, E731
        d, i = max((gap(ring[i]), i) for i in range(a + 1, b))
        off.append((d, i))
        if d > tolerance:
            keep.add(i)
            todo += [(a, i), (i, b)]
    for _, i in sorted(off, reverse=True):
        if len(keep) >= 4:
            break
        keep.add(i)
    return [ring[i] for i in sorted(keep)]
