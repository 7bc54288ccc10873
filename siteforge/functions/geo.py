"""Geometry as Column expressions: distances, projection, hex grid, boxes, rings."""
from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6371008.8


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = EARTH_M) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * radius * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def equirectangular_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    dx = (lon2 - lon1) * 111320 * F.cos(F.radians((lat1 + lat2) / 2))
    return F.sqrt(dx * dx + F.pow((lat2 - lat1) * 111320, 2))


#: Half axis in metres and squared eccentricity of the GRS80 ellipsoid.
GRS80 = (6378137.0, 0.00669438002290079)


def _albers(ellipsoid: tuple[float, float]) -> tuple[float, ...]:
    """(a, e, n, c, rho0) of the ellipsoidal Albers projection (parallels 29.5 and 45.5, origin 23 N 96 W)."""
    a, e2 = ellipsoid
    e = math.sqrt(e2)
    q_of = lambda s: (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))
    m_of = lambda p: math.cos(p) / math.sqrt(1 - e2 * math.sin(p) ** 2)
    p1, p2, p0 = (math.radians(x) for x in (29.5, 45.5, 23.0))
    n = (m_of(p1) ** 2 - m_of(p2) ** 2) / (q_of(math.sin(p2)) - q_of(math.sin(p1)))
    c = m_of(p1) ** 2 + n * q_of(math.sin(p1))
    return a, e, n, c, a * math.sqrt(c - n * q_of(math.sin(p0))) / n


def _albers_q(s: Column, e: float) -> Column:
    return (1 - e * e) * (s / (1 - e * e * s * s) - F.log((1 - e * s) / (1 + e * s)) / (2 * e))


def albers_xy(lat: Column, lon: Column, ellipsoid: tuple[float, float] = GRS80) -> tuple[Column, Column]:
    """Metres east and north in the equal-area projection."""
    a, e, n, c, rho0 = _albers(ellipsoid)
    rho = a * F.sqrt(c - n * _albers_q(F.sin(F.radians(lat)), e)) / n
    theta = n * F.radians(lon + 96)
    return rho * F.sin(theta), rho0 - rho * F.cos(theta)


def albers_latlon(x: Column, y: Column, ellipsoid: tuple[float, float] = GRS80) -> tuple[Column, Column]:
    """The inverse of albers_xy: authalic latitude first, then three Newton steps."""
    a, e, n, c, rho0 = _albers(ellipsoid)
    rho, theta = F.sqrt(x * x + (rho0 - y) * (rho0 - y)), F.atan2(x, rho0 - y)
    q = (c - F.pow(rho * n / a, 2)) / n
    phi = F.asin(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), q / 2)))
    for _ in range(3):
        s = F.sin(phi)
        phi = phi + F.pow(1 - e * e * s * s, 2) / (2 * F.cos(phi)) * ((q - _albers_q(s, e)) / (1 - e * e))
    return F.degrees(phi), F.degrees(theta / n) - 96


def hex_cell(x: Column, y: Column, size: float = 190.5) -> tuple[Column, Column]:
    """Axial hex cell (q, r) of a metric point, by cube rounding; neighbours' centres are size * sqrt(3) apart."""
    fq, fr = (0.5773502691896258 * x - y / 3) / size, (2 * y / 3) / size
    fs = -fq - fr
    q, r, s = F.round(fq), F.round(fr), F.round(fs)
    dq, dr, ds = F.abs(q - fq), F.abs(r - fr), F.abs(s - fs)
    return (
        F.when((dq > dr) & (dq > ds), -r - s).otherwise(q).cast("bigint"),
        F.when(~((dq > dr) & (dq > ds)) & (dr > ds), -q - s).otherwise(r).cast("bigint"),
    )


def hex_distance(q1: Column, r1: Column, q2: Column, r2: Column) -> Column:
    return F.greatest(F.abs(q1 - q2), F.abs(r1 - r2), F.abs(q1 - q2 + r1 - r2))


def box_iou(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """Intersection over union of boxes (x0, y0, x1, y1); 0 for empty unions."""
    w = F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    h = F.greatest(F.lit(0.0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - w * h
    return F.when(union > 0, w * h / union).otherwise(0.0)


def ring_area(ring: Column) -> Column:
    """Shoelace area of a closed ring, array<struct<x, y>>."""
    n = F.size(ring) - 1
    terms = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(ring, i)["x"] * F.get(ring, i + 1)["y"] - F.get(ring, i + 1)["x"] * F.get(ring, i)["y"])
    return F.abs(F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)) / 2


def in_ring(ring: Column, x: Column, y: Column) -> Column:
    """Even-odd crossing test, boundary included; ring is closed."""
    return let(F.struct(ring.alias("ring"), x.alias("x"), y.alias("y")), lambda s: _in_ring(s["ring"], s["x"], s["y"]))


def _in_ring(ring: Column, x: Column, y: Column) -> Column:
    edges = F.transform(F.sequence(F.lit(0), F.size(ring) - 2), lambda i: F.struct(F.get(ring, i).alias("a"), F.get(ring, i + 1).alias("b")))
    on = F.exists(
        edges,
        lambda e: (((e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) - (e["b"]["y"] - e["a"]["y"]) * (x - e["a"]["x"])) == 0)
        & x.between(F.least(e["a"]["x"], e["b"]["x"]), F.greatest(e["a"]["x"], e["b"]["x"]))
        & y.between(F.least(e["a"]["y"], e["b"]["y"]), F.greatest(e["a"]["y"], e["b"]["y"])),
    )
    cross = F.filter(edges, lambda e: ((e["a"]["y"] > y) != (e["b"]["y"] > y)) & (x < (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) / (e["b"]["y"] - e["a"]["y"]) + e["a"]["x"]))
    return on | (F.size(cross) % 2 == 1)


def in_corners(corners: list[tuple[Column, Column]], x: Column, y: Column) -> Column:
    """in_ring for a ring of a fixed number of corners (x, y), the first not repeated: plain arithmetic, which Spark compiles."""
    on, crossings = F.lit(False), F.lit(0)
    for (ax, ay), (bx, by) in zip(corners, corners[1:] + corners[:1]):
        on = on | (((bx - ax) * (y - ay) - (by - ay) * (x - ax)) == 0) & x.between(F.least(ax, bx), F.greatest(ax, bx)) & y.between(F.least(ay, by), F.greatest(ay, by))
        crossings = crossings + F.when((ay > y) != (by > y), (x < (bx - ax) * (y - ay) / (by - ay) + ax).cast("int")).otherwise(0)
    return on | (crossings % 2 == 1)


def hex_center(q: Column, r: Column, size: float = 190.5) -> tuple[Column, Column]:
    """Metric centre of an axial hex cell."""
    return size * 1.7320508075688772 * (q + r / 2), size * 1.5 * r


def pixel_lonlat(px: Column, py: Column, west: Column, south: Column, east: Column, north: Column, width: int, height: int) -> tuple[Column, Column]:
    """Longitude and latitude of a pixel; rows count from the top, so y flips."""
    return west + px / width * (east - west), north - py / height * (north - south)


def remap_box(box: tuple[Column, ...], dx: Column, dy: Column, width: float, height: float, least: float = 2.0) -> Column:
    """A box (x0, y0, x1, y1) seen from a tile whose corner is dx, dy away, clipped to it; null if a side is under `least` pixels."""
    clip = lambda v, most: F.greatest(F.lit(0.0), F.least(F.lit(float(most)), v))
    x0, y0, x1, y1 = clip(box[0] - dx, width), clip(box[1] - dy, height), clip(box[2] - dx, width), clip(box[3] - dy, height)
    return F.when((x1 - x0 >= least) & (y1 - y0 >= least), F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1")))


def _edges(ring: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.size(ring) - 2), lambda i: F.struct(F.get(ring, i).alias("a"), F.get(ring, i + 1).alias("b")))


def _segment_distance(px: Column, py: Column, a: Column, b: Column) -> Column:
    dx, dy = b["x"] - a["x"], b["y"] - a["y"]
    length = dx * dx + dy * dy
    t = F.when(length > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((px - a["x"]) * dx + (py - a["y"]) * dy) / length))).otherwise(0.0)
    return F.sqrt(F.pow(px - a["x"] - t * dx, 2) + F.pow(py - a["y"] - t * dy, 2))


def ring_distance(ring: Column, x: Column, y: Column) -> Column:
    """Metres from a point to a closed ring's area (0 inside)."""
    return F.when(in_ring(ring, x, y), 0.0).otherwise(F.array_min(F.transform(_edges(ring), lambda e: _segment_distance(x, y, e["a"], e["b"]))))


def ring_gap(r: Column, s: Column) -> Column:
    """Metres between the areas of two closed rings, 0 if they touch or overlap."""
    side = lambda a, b, c: (b["x"] - a["x"]) * (c["y"] - a["y"]) - (b["y"] - a["y"]) * (c["x"] - a["x"])

    def crosses(e, f):
        return (side(e["a"], e["b"], f["a"]) * side(e["a"], e["b"], f["b"]) < 0) & (side(f["a"], f["b"], e["a"]) * side(f["a"], f["b"], e["b"]) < 0)

    to = lambda a, b: F.array_min(F.transform(a, lambda p: ring_distance(b, p["x"], p["y"])))
    over = F.exists(_edges(r), lambda e: F.exists(_edges(s), lambda f: crosses(e, f)))
    return F.when(over, 0.0).otherwise(F.least(to(r, s), to(s, r)))


def ring_meets_box(ring: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Whether a closed ring's area and a box share a point: an edge crosses the box (neither axis nor the edge's own line parts them), or the
    box lies inside."""

    def meets(e):
        a, b = e["a"], e["b"]
        side = lambda x, y: (b["x"] - a["x"]) * (y - a["y"]) - (b["y"] - a["y"]) * (x - a["x"])
        corners = [side(x0, y0), side(x1, y0), side(x1, y1), side(x0, y1)]
        apart = (F.greatest(a["x"], b["x"]) < x0) | (F.least(a["x"], b["x"]) > x1) | (F.greatest(a["y"], b["y"]) < y0) | (F.least(a["y"], b["y"]) > y1)
        return ~apart & (F.least(*corners) <= 0) & (F.greatest(*corners) >= 0)

    return F.exists(_edges(ring), meets) | in_ring(ring, x0, y0)


def box_overlap(ring: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Area that a closed ring's inside shares with a box: the ring is clipped at one side of the box after the other.

    A side is (whether it is upright, where it lies, on which side to stay); the ring so far is the aggregate's state.
    """
    point = "array<struct<x:double,y:double>>"
    side = lambda upright, at, sign: F.struct(F.lit(upright).alias("upright"), at.cast("double").alias("at"), F.lit(sign).alias("sign"))

    def clip(state, s):
        def cut(i):
            a, b = F.get(state, i), F.get(state, i + 1)
            u, v = F.when(s["upright"], a["x"]).otherwise(a["y"]), F.when(s["upright"], b["x"]).otherwise(b["y"])
            t = (s["at"] - u) / F.nullif(v - u, F.lit(0.0))
            hit = F.struct((a["x"] + t * (b["x"] - a["x"])).alias("x"), (a["y"] + t * (b["y"] - a["y"])).alias("y"))
            inside = lambda w: (w - s["at"]) * s["sign"] >= 0
            return F.when(inside(u) & inside(v), F.array(a)).when(inside(u), F.array(a, hit)).when(inside(v), F.array(hit)).otherwise(F.array().cast(point))

        points = F.flatten(F.transform(F.sequence(F.lit(0), F.size(state) - 2), cut))
        closed = F.element_at(F.transform(F.array(points), lambda p: F.concat(p, F.slice(p, 1, 1))), 1)
        return F.when(F.size(state) > 3, closed).otherwise(F.array().cast(point))

    sides = F.array(side(True, x0, 1), side(True, x1, -1), side(False, y0, 1), side(False, y1, -1))
    left = F.aggregate(sides, ring.cast(point), clip)
    return F.element_at(F.transform(F.array(left), lambda r: F.when(F.size(r) > 3, ring_area(r)).otherwise(0.0)), 1)


def centroid(ring: Column) -> Column:
    """struct(x, y): the area's centre; the mean of the corners where the area is 0.

    It is taken from the first corner on: far from the origin the products would lose the digits that tell corners apart.
    """
    near = lambda r: F.transform(r, lambda p: F.struct((p["x"] - F.get(r, F.lit(0))["x"]).alias("x"), (p["y"] - F.get(r, F.lit(0))["y"]).alias("y")))
    back = lambda r, c: F.struct((F.get(r, F.lit(0))["x"] + c["x"]).alias("x"), (F.get(r, F.lit(0))["y"] + c["y"]).alias("y"))
    return let(ring, lambda r: let(let(near(r), _centroid), lambda c: back(r, c)))


def _centroid(ring: Column) -> Column:
    start = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def add(acc, e):
        k = e["a"]["x"] * e["b"]["y"] - e["b"]["x"] * e["a"]["y"]
        return F.struct((acc["a"] + k).alias("a"), (acc["x"] + (e["a"]["x"] + e["b"]["x"]) * k).alias("x"), (acc["y"] + (e["a"]["y"] + e["b"]["y"]) * k).alias("y"))

    corners = F.slice(ring, 1, F.size(ring) - 1)
    mean = lambda f: F.aggregate(corners, F.lit(0.0), lambda t, p: t + p[f]) / F.size(corners)
    at = lambda s, f: F.when(s["a"] != 0, s[f] / (3 * s["a"])).otherwise(mean(f)).alias(f)
    return let(F.aggregate(_edges(ring), start, add), lambda s: F.struct(at(s, "x"), at(s, "y")))


def corners_centroid(corners: list[tuple[Column, Column]]) -> Column:
    """centroid for a ring of a fixed number of corners (x, y), the first not repeated: plain arithmetic, which Spark compiles."""
    x0, y0 = corners[0]
    near = [(x - x0, y - y0) for x, y in corners]
    area, mx, my = F.lit(0.0), F.lit(0.0), F.lit(0.0)
    for (ax, ay), (bx, by) in zip(near, near[1:] + near[:1]):
        k = ax * by - bx * ay
        area, mx, my = area + k, mx + (ax + bx) * k, my + (ay + by) * k
    mean = lambda i: sum((p[i] for p in near), F.lit(0.0)) / len(near)
    at = lambda m, i: F.when(area != 0, m / (3 * area)).otherwise(mean(i))
    return F.struct((x0 + at(mx, 0)).alias("x"), (y0 + at(my, 1)).alias("y"))


def four_corners(ring: Column) -> tuple[Column, list[tuple[Column, Column]]]:
    """Whether a ring is closed and has four corners, and those."""
    p = [(F.get(ring, F.lit(i))["x"], F.get(ring, F.lit(i))["y"]) for i in range(5)]
    return (F.size(ring) == 5) & (p[4][0] == p[0][0]) & (p[4][1] == p[0][1]), p[:4]


def surface_point(ring: Column) -> Column:
    """struct(x, y): a point of the area: the middle of the widest chord at half the ring's height."""
    ys = F.transform(ring, lambda p: p["y"])
    h = (F.array_min(ys) + F.array_max(ys)) / 2
    # a corner at that height would count twice: a hair above it instead
    h = F.when(F.array_contains(ys, h), h + (F.array_max(ys) - F.array_min(ys)) * 1e-6).otherwise(h)
    cut = F.filter(_edges(ring), lambda e: (e["a"]["y"] > h) != (e["b"]["y"] > h))
    xs = F.array_sort(F.transform(cut, lambda e: e["a"]["x"] + (h - e["a"]["y"]) / (e["b"]["y"] - e["a"]["y"]) * (e["b"]["x"] - e["a"]["x"])))
    chords = F.transform(F.sequence(F.lit(0), (F.size(xs) / 2 - 1).cast("int")), lambda i: F.struct((F.get(xs, 2 * i + 1) - F.get(xs, 2 * i)).alias("w"), ((F.get(xs, 2 * i) + F.get(xs, 2 * i + 1)) / 2).alias("x")))
    return F.struct(F.array_max(chords)["x"].alias("x"), h.alias("y"))


def simplify(ring: Column, metres: float) -> Column:
    """A closed ring less the corners that lie within `metres` of the line between the last kept corner and the next one."""
    start = F.slice(ring, 1, 1)
    inner = F.sequence(F.lit(1), F.size(ring) - 2)

    def keep(acc, i):
        last, p, q = F.element_at(acc, -1), F.get(ring, i), F.get(ring, i + 1)
        return F.when(_segment_distance(p["x"], p["y"], last, q) > metres, F.concat(acc, F.array(p))).otherwise(acc)

    return F.concat(F.aggregate(inner, start, keep), F.slice(ring, -1, 1))


def box_ring(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    p = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(p(x0, y0), p(x1, y0), p(x1, y1), p(x0, y1), p(x0, y0))
