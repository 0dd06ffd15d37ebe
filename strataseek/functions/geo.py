"""Planar and spherical geometry on WKT text, built from native Spark expressions.

A point is ``struct<x, y>`` (x = longitude). A polygon or multipolygon is parsed
from WKT into ``array<struct<exterior, points>>``; predicates then work on its
flat edge array ``array<struct<x1, y1, x2, y2>>``. No geometry type is stored:
tables keep lon/lat doubles and WKT strings.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean earth radius in metres.
EARTH_RADIUS_M = 6371008.8

_NUMBER = r"[-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?"
_COORDINATE = rf"^{_NUMBER} {_NUMBER}(?: {_NUMBER}){{0,2}}$"
_RING = r"((?:\()*)\(([^()]*)\)"
# After every ring body is replaced by "#", a valid text looks like one of these.
_POLYGON_SHAPE = r"^POLYGON(?: ?Z)?\(#(?:,#)*+\)$"
_MULTIPOLYGON_SHAPE = r"^MULTIPOLYGON(?: ?Z)?\(\(#(?:,#)*+\)(?:,\(#(?:,#)*+\))*+\)$"
_EMPTY_SHAPE = r"^(?:MULTI)?POLYGON(?: ?Z)? EMPTY$"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


# ---------------------------------------------------------------- text <-> geometry

def number_text(value: Column | str) -> Column:
    """Shortest plain decimal text: no trailing ``.0`` and no exponent."""
    v = _column(value).cast("double") + 0.0  # -0.0 becomes 0.0
    text = v.cast("string")
    wide = F.regexp_replace(v.cast("decimal(38,18)").cast("string"), r"\.?0+$", "")
    short = F.rtrim(F.replace(F.concat(text, F.lit(" ")), F.lit(".0 "), F.lit(" ")))
    return F.when(F.contains(text, F.lit("E")), wide).otherwise(short)


def st_point(x: Column | str, y: Column | str) -> Column:
    """Point from x (longitude) and y (latitude); null when either is null."""
    x, y = _column(x).cast("double"), _column(y).cast("double")
    return F.when(x.isNotNull() & y.isNotNull(), F.struct(x.alias("x"), y.alias("y")))


def st_x(point: Column | str) -> Column:
    return _column(point)["x"]


def st_y(point: Column | str) -> Column:
    return _column(point)["y"]


def point_wkt(x: Column | str, y: Column | str) -> Column:
    """``POINT(x y)`` text, without a regular expression unless a number has an exponent."""
    x, y = _column(x).cast("double") + 0.0, _column(y).cast("double") + 0.0

    def written(a: Column, b: Column) -> Column:
        return F.concat(F.lit("POINT("), a, F.lit(" "), b, F.lit(")"))

    text = written(x.cast("string"), y.cast("string"))
    short = F.replace(F.replace(text, F.lit(".0 "), F.lit(" ")), F.lit(".0)"), F.lit(")"))
    return F.when(F.contains(text, F.lit("E")), written(number_text(x), number_text(y))) \
        .otherwise(short)


def geography_wkt(lon: Column | str, lat: Column | str) -> Column:
    """Text of a geographic point; null unless lon/lat are in range. The same text as
    parsing and printing the point, since number text converts back without loss."""
    lon, lat = _column(lon), _column(lat)
    return F.when(lon.between(-180.0, 180.0) & lat.between(-90.0, 90.0), point_wkt(lon, lat))


def st_point_from_text(wkt: Column | str) -> Column:
    """Planar point from ``POINT(x y)`` text; null for anything else."""
    text = F.trim(_column(wkt))
    pattern = rf"(?i)^POINT\s*\(\s*({_NUMBER})\s+({_NUMBER})\s*\)$"
    return F.when(
        text.rlike(pattern),
        st_point(F.regexp_extract(text, pattern, 1).cast("double"),
                 F.regexp_extract(text, pattern, 2).cast("double")))


def st_geography_from_text(wkt: Column | str) -> Column:
    """Like :func:`st_point_from_text`, but null unless lon/lat are in range."""
    return let(st_point_from_text(wkt), lambda p: F.when(
        p["x"].between(-180.0, 180.0) & p["y"].between(-90.0, 90.0), p))


def _tidy(wkt: Column) -> Column:
    text = F.upper(F.trim(F.regexp_replace(wkt, r"\s+", " ")))
    return F.regexp_replace(text, r" ?([(),]) ?", "$1")


def _ring_points(body: Column) -> Column:
    return F.transform(
        F.split(body, ","),
        lambda c: F.struct(F.split(c, " ")[0].cast("double").alias("x"),
                           F.split(c, " ")[1].cast("double").alias("y")))


def st_rings(wkt: Column | str) -> Column:
    """Parse POLYGON / MULTIPOLYGON text into rings; null when the text is malformed.

    A ring opens a new part when its bracket follows another opening bracket, so
    it is an exterior ring; every other ring is a hole. Rings must be closed and
    have at least four points. ``EMPTY`` gives an empty array.
    """
    def parsed(text: Column) -> Column:
        skeleton = F.regexp_replace(text, r"\([^()]*\)", "#")
        shaped = skeleton.rlike(_POLYGON_SHAPE) | skeleton.rlike(_MULTIPOLYGON_SHAPE)
        bodies = F.regexp_extract_all(text, F.lit(_RING), F.lit(2))
        roles = F.regexp_extract_all(text, F.lit(_RING), F.lit(1))
        sound = F.forall(bodies, lambda b: F.forall(
            F.split(b, ","), lambda c: c.rlike(_COORDINATE)))
        rings = F.zip_with(roles, bodies, lambda r, b: F.struct(
            (F.length(r) > 0).alias("exterior"), _ring_points(b).alias("points")))
        return (F.when(text.rlike(_EMPTY_SHAPE), F.slice(rings, 1, 0))
                .when(shaped & sound, rings))

    def closed(rings: Column) -> Column:
        return F.when(F.forall(rings, lambda r: (F.size(r["points"]) >= 4) & (
            F.element_at(r["points"], 1) == F.element_at(r["points"], -1))), rings)

    return let(let(_tidy(_column(wkt)), parsed), closed)


def rings_wkt(rings: Column | str) -> Column:
    """Canonical WKT of parsed rings: POLYGON for one part, MULTIPOLYGON for more."""
    def body(ring: Column) -> Column:
        return F.concat(F.lit("("), F.array_join(F.transform(
            ring["points"],
            lambda p: F.concat(number_text(p["x"]), F.lit(" "), number_text(p["y"]))), ","),
            F.lit(")"))

    def text(r: Column) -> Column:
        parts = F.size(F.filter(r, lambda x: x["exterior"]))
        # every exterior ring after the first closes one part and opens the next
        joined = F.aggregate(
            r, F.lit(""),
            lambda acc, x: F.concat(acc, F.when(acc == "", F.lit(""))
                                    .when(x["exterior"], F.lit("),(")).otherwise(F.lit(",")),
                                    body(x)))
        return (F.when(F.size(r) == 0, F.lit("POLYGON EMPTY"))
                .when(parts > 1, F.concat(F.lit("MULTIPOLYGON(("), joined, F.lit("))")))
                .otherwise(F.concat(F.lit("POLYGON("), joined, F.lit(")"))))

    return let(_column(rings), text)


def st_edges(rings: Column | str) -> Column:
    """All ring segments of a parsed polygon as one flat array."""
    def ring_edges(ring: Column) -> Column:
        n = F.size(ring["points"]) - 1
        return F.zip_with(
            F.slice(ring["points"], 1, n), F.slice(ring["points"], 2, n),
            lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"),
                                  b["x"].alias("x2"), b["y"].alias("y2")))

    return F.flatten(F.transform(_column(rings), ring_edges))


def st_box(rings: Column | str) -> Column:
    """Bounding box ``struct<min_x, min_y, max_x, max_y>``; null fields when empty."""
    def box(points: Column) -> Column:
        xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
        return F.struct(F.array_min(xs).alias("min_x"), F.array_min(ys).alias("min_y"),
                        F.array_max(xs).alias("max_x"), F.array_max(ys).alias("max_y"))

    return let(F.flatten(F.transform(_column(rings), lambda r: r["points"])), box)


# ---------------------------------------------------------------- predicates

def edge_crosses_ray(e: Column, x: Column, y: Column) -> Column:
    """Whether the ray from (x, y) to the right crosses edge ``e`` (half-open in y)."""
    return ((e["y1"] > y) != (e["y2"] > y)) & (
        x < (e["x2"] - e["x1"]) * (y - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"])


def point_on_edge(e: Column, x: Column, y: Column) -> Column:
    return (x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"]))
            & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))
            & ((e["x2"] - e["x1"]) * (y - e["y1"]) == (e["y2"] - e["y1"]) * (x - e["x1"])))


def on_boundary(edges: Column | str, x: Column | str, y: Column | str) -> Column:
    x, y = _column(x), _column(y)
    return F.exists(_column(edges), lambda e: point_on_edge(e, x, y))


def _odd_crossings(edges: Column | str, x: Column | str, y: Column | str) -> Column:
    x, y = _column(x), _column(y)
    return F.size(F.filter(_column(edges), lambda e: edge_crosses_ray(e, x, y))) % 2 == 1


def _known(result: Column, *inputs: Column | str) -> Column:
    given = F.lit(True)
    for value in inputs:
        given = given & _column(value).isNotNull()
    return F.when(given, result)


def edges_contain(edges: Column | str, x: Column | str, y: Column | str) -> Column:
    """Interior test by even-odd rule over all edges; the boundary is outside."""
    return _known(_odd_crossings(edges, x, y) & ~on_boundary(edges, x, y), edges, x, y)


def edges_touch(edges: Column | str, x: Column | str, y: Column | str) -> Column:
    """Interior or boundary."""
    return _known(_odd_crossings(edges, x, y) | on_boundary(edges, x, y), edges, x, y)


def st_contains(polygon_wkt: Column | str, point: Column | str) -> Column:
    p = _column(point)
    return let(st_edges(st_rings(polygon_wkt)), lambda e: edges_contain(e, p["x"], p["y"]))


def st_within(point: Column | str, polygon_wkt: Column | str) -> Column:
    return st_contains(polygon_wkt, point)


def st_intersects_point(polygon_wkt: Column | str, point: Column | str) -> Column:
    p = _column(point)
    return let(st_edges(st_rings(polygon_wkt)), lambda e: edges_touch(e, p["x"], p["y"]))


def _side(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> Column:
    return F.signum((bx - ax) * (py - ay) - (by - ay) * (px - ax))


def segments_meet(a: Column, b: Column) -> Column:
    """Whether two closed segments share at least one point."""
    boxes = ((F.least(a["x1"], a["x2"]) <= F.greatest(b["x1"], b["x2"]))
             & (F.least(b["x1"], b["x2"]) <= F.greatest(a["x1"], a["x2"]))
             & (F.least(a["y1"], a["y2"]) <= F.greatest(b["y1"], b["y2"]))
             & (F.least(b["y1"], b["y2"]) <= F.greatest(a["y1"], a["y2"])))
    b_across_a = (_side(a["x1"], a["y1"], a["x2"], a["y2"], b["x1"], b["y1"])
                  * _side(a["x1"], a["y1"], a["x2"], a["y2"], b["x2"], b["y2"])) <= 0
    a_across_b = (_side(b["x1"], b["y1"], b["x2"], b["y2"], a["x1"], a["y1"])
                  * _side(b["x1"], b["y1"], b["x2"], b["y2"], a["x2"], a["y2"])) <= 0
    return boxes & b_across_a & a_across_b


def part_starts(rings: Column | str) -> Column:
    """One vertex of every part (the first point of each exterior ring)."""
    return F.transform(F.filter(_column(rings), lambda r: r["exterior"]),
                       lambda r: F.element_at(r["points"], 1))


def polygons_meet(edges_a: Column, starts_a: Column, edges_b: Column, starts_b: Column) -> Column:
    """Polygon/polygon intersection: boundaries meet, or one holds a part of the other."""
    return (F.exists(edges_a, lambda a: F.exists(edges_b, lambda b: segments_meet(a, b)))
            | F.exists(starts_a, lambda p: _odd_crossings(edges_b, p["x"], p["y"]))
            | F.exists(starts_b, lambda p: _odd_crossings(edges_a, p["x"], p["y"])))


# ---------------------------------------------------------------- measures

def st_distance_planar(a: Column | str, b: Column | str) -> Column:
    """Euclidean distance of two points in coordinate units (degrees for lon/lat)."""
    a, b = _column(a), _column(b)
    return F.sqrt(F.pow(a["x"] - b["x"], F.lit(2.0)) + F.pow(a["y"] - b["y"], F.lit(2.0)))


def _edge_gap(e: Column, x: Column, y: Column) -> Column:
    """Squared distance of a point from a segment: from the foot of the perpendicular, or the nearer end."""
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    length = dx * dx + dy * dy
    at = F.when(length == 0, F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - e["x1"]) * dx + (y - e["y1"]) * dy) / length)))
    gx, gy = x - (e["x1"] + at * dx), y - (e["y1"] + at * dy)
    return gx * gx + gy * gy


def edges_distance(edges: Column | str, x: Column | str, y: Column | str) -> Column:
    """Planar distance of a point from a polygon; 0 inside and on the boundary, null for an empty polygon."""
    e, x, y = _column(edges), _column(x), _column(y)
    nearest = F.sqrt(F.array_min(F.transform(e, lambda s: _edge_gap(s, x, y))))
    return F.when(edges_touch(e, x, y), F.when(F.size(e) > 0, F.lit(0.0))).otherwise(nearest)


def polygons_distance(edges_a: Column, starts_a: Column, edges_b: Column, starts_b: Column) -> Column:
    """Planar distance of two polygons: 0 where they meet, else the least from a corner of one to an edge of the other."""
    def corners(own: Column, other: Column) -> Column:
        return F.array_min(F.transform(own, lambda p: F.array_min(F.transform(other, lambda e: _edge_gap(e, p["x1"], p["y1"])))))

    apart = F.sqrt(F.least(corners(edges_a, edges_b), corners(edges_b, edges_a)))
    return F.when(polygons_meet(edges_a, starts_a, edges_b, starts_b), F.lit(0.0)).otherwise(apart)


def st_distance_polygon(polygon_wkt: Column | str, point: Column | str) -> Column:
    """Planar distance of a point from POLYGON / MULTIPOLYGON text."""
    p = _column(point)
    return let(st_edges(st_rings(polygon_wkt)), lambda e: edges_distance(e, p["x"], p["y"]))


def st_distance_polygons(a_wkt: Column | str, b_wkt: Column | str) -> Column:
    """Planar distance of two polygons given as text."""
    return let(st_rings(a_wkt), lambda a: let(st_rings(b_wkt), lambda b: polygons_distance(
        st_edges(a), part_starts(a), st_edges(b), part_starts(b))))


def sphere_distance(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance in metres (haversine)."""
    h = (F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2.0))
         + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2))
         * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2.0)))
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def st_distance_sphere(a: Column | str, b: Column | str) -> Column:
    a, b = _column(a), _column(b)
    return sphere_distance(a["x"], a["y"], b["x"], b["y"])


def _ring_moments(ring: Column) -> Column:
    """Twice the signed area and the first moments, relative to the first point."""
    def moments(p: Column) -> Column:
        origin = F.element_at(p, 1)
        n = F.size(p) - 1
        terms = F.zip_with(
            F.slice(p, 1, n), F.slice(p, 2, n),
            lambda a, b: F.struct(
                (a["x"] - origin["x"]).alias("ax"), (a["y"] - origin["y"]).alias("ay"),
                (b["x"] - origin["x"]).alias("bx"), (b["y"] - origin["y"]).alias("by")))
        total = F.aggregate(
            terms,
            F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my")),
            lambda s, t: let(t["ax"] * t["by"] - t["bx"] * t["ay"], lambda c: F.struct(
                (s["a"] + c).alias("a"),
                (s["mx"] + (t["ax"] + t["bx"]) * c).alias("mx"),
                (s["my"] + (t["ay"] + t["by"]) * c).alias("my"))))
        # the sign follows the role of the ring, not its drawing direction
        return let(total, lambda s: let(
            F.signum(s["a"]) * F.when(ring["exterior"], 1.0).otherwise(-1.0),
            lambda sign: F.struct(
                (sign * s["a"] / 2).alias("area"),
                (sign * (s["mx"] / 6 + origin["x"] * s["a"] / 2)).alias("mx"),
                (sign * (s["my"] / 6 + origin["y"] * s["a"] / 2)).alias("my"))))

    return let(ring["points"], moments)


def _sum_field(parts: Column, field: str) -> Column:
    return F.aggregate(parts, F.lit(0.0), lambda s, p: s + p[field])


def rings_area(rings: Column | str) -> Column:
    return _sum_field(F.transform(_column(rings), _ring_moments), "area")


def rings_centroid(rings: Column | str) -> Column:
    """Area-weighted centroid point; null for zero area."""
    def centroid(parts: Column) -> Column:
        return let(_sum_field(parts, "area"), lambda area: F.when(
            area != 0, F.struct((_sum_field(parts, "mx") / area).alias("x"),
                                (_sum_field(parts, "my") / area).alias("y"))))

    return let(F.transform(_column(rings), _ring_moments), centroid)


def st_area(wkt: Column | str) -> Column:
    return rings_area(st_rings(wkt))


def st_centroid(wkt: Column | str) -> Column:
    return rings_centroid(st_rings(wkt))


def st_buffer(point: Column | str, radius: float, sides: int = 16, digits: int = 6) -> Column:
    """Regular polygon with ``sides`` corners on the circle round a point, as WKT."""
    p = _column(point)

    def corner(i: Column) -> Column:
        angle = (i % sides).cast("double") * (2 * math.pi / sides)
        return F.concat(
            number_text(F.round(p["x"] + radius * F.cos(angle), digits)), F.lit(" "),
            number_text(F.round(p["y"] + radius * F.sin(angle), digits)))

    ring = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(sides)), corner), ",")
    return F.concat(F.lit("POLYGON(("), ring, F.lit("))"))
