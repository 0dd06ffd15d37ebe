"""Geometry functions for SQL text, as temporary SQL functions.

In SQL a geometry is its WKT text, so stored columns can be passed as they are. The
functions are plain SQL expressions, run in the JVM, and give the same values as the
Column functions of :mod:`strataseek.functions.geo`. For joins of large tables use
:mod:`strataseek.operators.spatial_join`: a predicate alone cannot be joined by hash.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from strataseek.functions.geo import EARTH_RADIUS_M

_POINT = "STRUCT<x: DOUBLE, y: DOUBLE>"
_RINGS = f"ARRAY<STRUCT<exterior: BOOLEAN, points: ARRAY<{_POINT}>>>"
_EDGES = "ARRAY<STRUCT<x1: DOUBLE, y1: DOUBLE, x2: DOUBLE, y2: DOUBLE>>"
_N = r"[-+]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][-+]?[0-9]+)?"

# name, parameters, result type, body
_FUNCTIONS: list[tuple[str, str, str, str]] = [
    ("geo_number_text", "v DOUBLE", "STRING",
     "CASE WHEN contains(CAST(v + 0D AS STRING), 'E') "
     r"THEN regexp_replace(CAST(CAST(v AS DECIMAL(38,18)) AS STRING), '\\.?0+$', '') "
     r"ELSE regexp_replace(CAST(v + 0D AS STRING), '\\.0$', '') END"),
    ("st_point", "x DOUBLE, y DOUBLE", "STRING",
     "concat('POINT(', geo_number_text(x), ' ', geo_number_text(y), ')')"),
    ("geo_point", "wkt STRING", _POINT,
     rf"CASE WHEN wkt RLIKE '(?i)^\\s*POINT\\s*\\(\\s*{_N}\\s+{_N}\\s*\\)\\s*$' THEN named_struct("
     r"'x', CAST(regexp_extract(wkt, '\\(\\s*(\\S+)\\s', 1) AS DOUBLE), "
     r"'y', CAST(regexp_extract(wkt, '\\s([^\\s)]+)\\s*\\)', 1) AS DOUBLE)) END"),
    ("st_x", "point STRING", "DOUBLE", "geo_point(point).x"),
    ("st_y", "point STRING", "DOUBLE", "geo_point(point).y"),
    ("geo_tidy", "wkt STRING", "STRING",
     r"regexp_replace(upper(trim(regexp_replace(wkt, '\\s+', ' '))), ' ?([(),]) ?', '$1')"),
    ("geo_shaped", "wkt STRING", "BOOLEAN",
     r"regexp_replace(wkt, '\\([^()]*\\)', '#') RLIKE '^(POLYGON( ?Z)?\\(#(?:,#)*+\\)|"
     r"MULTIPOLYGON( ?Z)?\\(\\(#(?:,#)*+\\)(?:,\\(#(?:,#)*+\\))*+\\))$' AND "
     r"forall(regexp_extract_all(wkt, '\\(([^()]*)\\)', 1), b -> forall(split(b, ','), "
     rf"c -> c RLIKE '^{_N} {_N}( {_N})*$'))"),
    ("geo_ring_list", "wkt STRING", _RINGS,
     r"CASE WHEN wkt RLIKE '^(MULTI)?POLYGON( ?Z)? EMPTY$' THEN array() "
     r"WHEN geo_shaped(wkt) THEN zip_with("
     r"regexp_extract_all(wkt, '(\\(*)\\(([^()]*)\\)', 1), "
     r"regexp_extract_all(wkt, '(\\(*)\\(([^()]*)\\)', 2), (open, body) -> named_struct("
     "'exterior', length(open) > 0, 'points', transform(split(body, ','), c -> named_struct("
     "'x', CAST(split(c, ' ')[0] AS DOUBLE), 'y', CAST(split(c, ' ')[1] AS DOUBLE))))) END"),
    # what a function uses twice is a parameter of a helper, which Spark evaluates once
    ("geo_closed", f"rings {_RINGS}", _RINGS,
     "CASE WHEN forall(rings, r -> size(r.points) >= 4 AND "
     "element_at(r.points, 1) = element_at(r.points, -1)) THEN rings END"),
    ("geo_rings", "wkt STRING", _RINGS, "geo_closed(geo_ring_list(geo_tidy(wkt)))"),
    ("geo_edges", f"rings {_RINGS}", _EDGES,
     "flatten(transform(rings, r -> zip_with(slice(r.points, 1, size(r.points) - 1), "
     "slice(r.points, 2, size(r.points) - 1), (a, b) -> "
     "named_struct('x1', a.x, 'y1', a.y, 'x2', b.x, 'y2', b.y))))"),
    ("geo_odd", f"edges {_EDGES}, p {_POINT}", "BOOLEAN",
     "size(filter(edges, e -> (e.y1 > p.y) != (e.y2 > p.y) AND "
     "p.x < (e.x2 - e.x1) * (p.y - e.y1) / (e.y2 - e.y1) + e.x1)) % 2 = 1"),
    ("geo_on_edge", f"edges {_EDGES}, p {_POINT}", "BOOLEAN",
     "exists(edges, e -> p.x BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2) AND "
     "p.y BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2) AND "
     "(e.x2 - e.x1) * (p.y - e.y1) = (e.y2 - e.y1) * (p.x - e.x1))"),
    ("geo_moments", f"rings {_RINGS}", "ARRAY<STRUCT<a: DOUBLE, mx: DOUBLE, my: DOUBLE>>",
     "transform(transform(rings, r -> named_struct('role', IF(r.exterior, 1D, -1D), 's', "
     "aggregate(zip_with(slice(r.points, 1, size(r.points) - 1), "
     "slice(r.points, 2, size(r.points) - 1), (p, q) -> named_struct("
     "'c', (p.x - r.points[0].x) * (q.y - r.points[0].y) "
     "- (q.x - r.points[0].x) * (p.y - r.points[0].y), "
     "'x', p.x + q.x - 2 * r.points[0].x, 'y', p.y + q.y - 2 * r.points[0].y)), "
     "named_struct('a', 0D, 'mx', 0D, 'my', 0D), (s, t) -> named_struct("
     "'a', s.a + t.c, 'mx', s.mx + t.x * t.c, 'my', s.my + t.y * t.c)), "
     "'o', r.points[0])), m -> named_struct('a', m.role * signum(m.s.a) * m.s.a / 2, "
     "'mx', m.role * signum(m.s.a) * (m.s.mx / 6 + m.o.x * m.s.a / 2), "
     "'my', m.role * signum(m.s.a) * (m.s.my / 6 + m.o.y * m.s.a / 2)))"),
    ("geo_total", "parts ARRAY<STRUCT<a: DOUBLE, mx: DOUBLE, my: DOUBLE>>",
     "STRUCT<a: DOUBLE, mx: DOUBLE, my: DOUBLE>",
     "aggregate(parts, named_struct('a', 0D, 'mx', 0D, 'my', 0D), (s, t) -> named_struct("
     "'a', s.a + t.a, 'mx', s.mx + t.mx, 'my', s.my + t.my))"),
    ("geo_centre", "t STRUCT<a: DOUBLE, mx: DOUBLE, my: DOUBLE>", "STRING",
     "CASE WHEN t.a != 0 THEN st_point(t.mx / t.a, t.my / t.a) END"),
    ("st_geomfromtext", "wkt STRING", "STRING",
     "CASE WHEN geo_point(wkt) IS NOT NULL THEN st_point(geo_point(wkt).x, geo_point(wkt).y) "
     "WHEN geo_rings(wkt) IS NOT NULL THEN geo_tidy(wkt) END"),
    ("st_geomfromwkt", "wkt STRING", "STRING", "st_geomfromtext(wkt)"),
    ("try_to_geometry", "wkt STRING", "STRING", "st_geomfromtext(wkt)"),
    ("st_geogfromtext", "wkt STRING", "STRING",
     "CASE WHEN st_x(wkt) BETWEEN -180 AND 180 AND st_y(wkt) BETWEEN -90 AND 90 "
     "THEN st_point(st_x(wkt), st_y(wkt)) END"),
    ("st_astext", "geometry STRING", "STRING", "geometry"),
    ("st_aswkt", "geometry STRING", "STRING", "geometry"),
    ("st_area", "geometry STRING", "DOUBLE", "geo_total(geo_moments(geo_rings(geometry))).a"),
    ("st_centroid", "geometry STRING", "STRING",
     "geo_centre(geo_total(geo_moments(geo_rings(geometry))))"),
    ("geo_inside", f"edges {_EDGES}, p {_POINT}", "BOOLEAN", "geo_odd(edges, p) AND NOT geo_on_edge(edges, p)"),
    ("geo_touch", f"edges {_EDGES}, p {_POINT}", "BOOLEAN", "geo_odd(edges, p) OR geo_on_edge(edges, p)"),
    ("st_contains", "polygon STRING, point STRING", "BOOLEAN",
     "geo_inside(geo_edges(geo_rings(polygon)), geo_point(point))"),
    ("st_within", "point STRING, polygon STRING", "BOOLEAN", "st_contains(polygon, point)"),
    ("st_intersects", "polygon STRING, point STRING", "BOOLEAN",
     "geo_touch(geo_edges(geo_rings(polygon)), geo_point(point))"),
    ("geo_apart", f"p {_POINT}, q {_POINT}", "DOUBLE", "sqrt(pow(p.x - q.x, 2) + pow(p.y - q.y, 2))"),
    ("st_distance", "a STRING, b STRING", "DOUBLE", "geo_apart(geo_point(a), geo_point(b))"),
    ("geo_gap", f"edges {_EDGES}, p {_POINT}", "DOUBLE",
     "sqrt(array_min(transform(transform(edges, e -> named_struct('e', e, 't', greatest(0D, least(1D, coalesce(try_divide("
     "(p.x - e.x1) * (e.x2 - e.x1) + (p.y - e.y1) * (e.y2 - e.y1), pow(e.x2 - e.x1, 2) + pow(e.y2 - e.y1, 2)), 0D))))), "
     "s -> pow(p.x - (s.e.x1 + s.t * (s.e.x2 - s.e.x1)), 2) + pow(p.y - (s.e.y1 + s.t * (s.e.y2 - s.e.y1)), 2))))"),
    ("geo_reach", f"edges {_EDGES}, p {_POINT}", "DOUBLE", "CASE WHEN geo_touch(edges, p) THEN 0D ELSE geo_gap(edges, p) END"),
    ("st_distance_polygon", "polygon STRING, point STRING", "DOUBLE",
     "geo_reach(geo_edges(geo_rings(polygon)), geo_point(point))"),
    ("st_distance_sphere", "a STRING, b STRING", "DOUBLE",
     f"{2 * EARTH_RADIUS_M}D * asin(least(1D, sqrt("
     "pow(sin(radians(st_y(b) - st_y(a)) / 2), 2) + cos(radians(st_y(a))) "
     "* cos(radians(st_y(b))) * pow(sin(radians(st_x(b) - st_x(a)) / 2), 2))))"),
]


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the functions in this session and return the names meant for users."""
    for name, parameters, result, body in _FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) "
                  f"RETURNS {result} RETURN {body}")
    return [name for name, *_ in _FUNCTIONS if not name.startswith("geo_")]
