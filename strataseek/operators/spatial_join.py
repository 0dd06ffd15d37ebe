"""Point-in-polygon, within-distance and polygon/polygon joins as grid equi-joins.

A theta join on a geometry predicate would compare every pair. Here both sides
get integer grid cells, Spark joins on the cell, and the exact test runs only on
rows that share one.

Polygons are indexed at a grid level that fits their own bounding box (cell size
``4 ** level``), so each one covers a bounded number of cells whatever its size.
A cell row keeps only the edges that can cross a ray cast from inside the cell,
and a cell that lies wholly inside the polygon keeps none and needs no test.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataseek.functions import geo
from strataseek.operators.skew import balanced_join
from strataseek.session import BROADCAST_LIMIT_BYTES, cut_lineage, has_work_folder

# The longer box side of a polygon spans at least this many cells of its level and at most
# four times as many. Few or simple polygons get a finer grid, within a budget of cells
# and stored edges for the whole index: fewer points then need the exact test.
_COARSEST = 2
_FINEST = 8
_CELL_BUDGET = 100_000
_EDGE_BUDGET = 400_000
_SMALLEST_SIDE = 1e-7

POLYGON_KEY = "polygon_id"


def _cell(value: Column, size: Column) -> Column:
    return F.floor(value / size).cast("bigint")


def _cell_size(level: Column) -> Column:
    return F.pow(F.lit(4.0), level.cast("double"))


def cells_per_side(polygons: DataFrame, wkt: str) -> float:
    """Grid fineness for a polygon set, from its row count and number of vertices."""
    commas = F.length(wkt) - F.length(F.replace(F.col(wkt), F.lit(",")))
    n, vertices = polygons.agg(F.count(wkt), F.sum(commas + 1)).first()
    if not n:
        return _COARSEST
    fine = min((_CELL_BUDGET / n) ** 0.5 / 4, _EDGE_BUDGET / vertices)
    return max(_COARSEST, min(_FINEST, fine))


def with_geometry(polygons: DataFrame, wkt: str, rings: str = "__rings",
                  per_side: float = _COARSEST) -> DataFrame:
    """Parse WKT once and add rings, edges, box and grid level; bad text gives nulls."""
    side = F.greatest(F.col("__box.max_x") - F.col("__box.min_x"),
                      F.col("__box.max_y") - F.col("__box.min_y"), F.lit(_SMALLEST_SIDE))
    return (polygons.withColumn(rings, geo.st_rings(wkt))
            .withColumn("__edges", geo.st_edges(rings))
            .withColumn("__box", geo.st_box(rings))
            .withColumn("__level", F.floor(
                F.log(4.0, side / per_side)).cast("int")))


def _cover(box: str, size: Column) -> Column:
    """All cells of one level that a box touches."""
    xs = F.sequence(_cell(F.col(f"{box}.min_x"), size), _cell(F.col(f"{box}.max_x"), size))
    ys = F.sequence(_cell(F.col(f"{box}.min_y"), size), _cell(F.col(f"{box}.max_y"), size))
    return F.flatten(F.transform(xs, lambda x: F.transform(
        ys, lambda y: F.struct(x.alias("cx"), y.alias("cy")))))


def polygon_cells(polygons: DataFrame, wkt: str, keys: list[str],
                  per_side: float = _COARSEST) -> DataFrame:
    """Grid index of polygons: ``keys, level, cx, cy, inside, edges``.

    ``inside`` marks cells that the polygon covers completely. Cells that the box
    covers but the polygon does not touch are left out.
    """
    size = _cell_size(F.col("__level"))
    cells = (with_geometry(polygons, wkt, per_side=per_side)
             .filter(F.size("__edges") > 0)
             .select(*keys, F.col("__level").alias("level"), "__edges",
                     size.alias("__size"), F.explode(_cover("__box", size)).alias("__c"))
             .select(*keys, "level", "__edges", F.col("__c.cx").alias("cx"),
                     F.col("__c.cy").alias("cy"),
                     (F.col("__c.cx") * F.col("__size")).alias("__x0"),
                     (F.col("__c.cy") * F.col("__size")).alias("__y0"),
                     ((F.col("__c.cx") + 1) * F.col("__size")).alias("__x1"),
                     ((F.col("__c.cy") + 1) * F.col("__size")).alias("__y1")))
    x0, y0, x1, y1 = (F.col(c) for c in ("__x0", "__y0", "__x1", "__y1"))
    # a ray to the right can only meet edges of the cell's own row, not left of the cell
    in_row = F.filter("__edges", lambda e: (
        (F.greatest(e["y1"], e["y2"]) >= y0) & (F.least(e["y1"], e["y2"]) <= y1)
        & (F.greatest(e["x1"], e["x2"]) >= x0)))
    crossed = F.exists("__near", lambda e: F.least(e["x1"], e["x2"]) <= x1)
    centre = geo.edges_contain("__near", (x0 + x1) / 2, (y0 + y1) / 2)
    return (cells.withColumn("__near", in_row)
            .withColumn("__crossed", crossed)
            .withColumn("inside", ~F.col("__crossed") & centre)
            .filter(F.col("__crossed") | F.col("inside"))
            .select(*keys, "level", "cx", "cy", "inside",
                    F.when(F.col("inside"), F.slice("__near", 1, 0))
                    .otherwise(F.col("__near")).alias("edges")))


def _point_cells(points: DataFrame, lon: str, lat: str, levels: list[int]) -> DataFrame:
    """One row per point and grid level in use (the levels are few by construction)."""
    spots = F.array(*[F.struct(
        F.lit(level).alias("level"),
        F.floor(F.col(lon) / 4.0 ** level).cast("bigint").alias("cx"),
        F.floor(F.col(lat) / 4.0 ** level).cast("bigint").alias("cy")) for level in levels])
    known = points.filter(F.col(lon).isNotNull() & F.col(lat).isNotNull())
    if len(levels) == 1:
        return known.select("*", spots[0]["level"].alias("level"),
                            spots[0]["cx"].alias("cx"), spots[0]["cy"].alias("cy"))
    return known.select("*", F.inline(spots))


def point_in_polygon_join(points: DataFrame, polygons: DataFrame, wkt: str, keys: list[str],
                          lon: str = "longitude", lat: str = "latitude",
                          boundary: bool = False, tasks: int = 1000,
                          broadcast_limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Inner join: every (point, polygon) pair where the polygon contains the point.

    Returns the point columns plus the polygon ``keys``. Points on a boundary are
    matched only with ``boundary=True``. Polygons with unparseable text never match.
    A point lies in exactly one cell per level and a polygon has one level, so no
    pair appears twice. The polygon index is written once to the shared folder (when one
    is set), so its size is known and no polygon is parsed twice.
    """
    cells = polygon_cells(polygons, wkt, keys, cells_per_side(polygons, wkt))
    if has_work_folder(cells.sparkSession):
        cells = cut_lineage(cells, "polygon-cells")
    size = cells.agg(F.collect_set("level"), F.sum(F.lit(128) + F.size("edges") * 48)).first()
    levels, cell_bytes = sorted(size[0]), size[1]
    if not levels:
        types = dict(polygons.dtypes)
        return points.filter(F.lit(False)).select(
            "*", *[F.lit(None).cast(types[k]).alias(k) for k in keys])
    test = geo.edges_touch if boundary else geo.edges_contain
    joined = balanced_join(_point_cells(points, lon, lat, levels), cells,
                           ["level", "cx", "cy"], [lon, lat, *points.columns[:1]],
                           cell_bytes, tasks=tasks, broadcast_limit=broadcast_limit)
    return (joined.filter(F.col("inside") | test("edges", lon, lat))
            .drop("level", "cx", "cy", "inside", "edges"))


def polygon_left_join(points: DataFrame, polygons: DataFrame, wkt: str, keys: list[str],
                      **join_options) -> DataFrame:
    """Spatial LEFT join: all matches, and one row without point for every other polygon.

    A plain left join would shuffle the matches by polygon, so a polygon with a third of
    the points would overload one task. Here the matches stay where they were found and
    only the distinct keys of matched polygons are exchanged. ``keys`` must identify a
    polygon.
    """
    matches = point_in_polygon_join(points, polygons, wkt, keys, **join_options)
    if has_work_folder(matches.sparkSession):  # read twice below, computed once
        matches = cut_lineage(matches, "polygon-matches")
    matched = matches.select(*keys).distinct()
    missing = polygons.select(*keys).join(
        matched, [polygons[k].eqNullSafe(matched[k]) for k in keys], "left_anti")
    return matches.unionByName(missing, allowMissingColumns=True)


def with_polygon_id(polygons: DataFrame, columns: list[str]) -> DataFrame:
    """Narrow key standing for all attribute columns (used in place of grouping by WKT)."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns]
    return polygons.withColumn(POLYGON_KEY, F.md5(F.concat_ws("\x1f", *parts)))


def points_per_polygon(points: DataFrame, polygons: DataFrame, wkt: str, group: list[str],
                       aggregates: list[Column], zero: list[str] = (),
                       inner: bool = False, **join_options) -> DataFrame:
    """Spatial LEFT join followed by a grouping on polygon attributes.

    Matches are aggregated by a narrow polygon key first, with Spark's map-side
    partial aggregation, and the wide attributes (WKT included) are joined after.
    Polygons without points are kept with 0 in the ``zero`` columns unless ``inner``.
    """
    keyed = with_polygon_id(polygons, group)
    matches = point_in_polygon_join(points, keyed, wkt, [POLYGON_KEY], **join_options)
    summary = matches.groupBy(POLYGON_KEY).agg(*aggregates)
    attributes = keyed.select(POLYGON_KEY, *group).dropDuplicates([POLYGON_KEY])
    result = attributes.join(summary, POLYGON_KEY, "inner" if inner else "left")
    return result.fillna(0, subset=list(zero)).drop(POLYGON_KEY)


# ---------------------------------------------------------------- within distance

def _unit_sphere_cell(lon: Column, lat: Column, chord: float) -> list[Column]:
    x = F.cos(F.radians(lat)) * F.cos(F.radians(lon))
    y = F.cos(F.radians(lat)) * F.sin(F.radians(lon))
    z = F.sin(F.radians(lat))
    return [F.floor(v / chord).cast("int") for v in (x, y, z)]


def within_distance_join(points: DataFrame, centres: DataFrame, radius_m: float,
                         centre_keys: list[str], lon: str = "longitude", lat: str = "latitude",
                         centre_lon: str = "centroid_lon", centre_lat: str = "centroid_lat",
                         tasks: int = 1000,
                         broadcast_limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Inner join of points and centres at most ``radius_m`` apart on the sphere.

    Cells are cubes round the unit sphere whose side is the chord of the radius, so
    a match lies in the cell of the centre or one of its 26 neighbours; poles and
    the date line need no special case.
    """
    angle = min(radius_m / geo.EARTH_RADIUS_M, math.pi)
    chord = max(2 * math.sin(angle / 2) * (1 + 1e-9), 1e-9)
    px, py, pz = _unit_sphere_cell(F.col(lon), F.col(lat), chord)
    cx, cy, cz = _unit_sphere_cell(F.col(centre_lon), F.col(centre_lat), chord)
    near = F.sequence(F.lit(-1), F.lit(1))
    spots = F.flatten(F.flatten(F.transform(near, lambda i: F.transform(
        near, lambda j: F.transform(near, lambda k: F.struct(
            (cx + i).alias("gx"), (cy + j).alias("gy"), (cz + k).alias("gz")))))))
    left = (points.filter(F.col(lon).isNotNull() & F.col(lat).isNotNull())
            .withColumns({"gx": px, "gy": py, "gz": pz}))
    right = (centres.filter(F.col(centre_lon).isNotNull() & F.col(centre_lat).isNotNull())
             .select(*centre_keys, F.col(centre_lon).alias("__clon"),
                     F.col(centre_lat).alias("__clat"), F.inline(spots)))
    metres = geo.sphere_distance(F.col(lon), F.col(lat), F.col("__clon"), F.col("__clat"))
    joined = balanced_join(left, right, ["gx", "gy", "gz"], [lon, lat, *points.columns[:1]],
                           F.lit(64 + 32 * len(centre_keys)), tasks=tasks,
                           broadcast_limit=broadcast_limit)
    return (joined.withColumn("distance_m", metres)
            .filter(F.col("distance_m") <= radius_m)
            .drop("gx", "gy", "gz", "__clon", "__clat"))


# ---------------------------------------------------------------- polygon / polygon

def _polygon_cover(polygons: DataFrame, wkt: str, key: str, levels: list[int],
                   prefix: str) -> DataFrame:
    """Cells of a polygon at its own level and at every coarser level in use."""
    known = with_geometry(polygons, wkt).filter(F.size("__edges") > 0)
    at_levels = known.select(
        F.col(key).alias(f"{prefix}_key"), "__edges", "__box", "__level",
        geo.part_starts("__rings").alias("__starts"),
        F.explode(F.array(*[F.lit(v) for v in levels])).alias("level")) \
        .filter(F.col("level") >= F.col("__level"))
    return at_levels.select(
        f"{prefix}_key", F.col("__edges").alias(f"{prefix}_edges"),
        F.col("__box").alias(f"{prefix}_box"), F.col("__level").alias(f"{prefix}_level"),
        F.col("__starts").alias(f"{prefix}_starts"), "level",
        F.inline(_cover("__box", _cell_size(F.col("level")))))


def polygon_intersects_join(a: DataFrame, b: DataFrame, a_wkt: str, b_wkt: str,
                            a_key: str, b_key: str, tasks: int = 1000,
                            broadcast_limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Pairs ``(a_key, b_key)`` of polygons that share at least one point.

    Two polygons meet at the coarser of their two levels. A pair is tested only in
    the cell that holds the lower left corner of the overlap of their boxes, so it
    comes out once without a distinct.
    """
    levels = sorted({r[0] for df, w in ((a, a_wkt), (b, b_wkt))
                     for r in with_geometry(df, w).select("__level")
                     .filter("__level is not null").distinct().collect()})
    if not levels:
        return a.filter(F.lit(False)).select(
            a_key, F.lit(None).cast(dict(b.dtypes)[b_key]).alias(b_key))
    left = _polygon_cover(a, a_wkt, a_key, levels, "a")
    right = _polygon_cover(b, b_wkt, b_key, levels, "b")
    bytes_right = F.lit(256) + F.size("b_edges") * 48
    joined = balanced_join(left, right, ["level", "cx", "cy"], ["a_key"], bytes_right,
                           tasks=tasks, broadcast_limit=broadcast_limit)
    size = _cell_size(F.col("level"))
    low_x = F.greatest("a_box.min_x", "b_box.min_x")
    low_y = F.greatest("a_box.min_y", "b_box.min_y")
    first_cell = (
        (F.col("level") == F.greatest("a_level", "b_level"))
        & (low_x <= F.least("a_box.max_x", "b_box.max_x"))
        & (low_y <= F.least("a_box.max_y", "b_box.max_y"))
        & (_cell(low_x, size) == F.col("cx")) & (_cell(low_y, size) == F.col("cy")))
    meet = geo.polygons_meet(F.col("a_edges"), F.col("a_starts"),
                             F.col("b_edges"), F.col("b_starts"))
    return (joined.filter(first_cell).filter(meet)
            .select(F.col("a_key").alias(a_key), F.col("b_key").alias(b_key)))
