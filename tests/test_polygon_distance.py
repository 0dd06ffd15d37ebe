"""Distances from and between polygons, and nearest polygons, against plain loops."""

import math

import numpy as np
import pytest

from strataseek.functions import geo
from strataseek.functions.sql import register_sql_functions
from strataseek.operators import nearest_polygons as module
from strataseek.operators.nearest_polygons import nearest_polygons

SQUARE = "POLYGON((0 0,4 0,4 4,0 4,0 0))"
HOLED = "POLYGON((0 0,10 0,10 10,0 10,0 0),(2 2,8 2,8 8,2 8,2 2))"
TWO = "MULTIPOLYGON(((0 0,1 0,1 1,0 1,0 0)),((5 5,6 5,6 7,5 5)))"


@pytest.mark.parametrize("polygon, x, y, expected", [
    (SQUARE, 2, 2, 0), (SQUARE, 4, 2, 0), (SQUARE, 7, 8, 5), (SQUARE, 2, -3, 3), (HOLED, 5, 5, 3), (HOLED, 3, 5, 1),
    (HOLED, 1, 1, 0), (TWO, 3, 1, 2), (TWO, 5.2, 5.1, 0), ("POLYGON EMPTY", 1, 1, None), ("nonsense", 1, 1, None), (None, 1, 1, None)])
def test_point_to_polygon(spark, polygon, x, y, expected):
    register_sql_functions(spark)
    row = spark.createDataFrame([(polygon, f"POINT({x} {y})")], "polygon string, point string").select(
        geo.st_distance_polygon("polygon", geo.st_point_from_text("point")).alias("d")).first()
    told = spark.sql("SELECT st_distance_polygon(:p, :q) AS d", args={"p": polygon, "q": f"POINT({x} {y})"}).first()
    for value in (row.d, told.d):
        assert value is None if expected is None else value == pytest.approx(expected, abs=1e-12)


@pytest.mark.parametrize("a, b, expected", [
    (SQUARE, "POLYGON((7 8,9 8,9 9,7 8))", 5), (SQUARE, "POLYGON((1 1,2 1,2 2,1 1))", 0), (HOLED, "POLYGON((4 4,6 4,6 6,4 4))", 2),
    (SQUARE, "POLYGON((4 4,5 4,5 5,4 4))", 0), (TWO, "POLYGON((3 0,4 0,4 1,3 0))", 2), (SQUARE, None, None)])
def test_polygon_to_polygon(spark, a, b, expected):
    rows = spark.createDataFrame([(a, b), (b, a)], "a string, b string").select(geo.st_distance_polygons("a", "b").alias("d")).collect()
    assert all(r.d is None if expected is None else r.d == pytest.approx(expected, abs=1e-12) for r in rows)


def box_gap(box, x, y):
    return math.hypot(max(box[0] - x, 0, x - box[2]), max(box[1] - y, 0, y - box[3]))


@pytest.mark.parametrize("k", [1, 4, 60])
def test_nearest(spark, k):
    random = np.random.default_rng(2)
    boxes = {f"p{i:02d}": (x, y, x + w, y + h) for i, (x, y, w, h) in enumerate(zip(
        random.uniform(0, 100, 50), random.uniform(0, 60, 50), random.uniform(0.1, 9, 50), random.uniform(0.1, 6, 50)))}
    boxes["far"] = (900.0, 900.0, 901.0, 902.0)
    places = {i: (float(x), float(y)) for i, (x, y) in enumerate(random.uniform(-20, 120, (120, 2)))}
    places |= {200 + i: (50.0, 30.0) for i in range(60)}  # a third of the points in one place
    places[999] = (5000.0, -4000.0)
    shapes = [(n, f"POLYGON(({a} {b},{c} {b},{c} {d},{a} {d},{a} {b}))") for n, (a, b, c, d) in boxes.items()] + [("bad", "POLYGON((1"), ("none", None)]
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in places.items()] + [(7000, None, 1.0)], "id long, longitude double, latitude double")
    found = nearest_polygons(points, spark.createDataFrame(shapes, "name string, geometry_wkt string"), k, "id", "name")
    got = {}
    for r in found.orderBy("id", "rank").collect():
        got.setdefault(r.id, []).append((r.distance, r.name))
    assert set(got) == set(places)
    for i, (x, y) in places.items():
        want = sorted((round(box_gap(b, x, y), module.DECIMALS), n) for n, b in boxes.items())[:k]
        assert [n for _, n in got[i]] == [n for _, n in want]
        assert [d for d, _ in got[i]] == pytest.approx([d for d, _ in want], abs=1e-8)


def test_nearest_of_nothing(spark):
    points = spark.createDataFrame([(1, 1.0, 1.0)], "id long, longitude double, latitude double")
    shapes = spark.createDataFrame([("a", SQUARE)], "name string, geometry_wkt string")
    assert nearest_polygons(points, shapes.limit(0), 2, "id", "name").count() == 0
    assert nearest_polygons(points.limit(0), shapes, 2, "id", "name").count() == 0
