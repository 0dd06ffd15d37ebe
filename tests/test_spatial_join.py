import math
import random

import pytest
from pyspark.sql import functions as F

from helpers import plan_of
from strataseek.functions import geo
from strataseek.operators.skew import balanced_join
from strataseek.operators.spatial_join import (point_in_polygon_join, points_per_polygon,
                                               polygon_intersects_join, within_distance_join)


def star(cx, cy, radius, corners, seed):
    rnd = random.Random(seed)
    pts = [(cx + math.cos(i * 2 * math.pi / corners) * radius * rnd.uniform(0.3, 1),
            cy + math.sin(i * 2 * math.pi / corners) * radius * rnd.uniform(0.3, 1))
           for i in range(corners)]
    pts.append(pts[0])
    return pts, "POLYGON((" + ",".join(f"{x} {y}" for x, y in pts) + "))"


def even_odd(ring, x, y):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            odd = not odd
    return odd


@pytest.fixture(scope="module")
def world(spark):
    """Polygons of very different sizes and points of which a third sit in one place."""
    rnd = random.Random(11)
    shapes = [star(rnd.uniform(-170, 170), rnd.uniform(-80, 80), 10 ** rnd.uniform(-2, 1.5),
                   rnd.choice([5, 30, 150]), i) for i in range(40)]
    shapes.append(star(10, 10, 8, 90, 99))
    points = [(i, rnd.uniform(-180, 180), rnd.uniform(-90, 90)) for i in range(1500)]
    points += [(i, *rnd.choice(shapes)[0][0]) for i in range(1500, 1600)]
    points += [(i, 10.0 + rnd.uniform(-9, 9), 10.0 + rnd.uniform(-9, 9))
               for i in range(1600, 2000)]
    points += [(i, 10.25, 10.125) for i in range(2000, 3000)]
    p = spark.createDataFrame(points, "id long, longitude double, latitude double")
    s = spark.createDataFrame([(f"p{i}", w) for i, (_, w) in enumerate(shapes)]
                              + [("bad", "POLYGON ((oops"), ("none", None)],
                              "name string, geometry string")
    truth = {(i, f"p{k}") for i, x, y in points for k, (ring, _) in enumerate(shapes)
             if even_odd(ring, x, y)}
    return p, s, truth, shapes, points


def on_a_corner(points, shapes):
    corners = {c for ring, _ in shapes for c in ring}
    return {i for i, x, y in points if (x, y) in corners}


@pytest.mark.parametrize("limit", [64 * 1024 * 1024, -1])
def test_point_in_polygon_equals_brute_force(world, limit):
    points, polygons, truth, shapes, rows = world
    joined = point_in_polygon_join(points, polygons, "geometry", ["name"],
                                   broadcast_limit=limit, tasks=8)
    found = [(r.id, r.name) for r in joined.collect()]
    skip = on_a_corner(rows, shapes)  # the boundary is outside by definition
    assert len(found) == len(set(found))
    assert {f for f in found if f[0] not in skip} == {t for t in truth if t[0] not in skip}
    plan = plan_of(joined)
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert ("BroadcastHashJoin" in plan) == (limit > 0) or limit < 0


def test_boundary_points_match_only_when_asked(spark):
    points = spark.createDataFrame([(1, 4.0, 2.0), (2, 2.0, 2.0), (3, 4.0, 4.0)],
                                   "id long, longitude double, latitude double")
    square = spark.createDataFrame([("a", "POLYGON((0 0,4 0,4 4,0 4,0 0))"),
                                    ("b", "POLYGON((4 0,8 0,8 4,4 4,4 0))")],
                                   "name string, geometry string")
    inner = point_in_polygon_join(points, square, "geometry", ["name"])
    touch = point_in_polygon_join(points, square, "geometry", ["name"], boundary=True)
    assert {(r.id, r.name) for r in inner.collect()} == {(2, "a")}
    assert {(r.id, r.name) for r in touch.collect()} == {
        (1, "a"), (1, "b"), (2, "a"), (3, "a"), (3, "b")}


def test_left_join_keeps_polygons_without_points(world):
    points, polygons, truth, *_ = world
    rows = points_per_polygon(points, polygons, "geometry", ["name", "geometry"],
                              [F.count("id").alias("n")], zero=["n"]).collect()
    assert len(rows) == 43
    assert {r.name for r in rows if r.n == 0} >= {"bad", "none"}


def test_no_valid_polygon_gives_no_rows(spark, world):
    bad = spark.createDataFrame([("x", "nothing")], "name string, geometry string")
    joined = point_in_polygon_join(world[0], bad, "geometry", ["name"])
    assert joined.count() == 0 and "name" in joined.columns


@pytest.mark.parametrize("radius, limit", [(50_000, 64 << 20), (3_000_000, 64 << 20),
                                           (3_000_000, -1)])
def test_within_distance_equals_brute_force(spark, radius, limit):
    rnd = random.Random(5)
    points = [(i, rnd.uniform(-180, 180), rnd.uniform(-90, 90)) for i in range(400)]
    points += [(400, 179.9, 0.0), (401, -179.9, 0.0), (402, 12.0, 89.99)]
    centres = [(f"c{i}", rnd.uniform(-180, 180), rnd.uniform(-90, 90)) for i in range(20)]
    centres += [("line", 180.0, 0.0), ("pole", -150.0, 89.95), ("null", None, 1.0)]

    def metres(a, b, c, d):
        h = (math.sin(math.radians(d - b) / 2) ** 2 + math.cos(math.radians(b))
             * math.cos(math.radians(d)) * math.sin(math.radians(c - a) / 2) ** 2)
        return 2 * geo.EARTH_RADIUS_M * math.asin(min(1, math.sqrt(h)))

    truth = {(i, n) for i, x, y in points for n, cx, cy in centres
             if cx is not None and metres(x, y, cx, cy) <= radius}
    joined = within_distance_join(
        spark.createDataFrame(points, "id long, longitude double, latitude double"),
        spark.createDataFrame(centres, "name string, centroid_lon double, centroid_lat double"),
        radius, ["name"], broadcast_limit=limit, tasks=8)
    found = [(r.id, r.name) for r in joined.collect()]
    assert len(found) == len(set(found)) and set(found) == truth
    assert "NestedLoop" not in plan_of(joined)


def test_polygon_pairs(spark):
    boxes = {"a": (0, 0, 10, 10), "b": (10, 10, 12, 12), "c": (2, 2, 3, 3), "d": (20, 0, 21, 1),
             "e": (-100, -60, 100, 60)}

    def wkt(x1, y1, x2, y2):
        return f"POLYGON(({x1} {y1},{x2} {y1},{x2} {y2},{x1} {y2},{x1} {y1}))"

    left = spark.createDataFrame([(n, wkt(*b)) for n, b in boxes.items()], "l string, w string")
    ring = "POLYGON((0 0,10 0,10 10,0 10,0 0),(1 1,9 1,9 9,1 9,1 1))"
    right = spark.createDataFrame([(n, wkt(*b)) for n, b in boxes.items()]
                                  + [("ring", ring)], "r string, w string")
    for limit in (64 << 20, -1):
        pairs = polygon_intersects_join(left, right, "w", "w", "l", "r", broadcast_limit=limit)
        found = [(x.l, x.r) for x in pairs.collect()]

        def meet(p, q):
            return p[0] <= q[2] and q[0] <= p[2] and p[1] <= q[3] and q[1] <= p[3]

        truth = {(m, n) for m, p in boxes.items() for n, q in boxes.items() if meet(p, q)}
        truth |= {("a", "ring"), ("b", "ring"), ("e", "ring")}  # c lies in the hole
        assert len(found) == len(set(found)) and set(found) == truth


@pytest.mark.parametrize("how", ["inner", "left"])
def test_balanced_join_with_a_hot_key(spark, how):
    large = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("k"))
    small = spark.range(0, 400, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    plain = large.join(small, "k", how).select("id", "k", "v")
    salted = balanced_join(large, small, ["k"], ["id"], F.lit(16), how, tasks=10,
                           broadcast_limit=-1).select("id", "k", "v")
    assert sorted(map(tuple, plain.collect()), key=repr) == sorted(
        map(tuple, salted.collect()), key=repr)
