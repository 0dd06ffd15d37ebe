import math
import random

import pytest
from pyspark.sql import functions as F

from strataseek.functions import geo, wkb

SQUARE = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))"
HOLED = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))"
PARTS = "MULTIPOLYGON (((0 0, 4 0, 4 4, 0 4, 0 0)), ((10 0, 10 2, 12 2, 12 0, 10 0)))"


def value(spark, column, **row):
    names = row or {"one": 1}
    return spark.createDataFrame([tuple(names.values())], list(names)).select(column.alias("v")).first()[0]


def point(x, y):
    return geo.st_point(F.lit(float(x)), F.lit(float(y)))


@pytest.mark.parametrize("wkt, x, y, contained, touched", [
    (SQUARE, 2, 2, True, True), (SQUARE, 4, 2, False, True), (SQUARE, 0, 0, False, True),
    (SQUARE, 5, 2, False, False), (HOLED, 1.5, 1.5, False, False), (HOLED, 1, 1.5, False, True),
    (HOLED, 3, 3, True, True), (PARTS, 11, 1, True, True), (PARTS, 7, 1, False, False),
])
def test_point_tests(spark, wkt, x, y, contained, touched):
    assert value(spark, geo.st_contains("w", point(x, y)), w=wkt) is contained
    assert value(spark, geo.st_within(point(x, y), "w"), w=wkt) is contained
    assert value(spark, geo.st_intersects_point("w", point(x, y)), w=wkt) is touched


@pytest.mark.parametrize("bad", [
    "POLYGON ((bad", "POLYGON ((0 0, 1 0, 1 1))", "POLYGON ((0 0, 1 0, 1 1, 0 1))",
    "POINT (1 2)", "POLYGON ((0 0, 1 0, x 1, 0 0))", "POLYGON (0 0, 1 0, 1 1, 0 0)",
    "MULTIPOLYGON ((0 0, 1 0, 1 1, 0 0))", "POLYGON ((0 0, 1 0, 1 1, 0 0)) tail", ""])
def test_bad_text_gives_null(spark, bad):
    assert value(spark, geo.st_rings("w"), w=bad) is None
    assert value(spark, geo.st_contains("w", point(0.5, 0.2)), w=bad) is None


def test_empty_and_null(spark):
    assert value(spark, geo.st_area("w"), w="POLYGON EMPTY") == 0
    assert value(spark, geo.st_centroid("w"), w="POLYGON EMPTY") is None
    assert value(spark, geo.st_contains("w", point(0, 0)), w="POLYGON EMPTY") is False
    assert value(spark, geo.st_contains(
        F.lit(SQUARE), geo.st_point(F.lit(None), F.lit(1.0)))) is None


@pytest.mark.parametrize("wkt, area, cx, cy", [
    (HOLED, 15, 30.5 / 15, 30.5 / 15), (PARTS, 20, 3.8, 1.8),
    ("POLYGON ((0 4, 4 4, 4 0, 0 0, 0 4), (1 1, 2 1, 2 2, 1 2, 1 1))", 15, 30.5 / 15, 30.5 / 15)])
def test_measures(spark, wkt, area, cx, cy):
    assert value(spark, geo.st_area("w"), w=wkt) == pytest.approx(area)
    centre = value(spark, geo.st_centroid("w"), w=wkt)
    assert (centre.x, centre.y) == (pytest.approx(cx), pytest.approx(cy))


def test_distances(spark):
    sf, la = point(-122.4194, 37.7749), point(-118.2437, 34.0522)
    assert value(spark, geo.st_distance_sphere(sf, la)) == pytest.approx(559121.349, abs=0.01)
    assert value(spark, geo.st_distance_planar(sf, la)) == pytest.approx(5.594190, abs=1e-6)


@pytest.mark.parametrize("number, text", [
    (-122.0, "-122"), (0.5, "0.5"), (100.0, "100"), (-0.0, "0"), (0.00001, "0.00001"),
    (1e8, "100000000"), (12345678.25, "12345678.25"), (10.05, "10.05")])
def test_number_text(spark, number, text):
    assert value(spark, geo.number_text(F.lit(number))) == text
    assert value(spark, geo.point_wkt(F.lit(number), F.lit(1.0))) == f"POINT({text} 1)"


def test_text_round_trips(spark):
    for wkt in (SQUARE, HOLED, PARTS):
        tidy = value(spark, geo.rings_wkt(geo.st_rings("w")), w=wkt)
        assert value(spark, geo.rings_wkt(geo.st_rings("w")), w=tidy) == tidy
        assert value(spark, wkb.wkb_to_wkt(wkb.wkt_to_wkb("w")), w=wkt) == tidy
    assert value(spark, wkb.wkb_to_wkt("b"), b=bytearray(b"junk")) is None


def test_point_wkb_matches_spark_layout(spark):
    import struct
    df = spark.createDataFrame([(1.5, -2.0), (None, 1.0)], "x double, y double")
    packed = [r[0] for r in df.select(wkb.point_wkb("x", "y")).collect()]
    assert bytes(packed[0]) == struct.pack("<BIdd", 1, 1, 1.5, -2.0) and packed[1] is None


def test_geography_range(spark):
    assert value(spark, geo.st_geography_from_text(F.lit("POINT(181 0)"))) is None
    assert value(spark, geo.st_geography_from_text(F.lit("POINT(-180 90)"))).x == -180
    assert value(spark, geo.geography_wkt(F.lit(10.0), F.lit(95.0))) is None


def test_buffer_is_closed_and_near_circle(spark):
    area = value(spark, geo.st_area(geo.st_buffer(point(3, 4), 2.0, sides=64)))
    assert area == pytest.approx(math.pi * 4, rel=0.01)


def test_random_points_against_plain_even_odd(spark):
    random.seed(3)
    corners = [(math.cos(a) * r + 5, math.sin(a) * r + 5) for a, r in (
        (i * 2 * math.pi / 40, random.uniform(1, 5)) for i in range(40))]
    ring = corners + corners[:1]
    wkt = "POLYGON((" + ",".join(f"{x} {y}" for x, y in ring) + "))"

    def inside(x, y):
        odd = False
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                odd = not odd
        return odd

    points = [(random.uniform(0, 10), random.uniform(0, 10)) for _ in range(500)]
    df = spark.createDataFrame(points, "x double, y double")
    got = df.select("x", "y", geo.st_contains(F.lit(wkt), geo.st_point("x", "y"))).collect()
    assert all(r[2] == inside(r[0], r[1]) for r in got)
