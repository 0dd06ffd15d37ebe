import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataseek.functions import geo
from strataseek.functions.sql import register_sql_functions
from strataseek.operators.quantiles import exact_quantiles
from workload import fixtures as fx
from helpers import SMALL


@pytest.fixture(scope="module")
def sql(spark):
    names = register_sql_functions(spark)
    assert {"st_point", "st_contains", "st_centroid", "try_to_geometry"} <= set(names)
    return spark.sql


def test_smoke_cell(sql):
    row = sql("SELECT st_astext(st_point(-122.4194, 37.7749)), "
              "st_distance(st_point(-122.4194, 37.7749), st_point(-118.2437, 34.0522)) / 1000, "
              "st_distance_sphere(st_geogfromtext('POINT(-122.4194 37.7749)'), "
              "st_geogfromtext('POINT(-118.2437 34.0522)')), "
              "st_geogfromtext('POINT(200 1)'), try_to_geometry('POLYGON ((bad')").first()
    assert row[0] == "POINT(-122.4194 37.7749)"
    assert row[1] == pytest.approx(0.005594190, abs=1e-9)
    assert row[2] == pytest.approx(559121.349, abs=0.01)
    assert row[3] is None and row[4] is None


def test_sql_functions_equal_column_functions(spark, sql):
    states = fx.states_raw(spark, SMALL)
    states.createOrReplaceTempView("sql_states")
    got = sql("SELECT state_fips, st_area(geometry_wkt) a, st_x(st_centroid(geometry_wkt)) x, "
              "st_y(st_centroid(geometry_wkt)) y FROM sql_states").collect()
    want = {r.state_fips: r for r in states.select(
        "state_fips", geo.st_area("geometry_wkt").alias("a"),
        geo.st_centroid("geometry_wkt").alias("c")).collect()}
    for r in got:
        w = want[r.state_fips]
        if w.a is None:
            assert r.a is None and r.x is None
        else:
            assert (r.a, r.x, r.y) == (pytest.approx(w.a), pytest.approx(w.c.x),
                                       pytest.approx(w.c.y))


def test_spatial_left_join_in_sql(spark, sql):
    fx.states_raw(spark, SMALL).createOrReplaceTempView("sql_states")
    rnd = random.Random(1)
    points = spark.createDataFrame(
        [(i, rnd.uniform(-125, -65), rnd.uniform(24, 49)) for i in range(60)],
        "id long, x double, y double")
    points.createOrReplaceTempView("sql_points")
    got = sql("""SELECT s.state_fips, count(p.id) AS n FROM sql_states s LEFT JOIN sql_points p
                 ON st_contains(try_to_geometry(s.geometry_wkt), st_point(p.x, p.y))
                 GROUP BY s.state_fips""").collect()
    from strataseek.operators.spatial_join import points_per_polygon
    want = points_per_polygon(points, fx.states_raw(spark, SMALL), "geometry_wkt",
                              ["state_fips"], [F.count("id").alias("n")], ["n"],
                              lon="x", lat="y").collect()
    assert {r.state_fips: r.n for r in got} == {r.state_fips: r.n for r in want}


def test_exact_quantiles(spark):
    rnd = np.random.default_rng(2)
    groups = {"many": rnd.normal(size=20_000).tolist(), "one": [3.0], "two": [1.0, 2.0],
              "copies": [5.0] * 5000 + rnd.uniform(0, 10, size=3001).tolist()}
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs]
                               + [("one", None)], "g string, v double")
    at = {"lowest": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "q99": 0.99, "highest": 1.0}
    for row in exact_quantiles(df, "g", "v", at).collect():
        want = np.quantile(groups[row.g], list(at.values()))
        assert [row[n] for n in at] == pytest.approx(want.tolist())
