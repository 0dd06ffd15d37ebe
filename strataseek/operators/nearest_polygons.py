"""The k polygons nearest to each point, by rings of grid cells that grow until k are certain.

A round has a radius r. Points have one cell of that size; a polygon has the cells of its box
widened by r, so a point meets every polygon within r of it in an equi-join on the cell. Points with
k polygons at a distance of at most r are done: no other can be nearer. The rest goes on with
twice the radius, and with all polygons once r is the extent of both inputs. The first radius is an eighth of
the largest polygon, so a polygon has a bounded number of cells in every round.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf
from pyspark.sql.window import Window

from strataseek.functions import geo
from strataseek.operators.skew import balanced_join
from strataseek.session import cut_lineage

#: Distances are ordered at so many decimals, so equal ones tie; ties go to the smaller key.
DECIMALS = 9
_CELLS_A_BOX = 8


@arrow_udf(T.DoubleType())
def _distances(edges: pa.Array, px: pa.Array, py: pa.Array) -> pa.Array:
    """:func:`geo.edges_distance` of a batch of pairs, all their edges at once: the same steps in the same order."""
    sizes = pc.list_value_length(edges).to_numpy(zero_copy_only=False)
    flat = edges.flatten()
    x1, y1, x2, y2 = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
    x, y = (np.repeat(c.to_numpy(zero_copy_only=False), sizes) for c in (px, py))
    with np.errstate(all="ignore"):
        dx, dy = x2 - x1, y2 - y1
        # no number counts as the greatest value, and as equal to itself, as in Spark
        crosses = ((y1 > y) != (y2 > y)) & ~(dx * (y - y1) / dy + x1 <= x)
        left, right = dx * (y - y1), dy * (x - x1)
        on = (x >= np.minimum(x1, x2)) & (x <= np.maximum(x1, x2)) & (y >= np.minimum(y1, y2)) & (y <= np.maximum(y1, y2)) \
            & ((left == right) | (np.isnan(left) & np.isnan(right)))
        length = dx * dx + dy * dy
        at = np.where(length == 0, 0.0, np.fmax(0.0, np.fmin(1.0, ((x - x1) * dx + (y - y1) * dy) / length)))
        gx, gy = x - (x1 + at * dx), y - (y1 + at * dy)
        gaps = gx * gx + gy * gy
        some = np.flatnonzero(sizes > 0)
        starts = (np.cumsum(sizes) - sizes)[some]
        out = np.full(len(sizes), np.nan)
        if len(some):
            inside = (np.add.reduceat(crosses.astype(np.int64), starts) % 2 == 1) | np.logical_or.reduceat(on, starts)
            out[some] = np.where(inside, 0.0, np.sqrt(np.fmin.reduceat(gaps, starts)))
    return pa.array(out, pa.float64(), mask=sizes == 0)


def nearest_polygons(points: DataFrame, polygons: DataFrame, k: int, point_key: str, polygon_key: str,
                     x: str = "longitude", y: str = "latitude", wkt: str = "geometry_wkt") -> DataFrame:
    """``<point_key>, <polygon_key>, distance, rank``, nearest first; all polygons if there are fewer than ``k``.

    Points without coordinates and polygons without (sound) geometry take no part. Keys are unique.
    """
    rings = polygons.select(F.col(polygon_key).alias("polygon"), geo.st_rings(wkt).alias("rings")).filter(F.size("rings") > 0)
    shapes = cut_lineage(rings.select("polygon", geo.st_edges("rings").alias("edges"), geo.st_box("rings").alias("box")), "shapes")
    left = cut_lineage(points.select(F.col(point_key).alias("point"), F.col(x).cast("double").alias("px"), F.col(y).cast("double").alias("py"))
                       .filter("point is not null and px is not null and py is not null and not isnan(px) and not isnan(py)"), "points")
    box = shapes.agg(F.count(F.lit(1)), F.min("box.min_x"), F.min("box.min_y"), F.max("box.max_x"), F.max("box.max_y"), F.max(
        F.greatest(F.col("box.max_x") - F.col("box.min_x"), F.col("box.max_y") - F.col("box.min_y")))).first()
    area = left.agg(F.count(F.lit(1)), F.min("px"), F.min("py"), F.max("px"), F.max("py")).first()
    kinds = {"point": points.schema[point_key].dataType, "polygon": polygons.schema[polygon_key].dataType}
    if not box[0] or not area[0]:
        return points.sparkSession.createDataFrame([], "distance double, rank int").select(
            F.lit(None).cast(kinds["point"]).alias(point_key), F.lit(None).cast(kinds["polygon"]).alias(polygon_key), "distance", "rank")
    k = min(k, box[0])
    whole = math.hypot(max(box[3], area[3]) - min(box[1], area[1]), max(box[4], area[4]) - min(box[2], area[2])) or 1.0
    slack = 10.0 ** (1 - DECIMALS) + 1e-9 * max(map(abs, [*box[1:5], *area[1:]]))
    radius, done = max(box[5] / _CELLS_A_BOX, whole / 2 ** 16), None
    while True:
        last = radius >= whole

        def cell(value, offset=0.0):
            return F.lit(0).cast("long") if last else F.floor((F.col(value) + offset) / radius)

        def span(low, high):
            return F.explode(F.sequence(cell(low, -radius), cell(high, radius)))

        cells = shapes.select("polygon", "edges", "box", span("box.min_x", "box.max_x").alias("cx")) \
            .select("polygon", "edges", "box", "cx", span("box.min_y", "box.max_y").alias("cy"))
        at = left.select("point", "px", "py", cell("px").alias("cx"), cell("py").alias("cy"))
        pairs = balanced_join(at, cells, ["cx", "cy"], ["point"], F.size("edges") * 32 + 80)
        if not last:  # a box beyond the radius needs no distance; the slack is for rounding
            gap = [F.greatest(F.col(f"box.min_{c}") - F.col(f"p{c}"), F.lit(0.0), F.col(f"p{c}") - F.col(f"box.max_{c}")) for c in "xy"]
            pairs = pairs.filter(F.sqrt(gap[0] * gap[0] + gap[1] * gap[1]) <= radius + slack)
        near = pairs.select("point", "polygon", F.round(_distances("edges", "px", "py"), DECIMALS).alias("distance"))
        if not last:
            near = near.filter(F.col("distance") <= radius)
        ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("point").orderBy("distance", "polygon"))) \
            .filter(F.col("rank") <= k)
        found = cut_lineage(ranked if last else ranked.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("point")))
                            .filter(F.col("n") == k).drop("n"), "nearest")
        done = found if done is None else done.unionByName(found)
        if last:
            break
        left = cut_lineage(left.join(found.filter("rank = 1").select("point"), "point", "left_anti"), "points-left")
        if left.isEmpty():
            break
        radius *= 2
    return done.select(F.col("point").alias(point_key), F.col("polygon").alias(polygon_key), "distance", "rank")
