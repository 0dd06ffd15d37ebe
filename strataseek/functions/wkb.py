"""Little-endian WKB of points, polygons and multipolygons.

Coordinates are packed and read as blocks inside Arrow UDFs; parsing and printing of
WKT stay with the native expressions of :mod:`strataseek.functions.geo`.
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf, pandas_udf

from strataseek.functions import geo

# WKB geometry codes.
POINT, POLYGON, MULTIPOLYGON = 1, 3, 6

POINT_TYPE = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RINGS_TYPE = T.ArrayType(T.StructType([
    T.StructField("exterior", T.BooleanType()), T.StructField("points", T.ArrayType(POINT_TYPE))]))
_POINT_LAYOUT = np.dtype([("order", "u1"), ("code", "<u4"), ("x", "<f8"), ("y", "<f8")])


@pandas_udf(T.BinaryType())
def point_wkb(x: pd.Series, y: pd.Series) -> pd.Series:
    """WKB of points given as two double columns; null when either is null."""
    packed = np.zeros(len(x), dtype=_POINT_LAYOUT)
    packed["order"], packed["code"], packed["x"], packed["y"] = 1, POINT, x, y
    raw = packed.tobytes()
    known = (x.notna() & y.notna()).to_numpy()
    size = _POINT_LAYOUT.itemsize
    return pd.Series([raw[i * size:(i + 1) * size] if known[i] else None
                      for i in range(len(x))], dtype=object)


@pandas_udf(POINT_TYPE)
def _point_fields(wkb: pd.Series) -> pd.DataFrame:
    size = _POINT_LAYOUT.itemsize
    good = wkb.map(lambda b: b is not None and len(b) == size and b[:5] == b"\x01\x01\x00\x00\x00")
    blank = b"\x00" * size
    rows = np.frombuffer(b"".join(b if ok else blank for b, ok in zip(wkb, good)),
                         dtype=_POINT_LAYOUT)
    return pd.DataFrame({"x": np.where(good, rows["x"], np.nan),
                         "y": np.where(good, rows["y"], np.nan)})


def point_from_wkb(wkb: Column | str) -> Column:
    """Point struct; null for bytes that are not a little-endian point."""
    fields = _point_fields(F.col(wkb) if isinstance(wkb, str) else wkb)
    return geo.let(fields, lambda p: F.when(~F.isnan(p["x"]), p))


def _encode(rings: pa.Array) -> pa.Array:
    """WKB of a column of ring lists: one pass over the rings, points are copied as blocks."""
    inner = rings.flatten()
    points = inner.field("points")
    first = np.r_[0, np.cumsum(pc.list_value_length(rings).fill_null(0).to_numpy(zero_copy_only=False))]
    edges = np.r_[0, np.cumsum(pc.list_value_length(points).fill_null(0).to_numpy(zero_copy_only=False))]
    spots = points.flatten()
    raw = np.stack([spots.field(i).to_numpy(zero_copy_only=False) for i in (0, 1)], axis=1) \
        .astype("<f8").tobytes()
    exterior = inner.field("exterior").to_pylist()
    bodies = [struct.pack("<I", b - a) + raw[16 * a:16 * b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
    out = []
    for known, a, b in zip(rings.is_valid().to_pylist(), first[:-1].tolist(), first[1:].tolist()):
        starts = [j for j in range(a, b) if exterior[j] or j == a]
        parts = [struct.pack("<BII", 1, POLYGON, end - j) + b"".join(bodies[j:end])
                 for j, end in zip(starts, [*starts[1:], b])]
        whole = parts[0] if len(parts) == 1 else struct.pack("<BII", 1, POLYGON, 0) if not parts else \
            struct.pack("<BII", 1, MULTIPOLYGON, len(parts)) + b"".join(parts)
        out.append(whole if known else None)
    return pa.array(out, pa.binary())


def _polygon_places(data: bytes, at: int) -> tuple[list[tuple[bool, int, int]], int]:
    """(exterior, number of points, place of the first) of each ring, and the end."""
    order, code, count = struct.unpack_from("<BII", data, at)
    if (order, code) != (1, POLYGON):
        raise ValueError("not a little-endian polygon")
    at += 9
    found = []
    for i in range(count):
        n, = struct.unpack_from("<I", data, at)
        if at + 4 + 16 * n > len(data):
            raise ValueError("truncated")
        found.append((i == 0, n, at + 4))
        at += 4 + 16 * n
    return found, at


def _places(data: bytes | None) -> list[tuple[bool, int, int]] | None:
    if data is None:
        return None
    try:
        order, code, count = struct.unpack_from("<BII", data, 0)
        if (order, code) == (1, POLYGON):
            return _polygon_places(data, 0)[0]
        if (order, code) != (1, MULTIPOLYGON):
            return None
        at, found = 9, []
        for _ in range(count):
            part, at = _polygon_places(data, at)
            found += part
        return found
    except (struct.error, ValueError):
        return None


def _decode(column: pa.Array) -> pa.Array:
    """Ring lists of a column of WKB; only ring headers are read one by one."""
    rows = column.to_pylist()
    found = [_places(data) for data in rows]
    rings = [r for place in found for r in place or ()]
    raw = b"".join(data[at:at + 16 * n] for data, place in zip(rows, found) for _, n, at in place or ())
    xy = np.frombuffer(raw, "<f8").reshape(-1, 2)
    points = pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], names=["x", "y"])
    lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum([n for _, n, _ in rings])], pa.int32()), points)
    inner = pa.StructArray.from_arrays([pa.array([e for e, _, _ in rings], pa.bool_()), lists],
                                       names=["exterior", "points"])
    ends = np.r_[0, np.cumsum([len(place or ()) for place in found])]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), inner,
                                    mask=pa.array([place is None for place in found], pa.bool_()))


@arrow_udf(T.BinaryType())
def rings_wkb(rings: pa.Array) -> pa.Array:
    """WKB of parsed rings (:func:`strataseek.functions.geo.st_rings`)."""
    return _encode(rings)


@arrow_udf(RINGS_TYPE)
def rings_from_wkb(data: pa.Array) -> pa.Array:
    """Parsed rings of polygon or multipolygon WKB; null for anything else."""
    return _decode(data)


def wkt_to_wkb(wkt: Column | str) -> Column:
    return rings_wkb(geo.st_rings(wkt)).alias("wkb")


def wkb_to_wkt(wkb: Column | str) -> Column:
    rings = rings_from_wkb(F.col(wkb) if isinstance(wkb, str) else wkb)
    return geo.rings_wkt(rings).alias("wkt")
