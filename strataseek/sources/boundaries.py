"""Polygon boundaries from GeoJSON or delimited WKT text, as WKT columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_NUMBER = r"-?[0-9.]+(?:[eE][-+]?[0-9]+)?"


def geojson_to_wkt(kind: Column | str, coordinates: Column | str) -> Column:
    """WKT of a GeoJSON geometry whose coordinates are given as JSON text."""
    kind = F.col(kind) if isinstance(kind, str) else kind
    text = F.col(coordinates) if isinstance(coordinates, str) else coordinates
    pairs = F.regexp_replace(F.regexp_replace(text, r"\s+", ""),
                             rf"\[({_NUMBER}),({_NUMBER})(?:,{_NUMBER})*\]", "$1 $2")
    point = F.concat(F.lit("("), pairs, F.lit(")"))
    nested = F.translate(pairs, "[]", "()")
    return F.concat(F.upper(kind), F.lit(" "), F.when(kind == "Point", point).otherwise(nested))


def wkt_to_geojson(wkt: Column | str) -> Column:
    """GeoJSON geometry text of POLYGON / MULTIPOLYGON WKT."""
    w = F.col(wkt) if isinstance(wkt, str) else wkt
    body = F.regexp_replace(F.regexp_extract(w, r"(?s)^[^(]*(\(.*\))\s*$", 1),
                            rf"({_NUMBER})\s+({_NUMBER})", "[$1,$2]")
    kind = F.when(F.upper(w).startswith("MULTI"), "MultiPolygon").otherwise("Polygon")
    return F.concat(F.lit('{"type":"'), kind, F.lit('","coordinates":'),
                    F.translate(body, "()", "[]"), F.lit("}"))


def read_geojson_boundaries(spark: SparkSession, path: str, attributes: dict[str, str],
                            multi_line: bool = True) -> DataFrame:
    """``attributes`` maps feature properties to output columns; geometry becomes
    ``geometry_wkt``. Other properties are not read."""
    properties = ", ".join(f"{name}: string" for name in attributes)
    schema = (f"features array<struct<properties: struct<{properties}>, "
              "geometry: struct<type: string, coordinates: string>>>")
    feature = (spark.read.schema(schema).option("multiLine", multi_line).json(path)
               .select(F.explode("features").alias("f")))
    return feature.select(
        *[F.col(f"f.properties.{name}").alias(out) for name, out in attributes.items()],
        geojson_to_wkt(F.col("f.geometry.type"), F.col("f.geometry.coordinates"))
        .alias("geometry_wkt"))


def read_wkt_boundaries(spark: SparkSession, path: str, attributes: dict[str, str],
                        geometry: str = "geometry_wkt", separator: str = "\t") -> DataFrame:
    """Boundaries from delimited text with a header and a WKT column."""
    table = (spark.read.option("header", True).option("sep", separator)
             .option("enforceSchema", False).csv(path))
    return table.select(*[F.col(name).alias(out) for name, out in attributes.items()],
                        F.col(geometry).alias("geometry_wkt"))
