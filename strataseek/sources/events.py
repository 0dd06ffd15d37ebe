"""Point events from GeoJSON feature collections."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_SCHEMA = ("event_id string, event_time bigint, latitude double, longitude double, "
                "depth_km double, magnitude double, place string")

_GEOJSON = """features array<struct<
    id: string,
    properties: struct<time: bigint, mag: double, place: string>,
    geometry: struct<coordinates: array<double>>>>"""


def read_geojson_events(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row per feature. ``multi_line=False`` reads one collection per line, which
    lets Spark split large files."""
    collections = spark.read.schema(_GEOJSON).option("multiLine", multi_line).json(path)
    feature = collections.select(F.explode("features").alias("f"))
    place = F.col("f.geometry.coordinates")
    return feature.select(
        F.col("f.id").alias("event_id"),
        F.col("f.properties.time").alias("event_time"),
        F.get(place, F.lit(1)).alias("latitude"),
        F.get(place, F.lit(0)).alias("longitude"),
        F.get(place, F.lit(2)).alias("depth_km"),
        F.col("f.properties.mag").alias("magnitude"),
        F.col("f.properties.place").alias("place"))


def recent_events_filter(events: DataFrame, as_of: date, days_back: int = 30,
                         min_magnitude: float = 2.5, time_ms: str = "event_time",
                         magnitude: str = "magnitude") -> DataFrame:
    """Events of the last ``days_back`` days up to the start of ``as_of``.

    The bounds are literals on the stored columns, so Parquet can skip row groups.
    """
    def millis(day: date) -> int:
        at = datetime(day.year, day.month, day.day, tzinfo=timezone.utc)
        return int(at.timestamp() * 1000)

    return events.filter(
        (F.col(time_ms) >= millis(as_of - timedelta(days=days_back)))
        & (F.col(time_ms) <= millis(as_of)) & (F.col(magnitude) >= min_magnitude))
