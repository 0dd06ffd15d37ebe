"""Geospatial silver and gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataseek.functions import geo
from strataseek.operators.dedupe import latest_per_key
from strataseek.operators.spatial_join import points_per_polygon

SIGNIFICANT_MAGNITUDE = 5.0
STATE_GROUP = ["state_fips", "state_code", "state_name", "geometry", "centroid_lat",
               "centroid_lon"]
COUNTY_GROUP = ["state_fips", "county_name", "geometry", "centroid_lat", "centroid_lon"]


def valid_events(raw: DataFrame) -> DataFrame:
    """Rows with a key and coordinates in range."""
    return raw.filter(F.col("event_id").isNotNull()
                      & F.col("latitude").between(-90, 90)
                      & F.col("longitude").between(-180, 180))


def with_event_columns(events: DataFrame) -> DataFrame:
    """Silver columns of clean events: timestamp, date and WKT points."""
    stamp = F.timestamp_millis("event_time")
    return (events.withColumn("event_timestamp", stamp)
            .select("event_id", "event_timestamp",
                    F.to_date("event_timestamp").alias("event_date"),
                    "latitude", "longitude", "depth_km", "magnitude", "place",
                    geo.point_wkt("longitude", "latitude").alias("location_point"),
                    geo.geography_wkt("longitude", "latitude").alias("location_geography")))


def silver_events(raw: DataFrame) -> DataFrame:
    """Clean, keep the latest version of each event, add timestamp, date and points."""
    return with_event_columns(latest_per_key(valid_events(raw), "event_id", ["event_time"]))


def silver_polygons(raw: DataFrame, attributes: list[str], wkt: str = "geometry_wkt") -> DataFrame:
    """Attributes, canonical WKT and centroid; the text is parsed once per polygon."""
    return (raw.withColumn("__rings", geo.st_rings(wkt))
            .withColumn("__centroid", geo.rings_centroid("__rings"))
            .select(*attributes, geo.rings_wkt("__rings").alias("geometry"),
                    F.col("__centroid.y").alias("centroid_lat"),
                    F.col("__centroid.x").alias("centroid_lon")))


def silver_states(raw: DataFrame) -> DataFrame:
    return silver_polygons(raw, ["state_fips", "state_code", "state_name"])


def silver_counties(raw: DataFrame) -> DataFrame:
    return silver_polygons(raw, ["state_fips", "county_name"])


def _magnitude_metrics() -> list:
    return [F.count("event_id").alias("earthquake_count"),
            F.round(F.avg("magnitude"), 2).alias("avg_magnitude"),
            F.round(F.max("magnitude"), 2).alias("max_magnitude")]


def _event_points(events: DataFrame) -> DataFrame:
    return events.select("event_id", "longitude", "latitude", "magnitude")


def gold_by_state(states: DataFrame, events: DataFrame, **join_options) -> DataFrame:
    """Event metrics per state; states without events are kept with count 0."""
    significant = F.count(F.when(F.col("magnitude") >= SIGNIFICANT_MAGNITUDE, 1))
    return points_per_polygon(
        _event_points(events), states, "geometry", STATE_GROUP,
        [*_magnitude_metrics(), significant.alias("significant_count")],
        zero=["earthquake_count", "significant_count"], **join_options)


def county_state_lookup(counties: DataFrame, states: DataFrame) -> DataFrame:
    """Counties with the name and code of their state; null for an unknown state.

    The join is left to Spark, which broadcasts the states when their size allows.
    """
    names = states.select("state_fips", "state_name", "state_code")
    return counties.join(names, "state_fips", "left")


def gold_by_county(counties: DataFrame, states: DataFrame, events: DataFrame,
                   **join_options) -> DataFrame:
    """Event metrics per county with state attributes.

    County names repeat within a state, so the geometry belongs to the key.
    """
    named = county_state_lookup(counties, states)
    return points_per_polygon(
        _event_points(events), named, "geometry", [*COUNTY_GROUP, "state_name", "state_code"],
        _magnitude_metrics(), zero=["earthquake_count"], **join_options)


def top_states_by_name(states: DataFrame, events: DataFrame, k: int = 10) -> DataFrame:
    """Metrics grouped by state name only, the ``k`` names with most events."""
    rows = points_per_polygon(_event_points(events), states, "geometry", ["state_name"],
                              _magnitude_metrics(), zero=["earthquake_count"])
    return rows.orderBy(F.desc("earthquake_count"), "state_name").limit(k)
