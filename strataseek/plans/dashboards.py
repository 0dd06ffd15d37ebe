"""Result tables behind the dashboard charts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HISTOGRAM_BINS = 40
MAP_MAGNITUDE = 3.0


def daily_series(events: DataFrame) -> DataFrame:
    return (events.groupBy("event_date")
            .agg(F.count(F.lit(1)).alias("earthquake_count"),
                 F.round(F.avg("magnitude"), 2).alias("avg_magnitude"),
                 F.round(F.max("magnitude"), 2).alias("max_magnitude"))
            .orderBy("event_date"))


def magnitude_histogram(events: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins between the smallest and largest magnitude; empty bins left out.

    The two bounds are scalar subqueries, so the whole table stays one plan.
    """
    known = events.select("magnitude").filter(F.col("magnitude").isNotNull())
    bounds = known.agg(F.min("magnitude").alias("low"), F.max("magnitude").alias("high"))
    low = bounds.select("low").scalar()
    high = bounds.select("high").scalar()
    ranged = known.select("magnitude", low.alias("low"), high.alias("high"))
    bin_number = F.when(F.col("high") > F.col("low"), F.least(
        F.lit(bins), F.width_bucket("magnitude", "low", "high", F.lit(bins)))).otherwise(1)
    width = (F.col("high") - F.col("low")) / bins
    return (ranged.withColumn("bin", bin_number.cast("int"))
            .groupBy("bin", "low", "high").agg(F.count(F.lit(1)).alias("event_count"))
            .select("bin", (F.col("low") + (F.col("bin") - 1) * width).alias("bin_start"),
                    (F.col("low") + F.col("bin") * width).alias("bin_end"), "event_count")
            .orderBy("bin"))


def kpi_overview(events: DataFrame) -> DataFrame:
    """Total events, average magnitude and the largest event (ties: greatest id)."""
    largest = F.max(F.struct("magnitude", "event_id", "place"))
    return (events.agg(F.count(F.lit(1)).alias("total_events"),
                       F.round(F.avg("magnitude"), 2).alias("avg_magnitude"),
                       largest.alias("largest"))
            .select("total_events", "avg_magnitude",
                    F.col("largest.event_id").alias("largest_event_id"),
                    F.col("largest.magnitude").alias("largest_magnitude"),
                    F.col("largest.place").alias("largest_place")))


def point_map(events: DataFrame, min_magnitude: float = MAP_MAGNITUDE) -> DataFrame:
    return (events.filter(F.col("magnitude") >= min_magnitude)
            .select("latitude", "longitude", "magnitude", "place", "depth_km",
                    "event_timestamp"))


def choropleth(gold: DataFrame) -> DataFrame:
    """Regions with at least one event, most events first."""
    return (gold.filter(F.col("earthquake_count") > 0)
            .orderBy(F.desc("earthquake_count"), "state_fips"))


def top_regions(gold: DataFrame, k: int = 10) -> DataFrame:
    return choropleth(gold).limit(k)


def recent_events(events: DataFrame, k: int = 10) -> DataFrame:
    return events.orderBy(F.desc("event_timestamp"), "event_id").limit(k)


def sample_rows(df: DataFrame, order: str, k: int = 5) -> DataFrame:
    """A few rows for display; ordered, so the sample is stable."""
    return df.orderBy(order).limit(k)
