"""Live event monitoring: streaming dedupe and daily counts per polygon."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataseek.operators.spatial_join import point_in_polygon_join
from strataseek.plans.medallion import valid_events

WATERMARK = "1 hour"


def clean_event_stream(raw: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Valid events, one per id: the first arrival within the watermark is kept."""
    stamped = valid_events(raw).withColumn(
        "event_timestamp", F.timestamp_millis("event_time"))
    return (stamped.withWatermark("event_timestamp", watermark)
            .dropDuplicatesWithinWatermark(["event_id"]))


def counts_by_polygon_day(events: DataFrame, polygons: DataFrame, wkt: str, key: str,
                          watermark: str | None = WATERMARK) -> DataFrame:
    """Events per polygon and day. ``events`` may be a stream or a table; the polygons
    are static, so the join keeps no state. ``watermark=None`` when it is already set."""
    timed = events.withWatermark("event_timestamp", watermark) if watermark else events
    placed = point_in_polygon_join(
        timed.select("event_id", "event_timestamp", "longitude", "latitude", "magnitude"),
        polygons, wkt, [key])
    return (placed.groupBy(F.window("event_timestamp", "1 day").alias("w"), key)
            .agg(F.count(F.lit(1)).alias("event_count"),
                 F.max("magnitude").alias("max_magnitude"))
            .select(F.to_date("w.start").alias("event_day"), key, "event_count",
                    "max_magnitude"))


def run_available(stream: DataFrame, out_path: str, checkpoint: str, mode: str = "append") -> None:
    """Process everything that has arrived and stop.

    Each micro-batch overwrites its own ``epoch`` folder, so a batch that is replayed
    after a failure does not appear twice.
    """
    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/epoch={epoch}")

    query = (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).foreachBatch(write).start())
    query.awaitTermination()


def latest_epoch(spark: SparkSession, out_path: str, keys: list[str]) -> DataFrame:
    """Current value per key of an ``update`` mode output written by run_available."""
    table = spark.read.option("basePath", out_path).parquet(out_path)
    rest = [c for c in table.columns if c not in (*keys, "epoch")]
    newest = F.max_by(F.struct(*rest), "epoch").alias("__row")
    return (table.groupBy(*keys).agg(newest)
            .select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest]))
