"""Table writes with row counts taken from the write itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def ensure_namespace(spark: SparkSession, *names: str) -> None:
    for name in names:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def write_parquet(df: DataFrame, path: str, partition_by: str | None = None,
                  mode: str = "overwrite") -> int:
    """Write and return the number of rows, counted during the write (no second job).

    A partitioned write first rebalances on the partition column: small partitions
    share a task and a partition with many rows is split over several files.
    """
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    if partition_by is None:
        counted.write.mode(mode).parquet(path)
    else:
        (counted.hint("rebalance", F.col(partition_by)).write.mode(mode)
         .partitionBy(partition_by).parquet(path))
    return seen.get["rows"]


def save_table(df: DataFrame, name: str, path: str | None = None,
               partition_by: str | None = None) -> None:
    """CREATE OR REPLACE TABLE AS SELECT in the session catalog."""
    writer = df.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    writer.saveAsTable(name)


def create_table(spark: SparkSession, name: str, columns: str, path: str | None = None) -> None:
    """CREATE TABLE IF NOT EXISTS with declared columns; an existing table is kept."""
    location = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{location}")


def read_merged(spark: SparkSession, *paths: str) -> DataFrame:
    """Read Parquet written with different schemas; missing columns are null."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object per line, null fields kept."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)
