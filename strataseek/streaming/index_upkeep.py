"""Incremental index upkeep: new documents are cleaned, chunked, embedded and upserted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataseek.operators.embed import embed_hashing
from strataseek.operators.index_table import check_rows
from strataseek.plans.documents import index_rows


def upsert_stream(bronze: DataFrame, log_path: str, checkpoint: str, dim: int = 64,
                  embed=embed_hashing) -> None:
    """Append the index rows of all new documents to an upsert log and stop.

    A micro-batch writes only its own rows, into the folder of its epoch; the index is
    not rewritten. A replayed batch overwrites its folder.
    """
    def write(batch: DataFrame, epoch: int) -> None:
        valid = check_rows(index_rows(batch, embed), dim).filter("valid").drop("valid")
        valid.write.mode("overwrite").parquet(f"{log_path}/epoch={epoch}")

    query = (bronze.writeStream.option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).foreachBatch(write).start())
    query.awaitTermination()


def _newest(rows: DataFrame, key: str) -> DataFrame:
    rest = [c for c in rows.columns if c not in (key, "epoch")]
    order = F.struct(F.col("epoch"), -F.col("chunk_position"))
    return (rows.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("__row"))
            .select(key, *[F.col(f"__row.{c}").alias(c) for c in rest]))


def current_index(spark: SparkSession, log_path: str, key: str = "chunk_id",
                  snapshot_path: str | None = None) -> DataFrame:
    """The index as the log defines it: the newest epoch wins, then the first position.

    With the path of a snapshot (:func:`compact_index`) only newer epochs of the log are grouped, and
    the snapshot's rows whose key they lack are added as they are.
    """
    log = spark.read.option("basePath", log_path).parquet(log_path)
    if snapshot_path is None:
        return _newest(log, key)
    snapshot = spark.read.option("basePath", snapshot_path).parquet(snapshot_path)
    through = snapshot.agg(F.max("through")).first()[0]
    held = snapshot.filter(F.col("through") == through).drop("through")
    newer = _newest(log.filter(F.col("epoch") > through), key)
    return held.join(newer.select(key), key, "left_anti").unionByName(newer.select(*held.columns))


def compact_index(spark: SparkSession, log_path: str, out_path: str,
                  key: str = "chunk_id") -> DataFrame:
    """Write the current index as one snapshot, named by the last epoch in it, and read it back."""
    log = spark.read.option("basePath", log_path).parquet(log_path)
    through = log.agg(F.max("epoch")).first()[0]
    target = f"{out_path}/through={through}"
    _newest(log.filter(F.col("epoch") <= through), key).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)
