"""The vector index as a keyed table: build, describe, upsert and change feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataseek.operators.dedupe import earliest_per_key
from strataseek.session import BROADCAST_LIMIT_BYTES, fits_broadcast

# Type names of the index schema; any other type is listed as string.
_TYPE_NAMES = {T.StringType: "string", T.IntegerType: "int", T.LongType: "long",
               T.TimestampType: "timestamp"}


def vector_dimension(df: DataFrame, vector: str = "embedding") -> int:
    """Length of the vectors; all of them must agree."""
    low, high = df.agg(F.min(F.size(vector)), F.max(F.size(vector))).first()
    if low != high:
        raise ValueError(f"vectors of different lengths in {vector}: {low} to {high}")
    return high


def index_schema(df: DataFrame, vector: str = "embedding") -> dict[str, str]:
    return {f.name: "array<double>" if f.name == vector
            else _TYPE_NAMES.get(type(f.dataType), "string") for f in df.schema.fields}


def describe_index(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """One row per index field: name, type, and the row count and vector length."""
    fields = [F.struct(F.lit(n).alias("field"), F.lit(t).alias("type"))
              for n, t in index_schema(df, vector).items()]
    totals = df.agg(F.count(F.lit(1)).alias("row_count"),
                    F.min(F.size(vector)).alias("min_dimension"),
                    F.max(F.size(vector)).alias("max_dimension"))
    return totals.select(F.inline(F.array(*fields)), "row_count", "min_dimension",
                         "max_dimension")


def check_rows(batch: DataFrame, dim: int, key: str = "chunk_id",
               vector: str = "embedding") -> DataFrame:
    """Add ``valid``: the key is not null and the vector has the index dimension."""
    return batch.withColumn("valid", F.col(key).isNotNull() & F.coalesce(
        F.size(vector) == dim, F.lit(False)))


def upsert(existing: DataFrame, batch: DataFrame, dim: int, key: str = "chunk_id",
           vector: str = "embedding", position: str | None = None,
           broadcast_limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Rows of ``existing`` replaced or extended by the valid rows of ``batch``.

    A key repeated inside the batch keeps the row with the lowest ``position``. When
    the batch keys are small they are broadcast, so the index itself is not shuffled.
    """
    valid = check_rows(batch, dim, key, vector).filter("valid").drop("valid")
    if position is not None:
        valid = earliest_per_key(valid, key, position)
    fresh = valid.select(*existing.columns)
    keys = valid.select(key)
    if fits_broadcast(keys, F.octet_length(key) + 32, broadcast_limit):
        keys = F.broadcast(keys)
    return existing.join(keys, key, "left_anti").select(*existing.columns).unionByName(fresh)


def upsert_report(batch: DataFrame, dim: int, key: str = "chunk_id",
                  vector: str = "embedding") -> DataFrame:
    """``status, success_row_count, failed_row_count`` of an upsert."""
    counted = check_rows(batch, dim, key, vector).agg(
        F.count_if("valid").alias("success_row_count"),
        F.count_if(~F.col("valid")).alias("failed_row_count"))
    return counted.select(
        F.when(F.col("failed_row_count") > 0, "FAILURE").otherwise("SUCCESS").alias("status"),
        "success_row_count", "failed_row_count")


def failed_keys(batch: DataFrame, dim: int, key: str = "chunk_id",
                vector: str = "embedding") -> DataFrame:
    """Keys (null included) of the rows that an upsert rejects."""
    return check_rows(batch, dim, key, vector).filter(~F.col("valid")).select(key)


def row_hash(columns: list[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def change_feed(before: DataFrame, after: DataFrame, key: str = "chunk_id",
                compare: list[str] | None = None) -> DataFrame:
    """Row-level changes between two snapshots: ``<key>, change_type`` and hashes.

    Only the key and a hash of the compared columns go through the join.
    """
    compare = compare or [c for c in after.columns if c != key]

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(key, row_hash(compare).alias(name))

    old, new = side(before, "old_hash"), side(after, "new_hash")
    change = (F.when(F.col("old_hash").isNull(), "insert")
              .when(F.col("new_hash").isNull(), "delete")
              .when(F.col("old_hash") != F.col("new_hash"), "update"))
    return (old.join(new, key, "full").withColumn("change_type", change)
            .filter(F.col("change_type").isNotNull())
            .select(key, "change_type", "old_hash", "new_hash"))
