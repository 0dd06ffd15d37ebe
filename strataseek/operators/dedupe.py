"""One row per key without a window, so a hot key is reduced before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Keep the row with the greatest ``order`` columns (then the greatest rest) per key.

    ``max(struct)`` is a partial aggregate: copies of one key shrink to one row per
    task before the shuffle, and the result does not depend on row order.
    """
    rest = [c for c in df.columns if c not in (key, *order)]
    best = df.groupBy(key).agg(F.max(F.struct(*order, *rest)).alias("__row"))
    return best.select(*[F.col(c) if c == key else F.col(f"__row.{c}").alias(c)
                         for c in df.columns])


def earliest_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """Keep the row with the smallest ``order`` per key."""
    rest = [c for c in df.columns if c != key]
    picked = df.groupBy(key).agg(F.min_by(F.struct(*rest), order).alias("__row"))
    return picked.select(*[F.col(c) if c == key else F.col(f"__row.{c}").alias(c)
                           for c in df.columns])
