"""Equi-join that stays balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataseek.session import BROADCAST_LIMIT_BYTES, measured_bytes

_SALT = "__salt"
_SALTS = "__salts"
# Copies of the static side in a stream join whose static side is too large to broadcast.
STREAM_SALTS = 8


def balanced_join(large: DataFrame, small: DataFrame, on: list[str], row_key: list[str],
                  small_bytes: Column | int, how: str = "inner", tasks: int = 1000,
                  broadcast_limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Join ``large`` with ``small`` on the columns ``on`` (``inner`` or ``left``).

    ``small_bytes`` is the size of ``small``, or an expression for the size of one of
    its rows, which is then summed. At or below ``broadcast_limit`` it is broadcast
    and ``large`` is not shuffled. Otherwise both sides are shuffled and
    every hot key (more than 1/``tasks`` of the rows of ``large``) is split: its
    rows get a salt from ``row_key`` and the matching rows of ``small`` are
    repeated once per salt. There can be at most ``tasks`` hot keys, so the table
    of hot keys that is broadcast has a fixed bound. A stream is split by ``STREAM_SALTS`` throughout.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if isinstance(small_bytes, Column):
        small_bytes = measured_bytes(small, small_bytes)
    if small_bytes <= broadcast_limit:
        return large.join(F.broadcast(small), on, how)

    if large.isStreaming:  # a micro-batch cannot be counted ahead of its run: every key is split
        salted = large.withColumn(_SALT, F.pmod(F.xxhash64(*row_key), F.lit(STREAM_SALTS)).cast("int"))
        copies = small.withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.lit(STREAM_SALTS - 1))))
        return salted.join(copies, [*on, _SALT], how).drop(_SALT)
    sizes = large.groupBy(*on).agg(F.count(F.lit(1)).alias("__n"))
    per_task = sizes.agg(F.ceil(F.sum("__n") / tasks)).first()[0] or 1
    hot = F.broadcast(
        sizes.filter(F.col("__n") > per_task)
        .select(*on, F.ceil(F.col("__n") / per_task).cast("int").alias(_SALTS)))
    split = (large.join(hot, on, "left")
             .withColumn(_SALT, F.pmod(F.xxhash64(*row_key),
                                       F.coalesce(_SALTS, F.lit(1))).cast("int"))
             .drop(_SALTS))
    copies = (small.join(hot, on, "left")
              .withColumn(_SALT, F.explode(
                  F.sequence(F.lit(0), F.coalesce(_SALTS, F.lit(1)) - 1)))
              .drop(_SALTS))
    return split.join(copies, [*on, _SALT], how).drop(_SALT)
