"""Exact interpolated quantiles per group without holding a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strataseek.session import held_locally

# Accuracy of the first, approximate pass: its rank error is at most rows / ACCURACY.
ACCURACY = 10_000
_MARGIN = 3 / ACCURACY
# Up to this many brackets (groups times quantiles) are broadcast.
MAX_LOCAL_BRACKETS = 100_000


def exact_quantiles(df: DataFrame, group: str, value: str, at: dict[str, float]) -> DataFrame:
    """``group`` and one column per entry of ``at`` (name -> quantile), linear interpolation.

    Equal values are counted first, so copies cost one row. An approximate pass then
    brackets each quantile between two values; only the few distinct values inside a
    bracket are ordered, the rest are counted by a plain sum. Nulls are ignored.
    """
    known = df.select(group, F.col(value).cast("double").alias("v")).filter("v is not null")
    low = [max(0.0, p - _MARGIN) for p in at.values()]
    high = [min(1.0, p + _MARGIN) for p in at.values()]

    def marks(points: list[float]) -> Column:
        return F.percentile_approx("v", F.array(*[F.lit(p) for p in points]), F.lit(ACCURACY))

    bracket = known.groupBy(group).agg(
        F.count(F.lit(1)).alias("rows"), F.min("v").alias("least"), F.max("v").alias("most"),
        marks(low).alias("low"), marks(high).alias("high"))
    few = F.col("rows") <= ACCURACY  # no bracket needed
    entries = [F.struct(
        F.lit(name).alias("name"), (F.lit(p) * (F.col("rows") - 1)).alias("spot"),
        F.when(few | F.lit(lo == 0), F.col("least")).otherwise(F.col("low")[i]).alias("lo"),
        F.when(few | F.lit(hi == 1), F.col("most")).otherwise(F.col("high")[i]).alias("hi"))
        for i, ((name, p), lo, hi) in enumerate(zip(at.items(), low, high))]
    wanted = bracket.select(group, F.inline(F.array(*entries)))
    local = held_locally(wanted, MAX_LOCAL_BRACKETS)

    def near(side: DataFrame) -> DataFrame:
        return side if local is None else F.broadcast(side)

    wanted = wanted if local is None else local
    counted = known.groupBy(group, "v").agg(F.count(F.lit(1)).alias("n"))
    placed = counted.join(near(wanted), group)
    below = (placed.groupBy(group, "name")
             .agg(F.sum(F.when(F.col("v") < F.col("lo"), F.col("n")).otherwise(0))
                  .alias("below")))
    order = Window.partitionBy(group, "name").orderBy("v")
    inside = (placed.filter(F.col("v").between(F.col("lo"), F.col("hi")))
              .join(near(below), [group, "name"])
              .withColumn("last", F.col("below") + F.sum("n").over(order) - 1)
              .withColumn("first", F.col("last") - F.col("n") + 1))

    def value_at(spot: Column) -> Column:
        return F.max(F.when(spot.between(F.col("first"), F.col("last")), F.col("v")))

    floor, ceil = F.floor("spot"), F.ceil("spot")
    picked = inside.groupBy(group, "name").agg(
        value_at(floor).alias("a"), value_at(ceil).alias("b"),
        F.first(F.col("spot") - floor).alias("part"))
    exact = F.col("a") + (F.col("b") - F.col("a")) * F.col("part")
    return (picked.withColumn("q", exact).groupBy(group)
            .agg(*[F.max(F.when(F.col("name") == name, F.col("q"))).alias(name)
                   for name in at]))
