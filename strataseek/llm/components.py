"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataseek.llm.common import cut_lineage


def _stars(links: DataFrame, large: bool) -> DataFrame:
    both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.filter("b < a")
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    if large:
        moved = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = both.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionAll(least.select("a", F.col("m").alias("b")))
    return moved.filter("a != b").distinct()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(v, label) of every vertex of the links (a, b): label is the smallest vertex it is joined with.

    Null ends are left out. Each round is written to the shared folder, and the number of rounds
    grows with the logarithm of the longest chain. A vertex with many links is one row per link in
    its joins, which adaptive execution splits.
    """
    links = cut_lineage(links.filter("a is not null and b is not null and a != b")
                        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    seen = None
    while True:
        mark = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        links = cut_lineage(_stars(_stars(links, large=True), large=False), name)
    return links.select(F.col("a").alias("v"), F.col("b").alias("label")) \
        .unionAll(links.select(F.col("b").alias("v"), F.col("b").alias("label"))).distinct()
