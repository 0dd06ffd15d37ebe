"""Search benchmark: timed runs, and the tables that compare the methods."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataseek.functions.text import label
from strataseek.operators.quantiles import exact_quantiles
from strataseek.operators.topk import MAX_QUERY_ROWS
from strataseek.plans.retrieval import METHODS, SearchIndex, as_results, search
from strataseek.session import held_locally

_QUERY_TYPES = {"ANN": "ANN", "Full-Text": "FULL_TEXT", "Hybrid": "HYBRID"}
RUN_SCHEMA = ("query_id bigint, category string, method string, iteration int, "
              "success boolean, latency_ms double, num_results int")


def run_benchmark(index: SearchIndex, queries: DataFrame, out_path: str, num_results: int = 10,
                  iterations: int = 3) -> tuple[DataFrame, DataFrame]:
    """Time every query alone with every method ``iterations`` times.

    Returns ``(runs, results)``: a row per query, method and iteration, and the results of the whole
    set, which are searched once per method as a batch and kept in ``out_path``. The query set is a
    short list that someone has chosen; more than ``MAX_QUERY_ROWS`` are refused.
    """
    spark = queries.sparkSession
    asked = held_locally(queries, MAX_QUERY_ROWS)
    if asked is None:
        raise ValueError(f"a benchmark takes at most {MAX_QUERY_ROWS} queries")
    rows = asked.toArrow()
    timings = []
    for method in METHODS:
        score = "normalized_score" if method == "Full-Text" else "score"
        for iteration in range(iterations):
            for i in range(rows.num_rows):
                one = rows.slice(i, 1)
                started = time.perf_counter()
                found = search(index, spark.createDataFrame(one, queries.schema), _QUERY_TYPES[method], num_results)
                n = len(as_results(found, method, score).collect())
                latency = (time.perf_counter() - started) * 1000
                timings.append((one.column("query_id")[0].as_py(), method, iteration, n > 0, latency, n))
        whole = search(index, asked, _QUERY_TYPES[method], num_results)
        as_results(whole, method, score).write.mode("overwrite").parquet(f"{out_path}/method={method}")
    results = spark.read.option("basePath", out_path).parquet(out_path)
    timed = spark.createDataFrame(timings, "query_id bigint, method string, iteration int, "
                                           "success boolean, latency_ms double, num_results int")
    runs = timed.join(F.broadcast(asked.select("query_id", "category")), "query_id").select(
        "query_id", "category", "method", "iteration", "success", "latency_ms", "num_results")
    return runs, results


def latency_per_query(runs: DataFrame) -> DataFrame:
    """Average, smallest and largest latency of the successful runs per query and method.

    ``num_results`` is that of the last run. Pairs without a successful run are absent.
    """
    good = F.col("success")
    return (runs.groupBy("query_id", "category", "method")
            .agg(F.avg(F.when(good, F.col("latency_ms"))).alias("avg_latency_ms"),
                 F.min(F.when(good, F.col("latency_ms"))).alias("min_latency_ms"),
                 F.max(F.when(good, F.col("latency_ms"))).alias("max_latency_ms"),
                 F.max_by("num_results", "iteration").alias("num_results"))
            .filter(F.col("avg_latency_ms").isNotNull()))


def _summary(df: DataFrame, value: str) -> DataFrame:
    return df.groupBy("method").agg(
        F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"),
        F.stddev_samp(value).alias("std"))


def latency_summary(per_query: DataFrame) -> DataFrame:
    """Mean, min, max and sample deviation of the query averages per method."""
    return _summary(per_query, "avg_latency_ms")


def score_summary(results: DataFrame) -> DataFrame:
    return _summary(results, "score")


def _pivot(df: DataFrame, value: str) -> DataFrame:
    return df.groupBy("category").pivot("method", list(METHODS)).agg(F.avg(value))


def latency_pivot(per_query: DataFrame) -> DataFrame:
    return _pivot(per_query, "avg_latency_ms")


def score_pivot(results: DataFrame, queries: DataFrame) -> DataFrame:
    return _pivot(results.join(queries.select("query_id", "category"), "query_id"), "score")


FIVE_NUMBERS = {"lowest": 0.0, "quartile_1": 0.25, "median": 0.5, "quartile_3": 0.75,
                "highest": 1.0}


def box_stats(df: DataFrame, value: str, measure: str) -> DataFrame:
    """Five-number summary per method (exact quantiles)."""
    return (exact_quantiles(df, "method", value, FIVE_NUMBERS)
            .select("method", F.lit(measure).alias("measure"), *FIVE_NUMBERS))


def report(per_query: DataFrame, queries: DataFrame) -> DataFrame:
    """Success rate in percent and latency figures per method; methods that never
    succeeded are absent."""
    total = queries.agg(F.count_distinct("query_id").alias("n")).scalar()
    return (per_query.groupBy("method")
            .agg(F.count_distinct("query_id").alias("succeeded"),
                 F.avg("avg_latency_ms").alias("avg_latency"),
                 F.min("avg_latency_ms").alias("min_latency"),
                 F.max("avg_latency_ms").alias("max_latency"),
                 F.avg("num_results").alias("avg_results"))
            .select("method", (F.col("succeeded") / total * 100).alias("success_rate"),
                    "avg_latency", "min_latency", "max_latency", "avg_results"))


def overlap(results: DataFrame, queries: DataFrame) -> DataFrame:
    """Per query: how many chunks the methods share, and how many each returned.

    The result sets hold at most ``num_results`` ids per query and method.
    """
    sets = results.groupBy("query_id").agg(*[
        F.collect_set(F.when(F.col("method") == m, F.col("chunk_id"))).alias(c)
        for m, c in zip(METHODS, ("ann", "ft", "hybrid"))])
    both = F.array_intersect
    none = F.array().cast("array<string>")
    named = queries.select("query_id", "query", "category").join(sets, "query_id", "left")
    for c in ("ann", "ft", "hybrid"):
        named = named.withColumn(c, F.coalesce(c, none))
    return named.select(
        "query_id", label("query", 40).alias("query_label"), "category",
        F.size(both("ann", "ft")).alias("ann_ft"),
        F.size(both("ann", "hybrid")).alias("ann_hybrid"),
        F.size(both("ft", "hybrid")).alias("ft_hybrid"),
        F.size(both(both("ann", "ft"), F.col("hybrid"))).alias("all_three"),
        F.size("ann").alias("ann_results"), F.size("ft").alias("ft_results"),
        F.size("hybrid").alias("hybrid_results"))


OVERLAP_COLUMNS = ("ann_ft", "ann_hybrid", "ft_hybrid", "all_three", "ann_results",
                   "ft_results", "hybrid_results")


def overlap_mean(overlaps: DataFrame) -> DataFrame:
    return overlaps.agg(*[F.avg(c).alias(c) for c in OVERLAP_COLUMNS])


def keyword_hit_rate(results: DataFrame, queries: DataFrame, rows: DataFrame) -> DataFrame:
    """Per method: share of returned chunks that hold at least one expected keyword."""
    text = F.lower("chunk_text")
    hit = F.exists("keywords", lambda w: F.contains(text, F.lower(w)))
    return (results.select("query_id", "method", "chunk_id")
            .join(queries.select("query_id", "keywords"), "query_id")
            .join(rows.select("chunk_id", "chunk_text"), "chunk_id")
            .groupBy("method")
            .agg(F.count(F.lit(1)).alias("returned"), F.count_if(hit).alias("hits"),
                 F.avg(hit.cast("int")).alias("hit_rate")))


def side_by_side(results: DataFrame, hybrid: DataFrame, k: int = 3) -> DataFrame:
    """First ``k`` results of every method per query; hybrid rows also show the scores
    of their parts and the keyword matches."""
    parts = hybrid.select("query_id", F.lit("Hybrid").alias("method"), "chunk_id",
                          "vector_score", "keyword_score", "keyword_matches")
    return (results.filter(F.col("rank") <= k)
            .join(parts, ["query_id", "method", "chunk_id"], "left"))


def results_json(per_query: DataFrame, results: DataFrame) -> DataFrame:
    """One JSON object per query and method: figures and the ordered result list."""
    listed = results.groupBy("query_id", "method").agg(F.array_sort(F.collect_list(
        F.struct("rank", "chunk_id", "file_name", "score"))).alias("results"))
    joined = per_query.join(listed, ["query_id", "method"], "left")
    return joined.select("query_id", "method", F.to_json(F.struct(
        "category", "avg_latency_ms", "num_results", "results")).alias("json"))
