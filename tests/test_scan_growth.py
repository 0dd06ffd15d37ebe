"""Steps of the scans and functions whose work must follow the rows, not rows times something else."""

import hashlib
import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helpers import plan_of
from strataseek.functions import geo, vectors
from strataseek.functions.sql import register_sql_functions
from strataseek.operators import nearest_polygons as nearest_module
from strataseek.operators.fulltext import bm25_joined, bm25_scan, bm25_top_k, with_tokens
from strataseek.operators.topk import BestRows


def test_token_buckets_are_counted_in_one_pass(spark):
    texts = ["a b c a", None, "", "...", "x " * 700, "q w e r t y u i o p " * 9]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string").select(
        "id", vectors.hashing_embedding("t", 300).alias("v"))
    assert "array_remove" not in plan_of(rows)  # a pass over the tokens for every bucket
    for r in rows.collect():
        counts = np.zeros(300)
        for token in (texts[r.id] or "").replace(".", " ").split():
            counts[int(hashlib.md5(token.encode()).hexdigest()[:8], 16) % 300] += 1
        assert r.v == pytest.approx(list(counts / (np.linalg.norm(counts) or 1.0)), abs=1e-15)


def test_scorer_memory_follows_the_terms_found(spark):
    vocabulary = [f"w{i}" for i in range(100_000)]
    rows = spark.createDataFrame([(f"k{i:03d}", [f"w{i * 37 % 100_000}", "w1", "w1"]) for i in range(200)], "chunk_id string, tokens array<string>")
    queries = spark.createDataFrame([(q, " ".join(vocabulary[q::40])) for q in range(40)], "query_id long, query string")
    lexicon = spark.createDataFrame(pd.DataFrame({"term": vocabulary, "df": 3}))
    scan = bm25_scan(rows, queries, lexicon=lexicon, size=(200, 3.0))
    batch = pa.RecordBatch.from_arrays([pa.array([f"k{i:03d}" for i in range(200)]), pa.array([[f"w{i * 37 % 100_000}", "w1", "w1"] for i in range(200)]),
                                        pa.array([3] * 200, pa.int32())], names=["chunk_id", "hits", "length"])
    tracemalloc.start()
    scored = sum(int(np.isfinite(scores).sum()) for _, _, scores in scan.scorer(batch))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert scored == 200 + sum(i * 37 % 40 != 1 for i in range(200))
    assert peak < 8_000_000  # rows times all terms of the queries takes 32 MB at a time


def test_rare_and_common_terms_score_as_joined(spark):
    random = np.random.default_rng(5)
    words = [f"w{i}" for i in range(60)]
    share = np.r_[np.full(5, 0.1), np.full(55, 0.5 / 55)]
    texts = [" ".join(random.choice(words, 12, p=share)) for _ in range(400)]
    rows = with_tokens(spark.createDataFrame([(f"k{i:03d}", t) for i, t in enumerate(texts)], "chunk_id string, chunk_text string").repartition(4))
    queries = spark.createDataFrame([(q, " ".join(random.choice(words, 4, p=share)) + " absent") for q in range(50)] + [(90, ""), (91, None)],
                                    "query_id long, query string")

    def told(df):
        return {(r.query_id, r.rank): (r.chunk_id, pytest.approx(r.score, rel=1e-8)) for r in df.collect()}

    assert told(bm25_top_k(rows, queries, 7)) == told(bm25_joined(rows, queries, 7))


def test_best_rows_of_blocks_with_ties_and_gaps():
    random = np.random.default_rng(6)
    scores = np.round(random.normal(size=(900, 4)), 1)
    scores[random.random(scores.shape) < 0.3] = np.nan
    scores[5, 0], scores[6, 1], scores[:, 3] = np.inf, -np.inf, np.nan
    best = BestRows(4, 6, pa.int64())
    for low in range(0, 900, 50):
        batch = pa.RecordBatch.from_pydict({"key": pa.array(range(low, low + 50), pa.int64())})
        best.offer_matrix(batch, np.arange(50), np.arange(4), scores[low:low + 50], None)
    want = [(q, k) for q in range(4) for _, k in sorted((-s, k) for k, s in enumerate(scores[:, q]) if np.isfinite(s))[:6]]
    assert list(zip(best.held["query"].to_pylist(), best.held["key"].to_pylist())) == want


def test_distances_of_a_batch_of_pairs(spark):
    random = np.random.default_rng(7)
    shapes = ["POLYGON((0 0,4 0,4 4,0 4,0 0))", "POLYGON((0 0,10 0,10 10,0 10,0 0),(2 2,8 2,8 8,2 8,2 2))", "POLYGON EMPTY",
              "MULTIPOLYGON(((0 0,1 0,1 1,0 1,0 0)),((5 5,6 5,6 7,5 5)))", "POLYGON((1 1,1 1,1 1,1 1))", "POLYGON((0 0,1e999 0,1 1,0 0))"]
    places = [(float(x), float(y)) for x, y in [*np.round(random.uniform(-2, 12, (60, 2)), 1), (4, 2), (1, 1), (0, 0), (np.inf, 1), (5, -np.inf)]]
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(places)], "id int, px double, py double")
    pairs = points.crossJoin(spark.createDataFrame([(s,) for s in shapes], "wkt string")).withColumn("edges", geo.st_edges(geo.st_rings("wkt")))
    both = pairs.select("id", "wkt", nearest_module._distances("edges", "px", "py").alias("a"), geo.edges_distance("edges", "px", "py").alias("b"))
    assert both.count() == len(places) * len(shapes)
    assert both.filter(~F.col("a").eqNullSafe(F.col("b"))).collect() == []


def test_sql_functions_parse_a_polygon_once(spark):
    register_sql_functions(spark)
    rows = spark.createDataFrame([("POLYGON((0 0,4 0,4 4,0 4,0 0))", "POINT(1 1)")], "w string, p string").repartition(1)
    for name in ("st_contains", "st_intersects", "st_distance_polygon"):
        assert plan_of(rows.select(F.expr(f"{name}(w, p)"))).count("forall(regexp_extract_all") <= 1
