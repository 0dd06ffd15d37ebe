import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import plan_of
from strataseek.functions import vectors
from strataseek.operators import index_table
from strataseek.operators.embed import embed_hashing, embed_with_model, extract_with
from strataseek.operators.fulltext import (bm25_joined, bm25_top_k, document_frequency,
                                           normalise_scores, with_tokens)
from strataseek.operators.hybrid import fuse_ranks
from strataseek.operators.vector_search import (assign_cells, exact_top_k, ivf_top_k, lsh_top_k,
                                                recall_at_k, train_cells, with_buckets)
from strataseek.plans.retrieval import (SearchIndex, embed_queries, search, search_all_methods)
from strataseek.plans import searchbench


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def vectors_df(spark):
    rnd = np.random.default_rng(4)
    made = rnd.normal(size=(900, 16))
    made[300:600] = made[0]  # a third of the rows are copies
    made[600] = 0
    data = [(f"k{i:04d}", [float(x) for x in v]) for i, v in enumerate(made)]
    data += [("null", None), ("short", [1.0, 2.0])]
    corpus = spark.createDataFrame(data, "chunk_id string, embedding array<double>") \
        .repartition(6)
    asked = [made[0], made[5], rnd.normal(size=16), np.zeros(16)]
    queries = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(asked)],
                                    "query_id long, query_vector array<double>")
    return corpus, queries, made, asked


def brute(made, asked, k, metric):
    out = []
    for q, goal in enumerate(asked):
        scored = []
        for i, v in enumerate(made):
            if metric == "cosine":
                scale = np.linalg.norm(v) * np.linalg.norm(goal)
                if scale == 0:
                    continue
                s = float(v @ goal / scale)
            elif metric == "dot":
                s = float(v @ goal)
            else:
                s = float(1 / (1 + ((v - goal) ** 2).sum()))
            scored.append((-round(s, 9), f"k{i:04d}"))
        out += [(q, n, key) for n, (_, key) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
def test_exact_top_k(vectors_df, metric):
    corpus, queries, made, asked = vectors_df
    found = exact_top_k(corpus, queries, 7, metric)
    assert rows(found, "query_id", "rank", "chunk_id") == brute(made, asked, 7, metric)
    assert "WindowGroupLimit" in plan_of(found)
    tiled = exact_top_k(corpus, queries, 7, metric, max_queries=2)
    assert rows(tiled, "query_id", "rank", "chunk_id") == brute(made, asked, 7, metric)


def test_ivf_with_all_cells_is_exact_and_recall_grows(vectors_df):
    corpus, queries, made, asked = vectors_df
    good = corpus.filter(F.size("embedding") == 16)
    model = train_cells(good, 6)
    indexed = assign_cells(good, model)
    exact = exact_top_k(good, queries, 10)
    full = ivf_top_k(indexed, model, queries, 6, 10)
    assert rows(full, "query_id", "rank", "chunk_id") == rows(exact, "query_id", "rank",
                                                             "chunk_id")
    recalls = []
    for probes in (1, 3, 6):
        part = ivf_top_k(indexed, model, queries, probes, 10)
        recalls.append(recall_at_k(part, exact, 10).agg(F.avg("recall")).first()[0])
    assert recalls == sorted(recalls) and recalls[-1] == 1.0 and recalls[0] > 0
    beyond = ivf_top_k(indexed, model, queries, 2, 10, max_queries=1)
    assert rows(beyond, "query_id", "rank", "chunk_id") == rows(
        ivf_top_k(indexed, model, queries, 2, 10), "query_id", "rank", "chunk_id")


def test_lsh_returns_exact_scores(vectors_df):
    corpus, queries, *_ = vectors_df
    good = corpus.filter(F.size("embedding") == 16)
    exact = {(r.query_id, r.chunk_id): r.score
             for r in exact_top_k(good, queries, 1000).collect()}
    found = lsh_top_k(good, queries, 10, bucket_length=1.0, tables=6).collect()
    assert found and all(exact[(r.query_id, r.chunk_id)] == r.score for r in found)
    stored = lsh_top_k(with_buckets(good, 16, 1.0, 6), queries, 10, bucket_length=1.0, tables=6, max_queries=1)
    assert rows(stored, "query_id", "rank", "chunk_id") == sorted(
        (r.query_id, r["rank"], r.chunk_id) for r in found)
    # a query equal to stored rows shares all their buckets
    assert [r.chunk_id for r in found if r.query_id == 0 and r.rank == 1] == ["k0000"]


def test_native_similarity_equals_numpy(vectors_df):
    corpus, _, made, asked = vectors_df
    goal = F.array(*[F.lit(float(x)) for x in asked[2]])
    good = corpus.filter(F.size("embedding") == 16)
    for metric in vectors.METRICS:
        got = {r[0]: r[1] for r in good.select(
            "chunk_id", vectors.similarity("embedding", goal, metric)).collect()}
        for i in (0, 7, 600):
            v, g = made[i], asked[2]
            want = {"dot": v @ g, "l2": 1 / (1 + ((v - g) ** 2).sum()),
                    "cosine": None if i == 600 else
                    v @ g / np.linalg.norm(v) / np.linalg.norm(g)}[metric]
            assert got[f"k{i:04d}"] == (None if want is None else pytest.approx(want))


WORDS = "river stone cloud ember frost maple north quiet signal tundra".split()


@pytest.fixture(scope="module")
def library(spark):
    rnd = random.Random(8)
    texts = [" ".join(rnd.choices(WORDS, k=rnd.randint(3, 40))) for _ in range(300)]
    texts[100:200] = ["river stone"] * 100
    texts += ["", "!!!"]
    df = spark.createDataFrame([(f"c{i:03d}", f"f{i}", t) for i, t in enumerate(texts)],
                               "chunk_id string, file_name string, chunk_text string")
    table = embed_hashing(with_tokens(df)).repartition(5).persist()
    queries = spark.createDataFrame(
        [(1, "river river stone", ["river"], "x"), (2, "ember", ["ember", "gone"], "x"),
         (3, "unknown words only", ["none"], "y"), (4, "Quiet, SIGNAL frost", ["quiet"], "y")],
        "query_id long, query string, keywords array<string>, category string")
    return table, queries, texts


def test_bm25_scan_equals_join_and_brute_force(library):
    import math
    table, queries, texts = library
    scan = bm25_top_k(table, queries, 9)
    join = bm25_joined(table, queries, 9)
    stored = bm25_top_k(table, queries, 9, lexicon=document_frequency(table))
    beyond = bm25_top_k(table, queries, 9, max_queries=2)
    key = ("query_id", "rank", "chunk_id")
    assert rows(scan, *key) == rows(join, *key) == rows(stored, *key) == rows(beyond, *key)
    split = [t.split() if t != "!!!" else [] for t in texts]
    n, avg = len(split), sum(map(len, split)) / len(split)
    want = {}
    for term in ("river", "stone"):
        df = sum(term in s for s in split)
        for i, s in enumerate(split):
            tf = s.count(term)
            if tf:
                want[i] = want.get(i, 0) + math.log(1 + (n - df + .5) / (df + .5)) * tf * 2.2 / (
                    tf + 1.2 * (0.25 + 0.75 * len(s) / avg))
    best = sorted(want, key=lambda i: (-round(want[i], 9), i))[:9]
    got = sorted((r.rank, r.chunk_id, r.score) for r in scan.filter("query_id = 1").collect())
    assert [g[1] for g in got] == [f"c{i:03d}" for i in best]
    assert [g[2] for g in got] == pytest.approx([want[i] for i in best])
    assert scan.filter("query_id = 3").count() == 0


def test_normalise(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 4.0), (1, 3.0), (2, 5.0), (2, 5.0), (3, 1.0)],
                               "query_id long, score double")
    got = rows(normalise_scores(df), "query_id", "normalized_score")
    assert got == [(1, 0.0), (1, 0.5), (1, 1.0), (2, 0.0), (2, 0.0), (3, 0.0)]


def test_fusion(spark):
    schema = "query_id long, chunk_id string, score double, rank int"
    a = spark.createDataFrame([(1, "x", .9, 1), (1, "y", .8, 2)], schema)
    b = spark.createDataFrame([(1, "y", 7.0, 1), (1, "z", 6.0, 2)], schema)
    got = {r.chunk_id: r for r in fuse_ranks(a, b, 10).collect()}
    assert got["y"].rank == 1 and got["y"].score == pytest.approx(1 / 61 + 1 / 62)
    assert got["x"].keyword_score is None and got["z"].vector_score is None


def test_search_contract(library):
    table, queries, _ = library
    index = SearchIndex(table, document_frequency(table))
    with pytest.raises(ValueError):
        search(index, queries, "ANN")
    with pytest.raises(ValueError):
        search(index, queries, "HYBRID")
    with pytest.raises(ValueError):
        search(index, queries, "OTHER")
    embedded = embed_queries(queries)
    plain = search(index, queries, "FULL_TEXT", 5, columns=("file_name",))
    with_vector = search(index, embedded, "FULL_TEXT", 5, columns=("file_name",))
    assert rows(plain, "query_id", "rank", "chunk_id") == rows(
        with_vector, "query_id", "rank", "chunk_id")
    assert "file_name" in plain.columns and "chunk_text" not in plain.columns
    hybrid = search(index, embedded, "HYBRID", 5)
    assert {"vector_score", "keyword_score", "keyword_matches"} <= set(hybrid.columns)
    results = search_all_methods(index, embedded, 5)
    assert results.columns == ["query_id", "method", "rank", "chunk_id", "file_name", "text",
                               "score"]


def test_benchmark_runner(spark, library, tmp_path):
    table, queries, _ = library
    runs, results = searchbench.run_benchmark(
        SearchIndex(table), embed_queries(queries), str(tmp_path / "out"), 5, iterations=1)
    assert runs.count() == 4 * 3
    assert runs.filter("not success").select("query_id", "method").distinct().collect() == [
        (3, "Full-Text")]
    averages = searchbench.latency_per_query(runs)
    report = {r.method: r for r in searchbench.report(averages, queries).collect()}
    assert report["ANN"].success_rate == 75.0 or report["ANN"].success_rate == 100.0
    assert report["Full-Text"].success_rate == 75.0
    overlaps = searchbench.overlap(results, queries).collect()
    assert all(o.all_three <= o.ann_ft for o in overlaps)


def test_latency_rules(spark):
    runs = spark.createDataFrame(
        [(1, "a", "ANN", 0, True, 10.0, 5), (1, "a", "ANN", 1, False, 99.0, 0),
         (1, "a", "ANN", 2, True, 20.0, 4), (2, "a", "ANN", 0, False, 1.0, 0),
         (2, "a", "ANN", 1, False, 1.0, 0), (2, "a", "Hybrid", 0, True, 7.0, 3)],
        searchbench.RUN_SCHEMA)
    averages = searchbench.latency_per_query(runs)
    assert rows(averages, "query_id", "method", "avg_latency_ms", "min_latency_ms",
                "max_latency_ms", "num_results") == [
        (1, "ANN", 15.0, 10.0, 20.0, 4), (2, "Hybrid", 7.0, 7.0, 7.0, 3)]
    summary = {r.method: r for r in searchbench.latency_summary(averages).collect()}
    assert summary["ANN"].std is None and summary["ANN"].mean == 15.0
    report = {r.method: r.success_rate for r in searchbench.report(averages, runs).collect()}
    assert report == {"ANN": 50.0, "Hybrid": 50.0}


# ---------------------------------------------------------------- embedding

def test_hashing_embedding(spark):
    df = spark.createDataFrame([("a b b", ), ("", ), ("!!", )], "chunk_text string")
    got = embed_hashing(df, dim=32).collect()
    assert sum(v * v for v in got[0].embedding) == pytest.approx(1) and got[0].embedding_ok
    assert got[1].embedding == [0.0] * 32 and not got[1].embedding_ok and not got[2].embedding_ok


def test_model_hook_and_fallback(spark):
    def load():
        def model(texts):
            if any("boom" in t for t in texts):
                raise RuntimeError("no answer")
            return [[float(len(t)), 1.0] for t in texts]
        return model

    df = spark.createDataFrame([("abc",), ("de",), ("boom",), (None,)], "chunk_text string") \
        .coalesce(1)
    got = embed_with_model(df, load, 2, batch_texts=2).collect()
    assert [r.embedding for r in got] == [[3.0, 1.0], [2.0, 1.0], [0.0, 0.0], [0.0, 0.0]]
    assert [r.embedding_ok for r in got] == [True, True, False, False]
    up = extract_with(df, lambda: lambda texts: [t.upper() for t in texts], "chunk_text", "u")
    assert [r.u for r in up.collect()] == ["ABC", "DE", "BOOM", ""]


# ---------------------------------------------------------------- index table

def test_upsert(spark):
    schema = "chunk_id string, embedding array<double>"
    old = spark.createDataFrame([("a", [1.0, 1.0]), ("b", [2.0, 2.0])], schema)
    new = spark.createDataFrame(
        [("b", [9.0, 9.0], 5), ("b", [3.0, 3.0], 1), ("c", [4.0, 4.0], 0), (None, [1.0, 1.0], 0),
         ("d", [1.0], 0), ("e", None, 0)], schema + ", position long")
    want = [("a", [1.0, 1.0]), ("b", [3.0, 3.0]), ("c", [4.0, 4.0])]
    for limit in (64 << 20, -1):
        once = index_table.upsert(old, new, 2, position="position", broadcast_limit=limit)
        assert rows(once, "chunk_id", "embedding") == want
        twice = index_table.upsert(once, new, 2, position="position", broadcast_limit=limit)
        assert rows(twice, "chunk_id", "embedding") == want
    report = index_table.upsert_report(new, 2).first()
    assert tuple(report) == ("FAILURE", 3, 3)
    failed = [r[0] for r in index_table.failed_keys(new, 2).collect()]
    assert sorted(failed, key=str) == sorted([None, "d", "e"], key=str)
    changes = index_table.change_feed(old, index_table.upsert(old, new, 2, position="position"))
    assert rows(changes, "chunk_id", "change_type") == [("b", "update"), ("c", "insert")]


def test_describe_and_dimension(spark):
    df = spark.createDataFrame([("a", 1, 2, [1.0], True)],
                               "chunk_id string, n int, m long, embedding array<double>, f boolean")
    got = {r.field: r.type for r in index_table.describe_index(df).collect()}
    assert got == {"chunk_id": "string", "n": "int", "m": "long", "embedding": "array<double>",
                   "f": "string"}
    assert index_table.vector_dimension(df) == 1
    with pytest.raises(ValueError):
        index_table.vector_dimension(df.unionByName(df.withColumn("embedding", F.array(
            F.lit(1.0), F.lit(2.0)))))
