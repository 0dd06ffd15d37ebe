"""Hybrid search by bounds equals the fusion of complete lists."""

import numpy as np
import pytest

from strataseek.operators import hybrid
from strataseek.operators.fulltext import bm25_top_k
from strataseek.operators.hybrid import fuse_ranks
from strataseek.operators.vector_search import exact_top_k
from strataseek.plans import retrieval
from strataseek.plans.retrieval import SearchIndex, search


def corpus(spark, rows):
    random = np.random.default_rng(8)
    vectors, words = random.normal(size=(rows, 6)), [f"w{i}" for i in range(40)]
    held = [(f"k{i:04d}", [float(x) for x in vectors[i // 2 if i % 9 == 0 else i]],  # some equal vectors and texts
             [words[j] for j in np.random.default_rng(i // 3).integers(0, 40, 3 + i % 7)]) for i in range(rows)]
    held += [("novec", None, ["w1", "w2"]), ("short", [1.0], ["w3"]), ("zero", [0.0] * 6, ["w1"]), ("noword", [1.0] * 6, []),
             ("nulls", [1.0] * 6, None)]
    return spark.createDataFrame(held, "chunk_id string, embedding array<double>, tokens array<string>").repartition(3)


def ranked(df):
    return sorted((r.query_id, r["rank"], r.chunk_id, round(r.score, 9)) for r in df.collect())


@pytest.mark.parametrize("k", [1, 5, 40])
def test_equals_complete_lists(spark, k, monkeypatch):
    rows = corpus(spark, 700)
    queries = spark.createDataFrame(
        [(1, "w1 w5 w9", [1.0, 0.0, 0.5, 0.0, 0.0, 0.0]), (2, "unknown", [0.0, 1.0, 0.0, 0.0, -1.0, 0.0]), (3, "w2 w3", None),
         (4, None, [0.0] * 6), (5, " ".join(f"w{i}" for i in range(40)), [1.0] * 6)],
        "query_id long, query string, query_vector array<double>")
    everything = 10_000
    expected = fuse_ranks(exact_top_k(rows, queries, everything), bm25_top_k(rows, queries, everything), k)
    assert ranked(search(SearchIndex(rows), queries, "HYBRID", k, columns=())) == ranked(expected)
    monkeypatch.setattr(retrieval, "HYBRID_PAIRS", 1)  # one query at a time
    monkeypatch.setattr(hybrid, "_SLICE_CELLS", 70)
    assert ranked(search(SearchIndex(rows), queries, "HYBRID", k, columns=())) == ranked(expected)
