"""The registered scores with contexts of two words, against brute force."""

import pytest
from pyspark.sql import functions as F
from test_corpus_operators import lm_expected
from samples import words

from strataseek.llm.queries import llm_queries

SMALL = "/root/testdata/sf0.001"


def test_registered_query_uses_two_words_of_context(spark):
    texts = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    expected = dict(zip([i for i, _ in texts], lm_expected([words(t) for _, t in texts], 3)))
    found = llm_queries()["op1_lm_scoring"](spark, SMALL)
    assert {r["doc_id"] for r in found.collect()} == set(expected)
    for r in found.collect():
        assert r["log_score"] == pytest.approx(expected[r["doc_id"]], rel=1e-9, abs=1e-4)
    pairs = llm_queries()["op1_lm_scoring_pairs"](spark, SMALL).select("doc_id", F.col("log_score").alias("pairs"))
    assert found.join(pairs, "doc_id").filter("log_score != pairs").count() > 0
