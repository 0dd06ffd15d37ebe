"""Columns of the input that are called as operators call their own."""

import pytest
from pyspark.sql import functions as F
from samples import sentence

from strataseek.llm.decontamination import decontaminate
from strataseek.llm.jaccard_join import keep_first
from strataseek.llm.queries import tokenizer_file
from strataseek.llm.sentencepiece import encode_decode
from strataseek.llm.toxicity import score

TAKEN = ("__hit", "__later", "score", "n_tokens", "parity", "input_ids", "a.b")


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(1, sentence(7, 40)), (2, sentence(7, 40)), (3, sentence(8, 40)), (4, None)]
    plain = spark.createDataFrame(rows, "doc_id long, text string")
    return plain, plain.withColumns({c: F.lit(c) for c in TAKEN})


def ids(df):
    return sorted(r["doc_id"] for r in df.collect())


def test_filters_keep_such_columns(spark, documents):
    plain, named = documents
    items = spark.createDataFrame([(1, sentence(8, 40))], "item_id long, text string")
    for run in (keep_first, lambda d: decontaminate(d, items)):
        found = run(named)
        assert ids(found) == ids(run(plain)) and found.columns == named.columns
        assert found.filter("score != 'score'").count() == 0


def test_added_columns_take_the_place_of_such_columns(spark, documents):
    plain, named = documents
    model = spark.createDataFrame([(5, 1.0)], "place int, weight double")
    for run in (lambda d: encode_decode(d, tokenizer_file("piece_bpe_32k.model")), lambda d: score(d, model)):
        found, wanted = run(named), run(plain)
        assert len(set(found.columns)) == len(found.columns)
        assert sorted(found.select(wanted.columns).collect()) == sorted(wanted.collect())
