"""Postings blocks: packing, pruned top-k against a full sum, blocks that stay closed."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strataseek.operators import block_postings
from strataseek.operators.fulltext import bm25_top_k, corpus_size
from strataseek.operators.topk import significant


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 70_000), st.integers(1, 80_000), st.integers(1, 90_000)), min_size=1, max_size=40,
                unique_by=lambda x: x[0]))
def test_packing_gives_the_entries_back(entries):
    numbers, tf, length = (np.array(x) for x in zip(*sorted(entries)))
    raw = block_postings.pack(numbers, tf, length)
    assert all((a == b).all() for a, b in zip(block_postings.unpack(raw, len(numbers), int(numbers[0])), (numbers, tf, length)))


def corpus(rows, seed=0):
    random = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(1500)]
    share = 1 / np.arange(1, 1501)
    return [[words[j] for j in random.choice(1500, random.integers(1, 90), p=share / share.sum())] for _ in range(rows)]


def full_scores(docs, weights):
    average = np.mean([len(d) for d in docs])
    out = np.zeros(len(docs))
    for i, d in enumerate(docs):
        held = Counter(d)
        out[i] = sum(idf * held[t] * 2.2 / (held[t] + 1.2 * (0.25 + 0.75 * len(d) / average)) for t, idf in weights.items() if held[t])
    return significant(out)


@pytest.mark.parametrize("terms, k", [(1, 10), (3, 1), (8, 10), (60, 10), (200, 3), (30, 5000)])
def test_pruned_top_k_is_that_of_the_full_sum(terms, k):
    docs = corpus(4000)
    docs[100:400] = [docs[50]] * 300  # many rows on one score
    table = pa.table({"chunk_id": [f"c{i:05d}" for i in range(len(docs))], "tokens": docs, "shard": pa.array([0] * len(docs), pa.int32())})
    blocks = block_postings._blocks("chunk_id", 64)(table)
    held = Counter(t for d in docs for t in set(d))
    random = np.random.default_rng(terms)
    weights = {t: math.log(1 + (len(docs) - held[t] + 0.5) / (held[t] + 0.5)) for t in random.choice(sorted(held), terms, replace=False)}
    shard = block_postings.ShardPostings(blocks, np.mean([len(d) for d in docs]))
    rows, scores = shard.top_k(weights, k)
    expected = full_scores(docs, weights)
    best = [i for i in sorted(range(len(docs)), key=lambda i: (-expected[i], i)) if expected[i] > 0][:k]
    assert rows.tolist() == best and scores.tolist() == expected[best].tolist()


def test_blocks_stay_closed():
    docs = corpus(6000, 1)
    for i in range(0, 6000, 700):
        docs[i] = ["rare", "seldom", *docs[i][:5]]
    table = pa.table({"chunk_id": [f"c{i:05d}" for i in range(len(docs))], "tokens": docs, "shard": pa.array([0] * len(docs), pa.int32())})
    blocks = block_postings._blocks("chunk_id", 64)(table)
    weights = {"rare": 6.0, "seldom": 6.0, "w0": 0.05, "w1": 0.2, "w2": 0.3}
    asked = blocks.filter(pa.compute.is_in(blocks["term"], pa.array(list(weights))))
    shard = block_postings.ShardPostings(asked, np.mean([len(d) for d in docs]))
    rows, _ = shard.top_k(weights, 5)
    expected = full_scores(docs, weights)
    assert rows.tolist() == sorted(range(len(docs)), key=lambda i: (-expected[i], i))[:5]
    opened, every = block_postings.count_blocks([shard])
    assert opened < every / 2


def test_dead_rows_are_passed_over():
    table = pa.table({"chunk_id": ["a", "b", "c"], "tokens": [["x"], ["x", "x"], ["x"]], "shard": pa.array([0] * 3, pa.int32())})
    blocks = block_postings._blocks("chunk_id", 2)(table)
    shard = block_postings.ShardPostings(blocks, 1.3, dead=np.array([1, 9]))
    assert shard.top_k({"x": 1.0, "y": 2.0}, 5)[0].tolist() == [0, 2]


def test_tables_equal_the_scan(spark):
    docs = corpus(900, 2)
    rows = spark.createDataFrame([(f"k{i}", d) for i, d in enumerate(docs)] + [("none", []), ("null", None), ("odd", [None, "w1"])],
                                 "chunk_id string, tokens array<string>")
    queries = spark.createDataFrame([(1, "w1 w7 w300"), (2, " ".join(f"w{i}" for i in range(0, 400, 3))), (3, "unknown"), (4, None)],
                                    "query_id long, query string")
    blocks = block_postings.build_blocks(rows, 5, block_entries=16)
    lexicon = block_postings.lexicon_of(blocks)
    numbers = block_postings.shard_numbers(rows, 5)
    got = block_postings.bm25_blocks(blocks, numbers, queries, lexicon, corpus_size(rows), 12)
    want = bm25_top_k(rows, queries, 12)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
