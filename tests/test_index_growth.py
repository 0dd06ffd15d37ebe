"""Steps of the stored index that follow its rows: what goes to Python, what is shuffled, what the driver handles."""

import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strataseek.functions import vectors
from strataseek.operators import block_postings
from strataseek.operators.quantiser import Quantiser
from tests.helpers import plan_of
from workload import landing, queries as q

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def by_hand(rows, shard, size):
    """Blocks of ``(key, tokens)``, one at a time."""
    rows = sorted(rows)
    lengths = np.array([len(t or []) for _, t in rows])
    held = {}
    for number, (_, words) in enumerate(rows):
        for word, times in Counter(w for w in words or [] if w is not None).items():
            held.setdefault(word, []).append((number, times))
    out = []
    for word in sorted(held):
        for block, low in enumerate(range(0, len(held[word]), size)):
            of, tf = (np.array(x) for x in zip(*held[word][low:low + size]))
            out.append((shard, word, block, len(of), of[0], of[-1], tf.max(), lengths[of].min(), block_postings.pack(of, tf, lengths[of])))
    return out


@pytest.mark.parametrize("rows, size", [(1, 4), (37, 4), (701, 16)])
def test_blocks_of_a_shard_are_those_made_one_at_a_time(rows, size):
    random = np.random.default_rng(rows)
    docs = [(f"k{i:04d}", [None if w == 3 else f"w{w}é" for w in random.integers(0, 40, random.integers(0, 30))]) for i in random.permutation(rows)]
    docs[0] = (docs[0][0], ["long"] * 70_000 + [None])
    docs[-1] = (docs[-1][0], None) if rows > 1 else docs[-1]
    table = pa.table({"chunk_id": [k for k, _ in docs], "tokens": pa.array([t for _, t in docs], pa.list_(pa.string())),
                      "shard": pa.array([7] * rows, pa.int32())})
    made = block_postings._blocks("chunk_id", size)(table).to_pylist()
    assert [tuple(r.values()) for r in made] == by_hand(docs, 7, size)


def test_numbers_carry_their_places_without_a_join(spark):
    rows = spark.createDataFrame([("a", 1, 1), ("b", 2, 3), ("b", 2, 4), ("b", 2, 4), (None, 5, 6)] + [(f"k{i}", i, i) for i in range(50)],
                                 "chunk_id string, top int, cell int")
    got = block_postings.shard_numbers(rows, 3, carried=("top", "cell"))
    want = block_postings.shard_numbers(rows, 3).join(rows, "chunk_id").select(*got.columns)
    assert "Join" not in plan_of(got)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_only_vectors_go_to_python(spark):
    rows = spark.createDataFrame([("a", "text", [1.0, 0.0]), ("b", "text", [0.0, 2.0]), ("c", "text", [1.0]), ("d", "text", None)],
                                 "chunk_id string, chunk_text string, embedding array<double>")
    placed = Quantiser.flat(np.eye(2)).assign(rows)
    assert placed.columns == ["chunk_id", "chunk_text", "embedding", "cell", "top"] and "MapInArrow" not in plan_of(placed)
    assert sorted((r.chunk_id, r.cell, r.top) for r in placed.collect()) == [("a", 0, 0), ("b", 1, 0)]


def test_tokens_of_a_batch_get_their_bucket_once(spark):
    rows = spark.createDataFrame([(0, ["a", "b", "a", None, "é"]), (1, []), (2, None), (3, ["é"])], "id int, tokens array<string>")
    made = rows.select("id", vectors.token_embedding("tokens", 16).alias("v"))
    assert "md5" not in plan_of(made)
    buckets = {r.t: r.b for r in rows.select(F.explode("tokens").alias("t")).dropna().select("t", vectors.token_bucket("t", 16).alias("b")).collect()}
    for r in made.collect():
        counts = np.bincount([buckets[t] for t in {0: ["a", "b", "a", "é"], 3: ["é"]}.get(r.id, [])], minlength=16)
        assert np.allclose(r.v, counts / (np.linalg.norm(counts) or 1))


def test_index_build_counts_terms_in_its_own_blocks_only(spark, tmp_path):
    (spark.createDataFrame([(i, f"Sentence {i} about rivers. " * 8, "en", "s", 200) for i in range(20)], DOCUMENTS)
     .write.parquet(f"{tmp_path}/documents.parquet"))
    assert q.all_queries()["index_build"](spark, str(tmp_path)).count() == 20
    assert (spark.sparkContext.applicationId, str(tmp_path), "lexicon") not in landing._tables


def test_many_centres_are_kept_as_arrays(spark, tmp_path):
    random = np.random.default_rng(4)
    Quantiser.flat(np.eye(2)).save(spark, f"{tmp_path}/first")
    made = Quantiser(random.normal(size=(300, 64)), random.normal(size=(60_000, 64)), random.integers(0, 300, 60_000))
    started = time.perf_counter()
    made.save(spark, f"{tmp_path}/cells")
    held = Quantiser.load(spark, f"{tmp_path}/cells")
    assert time.perf_counter() - started < 10
    assert (held.coarse == made.coarse).all() and (held.centres == made.centres).all() and (held.parents == made.parents).all()


def test_only_sums_above_the_floor_are_ordered(monkeypatch):
    random, ordered, partition = np.random.default_rng(8), [], np.partition
    docs = [[f"w{w}" for w in random.integers(0, 60, 20)] for _ in range(20_000)]
    table = pa.table({"chunk_id": [f"k{i:05d}" for i in range(len(docs))], "tokens": docs, "shard": pa.array([0] * len(docs), pa.int32())})
    shard = block_postings.ShardPostings(block_postings._blocks("chunk_id", 64)(table), 20.0)
    monkeypatch.setattr(np, "partition", lambda x, *a: ordered.append(len(x)) or partition(x, *a))
    shard.top_k({f"w{i}": 1.0 + i / 9 for i in range(32)}, 10)
    assert len(ordered) > 3 and sum(ordered) < len(docs)


def test_numbers_of_all_rows_are_not_shuffled_for_few_results(spark):
    rows = spark.createDataFrame([(f"k{i}", [f"w{i % 7}", "all"]) for i in range(300)], "chunk_id string, tokens array<string>")
    queries = spark.createDataFrame([(1, "w1 all"), (2, "w3")], "query_id long, query string")
    blocks, numbers = block_postings.build_blocks(rows, 3), block_postings.shard_numbers(rows, 3)
    found = block_postings.bm25_blocks(blocks, numbers, queries, block_postings.lexicon_of(blocks), (300, 2.0), 5, shards=3)
    assert "SortMergeJoin" not in plan_of(found)
    whole = block_postings.bm25_blocks(blocks, numbers, queries, block_postings.lexicon_of(blocks), (300, 2.0), 5)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, whole.collect())) and found.count() == 10
