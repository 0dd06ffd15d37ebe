"""Work and memory that must not grow with the square of cells or with the rows of a batch."""

import time

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataseek.operators import vector_search as vs
from strataseek.operators.embed import extract_with
from strataseek.operators.quantiser import Quantiser, train


def test_extraction_holds_the_texts_of_one_call(spark):
    rows = spark.range(4000, numPartitions=1).select("id", F.repeat(F.lit("x"), 20_000).alias("content"))

    def load():
        import tracemalloc
        tracemalloc.stop()  # a worker is used again
        tracemalloc.start()

        def model(texts):
            return [str(tracemalloc.get_traced_memory()[1]) for _ in texts]

        return model

    peak = extract_with(rows, load, "content", "peak").agg(F.max(F.col("peak").cast("long"))).first()[0]
    assert peak < 110_000_000  # an Arrow batch holds 64 MB of text; all its texts as objects as much again


def test_all_cells_probed_without_a_table_of_queries_and_cells(spark):
    cells, random = 6000, np.random.default_rng(3)
    centres, vectors = random.normal(size=(cells, 4)), random.normal(size=(300, 4))
    rows = vs.assign_cells(spark.createDataFrame([(f"k{i:03d}", random.normal(size=4).tolist()) for i in range(200)],
                                                 "chunk_id string, embedding array<double>"), centres)
    near = np.broadcast_to(np.arange(cells), (len(vectors), cells))
    started = time.perf_counter()
    scan = vs.cell_scan(rows, vs.VectorBatch(list(range(300)), T.LongType(), vectors, near), cells)
    assert time.perf_counter() - started < 3
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors[:5])], "query_id long, query_vector array<double>")
    order = ["query_id", "rank"]
    assert vs.ivf_top_k(rows, centres, queries, cells, 4).orderBy(*order).collect() \
        == vs.exact_top_k(rows, queries, 4).orderBy(*order).collect()
    assert scan.dim == 4


def test_crowded_cells_are_divided_without_a_literal_map(spark, monkeypatch):
    monkeypatch.setattr(F, "create_map", None)
    random = np.random.default_rng(5)
    rows = spark.createDataFrame([(str(i), (random.normal(size=3) * 0.01 + [1, 0, 0]).tolist()) for i in range(900)]
                                 + [(f"far{i}", random.normal(size=3).tolist()) for i in range(100)],
                                 "chunk_id string, embedding array<double>")
    quantiser = train(rows, 10, 20, sample_rows=200)
    sizes = [r["count"] for r in quantiser.assign(rows).groupBy("cell").count().collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 60
    assert [b.tolist() for b in Quantiser(np.zeros((3, 1)), np.zeros((3, 1)), np.array([2, 0, 2]))._below] == [[1], [], [0, 2]]
