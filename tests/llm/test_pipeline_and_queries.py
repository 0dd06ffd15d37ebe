"""Operator 6, the registered queries against their SQL, and every stage of the pipeline on its own input."""

import math

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import shingles, words

from strataseek.llm import hilbert_search, line_dedup
from strataseek.llm.queries import llm_oracles, llm_queries

SMALL = "/root/testdata/sf0.001"


def test_hilbert_numbers_are_a_curve():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    numbers = hilbert_search.hilbert_number(cells, 3)
    assert sorted(numbers) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(numbers)], axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("block_rows", [2048, 40])
def test_nearest_neighbours(spark, block_rows, monkeypatch):
    monkeypatch.setattr(hilbert_search, "BLOCK_ROWS", block_rows)
    random = np.random.default_rng(5)
    vectors = random.normal(size=(1200, 12))
    vectors[300:700] = vectors[0]  # a third of the rows are one vector
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(2000, None), (2100, [0.0] * 12), (2200, [1.0] * 11 + [None]), (2300, [math.nan] * 12),
             (2400, [math.inf] * 12), (2500, [1.0, 2.0]), (None, [1.0] * 12), (100, rows[100][1])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found = hilbert_search.search(table, table.filter("vec_id % 100 = 0")).collect()
    by_query = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        by_query.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    assert set(by_query) == set(range(0, 1200, 100))
    right = 0
    for q, got in by_query.items():
        distance = np.sqrt(((vectors - vectors[q]) ** 2).sum(1))
        expected = sorted((d, i) for i, d in enumerate(distance.tolist()) if i != q)[:10]
        assert len(got) == 10 and got == sorted(got) and all(math.isclose(s, distance[i], abs_tol=0) for s, i in got)
        right += len({i for _, i in expected} & {i for _, i in got})
    assert right >= 0.9 * 10 * len(by_query)
    assert hilbert_search.search(table.limit(0), table.limit(0)).count() == 0


def connection():
    con = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_queries_with_sql(spark, name):
    df = llm_queries()[name](spark, SMALL)
    cursor = connection().execute(llm_oracles()[name])
    columns = sorted(df.columns)
    assert sorted(d[0] for d in cursor.description) == columns
    order = [[d[0] for d in cursor.description].index(c) for c in columns]
    assert sorted(tuple(r[c] for c in columns) for r in df.collect()) == sorted(
        tuple(r[i] for i in order) for r in cursor.fetchall())


def test_pipeline_stages(spark):
    """Each stage on what the one before it kept, against brute force."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        kept[name] = (docs, spark.createDataFrame(out.toArrow(), out.schema))
        docs = kept[name][1]
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns

    before, after = kept["line dedup"]
    con = duckdb.connect()
    con.register("documents", before.toArrow())
    expected = {r[0]: r[3] for r in con.execute(line_dedup.RUNS_ORACLE).fetchall()}
    got = {r["doc_id"]: r["m"] for r in after.select("doc_id", F.md5(F.col("text").cast("binary")).alias("m")).collect()}
    assert got == expected and after.filter("n_chars != length(text)").count() == 0

    before, after = ({r["doc_id"]: r["text"] for r in df.collect()} for df in kept["n-gram Jaccard join"])
    sets = {i: shingles(t) for i, t in before.items()}
    gone = set()
    for i in sorted(sets):
        near = [j for j in sets if j < i and sets[j] and sets[i]
                and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
        gone |= {i} if near else set()
    assert set(after) == set(before) - gone

    before, after = ({r["doc_id"]: r["text"] for r in df.collect()} for df in kept["benchmark decontamination"])
    items = [" ".join(w.decode() for w in words(t)) for t, in connection().execute("SELECT text FROM benchmark").fetchall()]
    leaks = {i for i, t in before.items() if any(x in " ".join(w.decode() for w in words(t)) for x in items)}
    assert leaks and not leaks & set(after) and len(before) - len(after) <= len(leaks) + 1

    last = kept["SentencePiece encoding"][1]
    assert last.filter("not parity or not round_trip or size(input_ids) != n_tokens").count() == 0
    assert kept["toxicity"][1].count() < kept["toxicity"][0].count()
