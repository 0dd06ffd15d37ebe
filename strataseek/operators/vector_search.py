"""k-nearest-neighbour search: exact, inverted-file and LSH candidates, recall.

All three use the scan of :mod:`strataseek.operators.topk`; the approximate ones only
skip (row, query) pairs, in the same way for any number of queries. Scores are ``cosine``,
``dot`` or ``l2`` = 1 / (1 + d * d); a zero vector has no cosine and is never returned.
Distances of the rows that can be among the best are taken by direct subtraction.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataseek.operators.topk import MAX_QUERY_ROWS, Refiner, Scorer, blocks, in_batches, scan_top_k


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def score_matrix(rows: np.ndarray, queries: np.ndarray, metric: str) -> np.ndarray:
    """Similarity of every row with every query; NaN where it is undefined."""
    product = rows @ queries.T
    if metric == "dot":
        return product
    row_squares = np.einsum("ij,ij->i", rows, rows)
    query_squares = np.einsum("ij,ij->i", queries, queries)
    if metric == "cosine":
        scale = np.sqrt(row_squares)[:, None] * np.sqrt(query_squares)[None, :]
        return np.divide(product, scale, out=np.full_like(product, np.nan), where=scale > 0)
    if metric == "l2":
        gap = row_squares[:, None] + query_squares[None, :] - 2 * product
        return 1.0 / (1.0 + np.maximum(gap, 0.0))
    raise ValueError(f"unknown metric {metric!r}")


def _usable(df: DataFrame, vector: str, dim: int) -> DataFrame:
    return df.filter(F.size(vector) == dim)


def _dimension(rows) -> int:
    sizes = {len(r[1]) for r in rows if r[1] is not None}
    if len(sizes) > 1:
        raise ValueError(f"query vectors have different lengths: {sorted(sizes)}")
    return sizes.pop() if sizes else 0


@dataclass
class VectorScan:
    """One query batch, ready for a scan: the rows to read and how to score them."""

    corpus: DataFrame
    ids: list
    id_type: T.DataType
    scorer: Scorer
    refine: Refiner | None
    columns: tuple[str, ...] = ()
    dim: int = 0


def _batch(queries: DataFrame, query_id: str, vector: str) -> tuple[list, np.ndarray]:
    rows = [r for r in queries.select(query_id, vector).collect() if r[1] is not None]
    return [r[0] for r in rows], np.array([r[1] for r in rows], np.float64).reshape(len(rows), _dimension(rows))


def _refiner(wanted: np.ndarray, dim: int, metric: str) -> Refiner | None:
    if metric != "l2":
        return None

    def refine(batch: pa.RecordBatch, rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
        values = _matrix(batch.column(1), dim)
        out = np.empty(len(rows))
        for part in blocks(len(rows), dim):
            out[part] = ((values[rows[part]] - wanted[queries[part]]) ** 2).sum(1)
        return 1.0 / (1.0 + out)

    return refine


def exact_scan(corpus: DataFrame, queries: DataFrame, metric: str = "cosine", key: str = "chunk_id",
               vector: str = "embedding", query_id: str = "query_id",
               query_vector: str = "query_vector") -> VectorScan:
    ids, wanted = _batch(queries, query_id, query_vector)
    dim = wanted.shape[1]

    def scorer(batch: pa.RecordBatch):
        values = _matrix(batch.column(1), dim)
        every = np.arange(len(wanted))
        for part in blocks(len(values), max(len(wanted), dim)):
            yield part, every, score_matrix(values[part], wanted, metric)

    return VectorScan(_usable(corpus.select(key, vector), vector, dim), ids,
                      queries.schema[query_id].dataType, scorer, _refiner(wanted, dim, metric), (vector,), dim)


def _top_k(scan: VectorScan, k: int) -> DataFrame:
    return scan_top_k(scan.corpus, scan.scorer, scan.ids, scan.id_type, k, scan.refine)


def exact_top_k(corpus: DataFrame, queries: DataFrame, k: int = 10, metric: str = "cosine",
                key: str = "chunk_id", vector: str = "embedding", query_id: str = "query_id",
                query_vector: str = "query_vector", max_queries: int = MAX_QUERY_ROWS) -> DataFrame:
    """The ``k`` best corpus rows per query: ``query_id, <key>, score, rank``.

    More than ``max_queries`` queries are answered in several scans of that many.
    """
    return in_batches(queries, query_id, max_queries, lambda part: _top_k(
        exact_scan(corpus, part, metric, key, vector, query_id, query_vector), k))


# ---------------------------------------------------------------- inverted file

def train_cells(corpus: DataFrame, cells: int, vector: str = "embedding", seed: int = 7,
                iterations: int = 20, train_fraction: float | None = None) -> KMeansModel:
    """k-means centroids of the index. ``train_fraction`` trains on part of the rows;
    every row is assigned to a cell either way."""
    train = corpus.select(array_to_vector(F.col(vector).cast("array<double>")).alias("features"))
    if train_fraction is not None:
        train = train.sample(fraction=train_fraction, seed=seed)
    return KMeans(k=cells, seed=seed, maxIter=iterations, featuresCol="features").fit(train)


def _centres(cells: KMeansModel | np.ndarray) -> np.ndarray:
    return np.array(cells.clusterCenters() if isinstance(cells, KMeansModel) else cells, np.float64)


def _gaps(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, up to a term that is the same for all centres of a row."""
    return (centres ** 2).sum(1)[None, :] - 2 * rows @ centres.T


def _append(corpus: DataFrame, column: str, kind: T.DataType, vector: str, dim: int,
            value: Callable[[np.ndarray], pa.Array]) -> DataFrame:
    schema = T.StructType([*corpus.schema.fields, T.StructField(column, kind)])
    place = corpus.columns.index(vector)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, value(_matrix(batch.column(place), dim))],
                                             names=schema.names)

    return _usable(corpus, vector, dim).mapInArrow(run, schema)


def assign_cells(corpus: DataFrame, cells: KMeansModel | np.ndarray, vector: str = "embedding",
                 cell: str = "cell") -> DataFrame:
    """Nearest centroid per row (the first of equals), a narrow map; write ``partitionBy(cell)``."""
    centres = _centres(cells)
    return _append(corpus, cell, T.IntegerType(), vector, centres.shape[1],
                   lambda values: pa.array(_gaps(values, centres).argmin(axis=1), pa.int32()))


@dataclass
class VectorBatch:
    """Queries of one batch and the cells that each of them probes."""

    ids: list
    id_type: T.DataType
    vectors: np.ndarray
    near: np.ndarray


def cell_scan(rows: DataFrame, batch: VectorBatch, cells: int, metric: str = "cosine", key: str = "chunk_id",
              vector: str = "embedding", cell: str = "cell") -> VectorScan:
    """The scan of a batch over rows with a cell: a row meets the queries that probe its cell."""
    wanted, dim = batch.vectors, batch.vectors.shape[1]
    if batch.near.shape[1] >= cells:  # every row meets every query, whatever its cell
        def score_all(part_of_rows: pa.RecordBatch):
            values, every = _matrix(part_of_rows.column(1), dim), np.arange(len(wanted))
            for part in blocks(len(values), max(len(wanted), dim)):
                yield part, every, score_matrix(values[part], wanted, metric)

        return VectorScan(_usable(rows.select(key, vector, cell), vector, dim), batch.ids, batch.id_type, score_all,
                          _refiner(wanted, dim, metric), (vector, cell), dim)
    # the queries of each cell, from one pass over the pairs
    pairs = np.unique(np.c_[batch.near.ravel(), np.repeat(np.arange(len(wanted)), batch.near.shape[1])], axis=0)
    used, begins = np.unique(pairs[:, 0], return_index=True)
    probing = dict(zip(used.tolist(), np.split(pairs[:, 1], begins[1:])))
    used, none = used.tolist(), np.zeros(0, int)

    def scorer(part_of_rows: pa.RecordBatch):
        values = _matrix(part_of_rows.column(1), dim)
        held = part_of_rows.column(2).to_numpy(zero_copy_only=False)
        for c in np.unique(held):
            members, asking = np.flatnonzero(held == c), probing.get(c, none)
            for part in blocks(len(members), max(len(asking), dim)):
                yield members[part], asking, score_matrix(values[members[part]], wanted[asking], metric)

    probed = rows.filter(F.col(cell).isin(used)) if len(used) < cells else rows
    return VectorScan(_usable(probed.select(key, vector, cell), vector, dim), batch.ids,
                      batch.id_type, scorer, _refiner(wanted, dim, metric), (vector, cell), dim)


def cell_top_k(rows: DataFrame, batch: VectorBatch, cells: int, k: int, metric: str = "cosine",
               key: str = "chunk_id") -> DataFrame:
    return _top_k(cell_scan(rows, batch, cells, metric, key), k)


def ivf_scan(indexed: DataFrame, cells: KMeansModel | np.ndarray, queries: DataFrame, probes: int,
             metric: str = "cosine", key: str = "chunk_id", vector: str = "embedding",
             cell: str = "cell", query_id: str = "query_id",
             query_vector: str = "query_vector") -> VectorScan:
    ids, wanted = _batch(queries, query_id, query_vector)
    centres = _centres(cells)
    nearest = np.argsort(_gaps(wanted, centres), axis=1, kind="stable")[:, :probes] if len(wanted) \
        else np.zeros((0, probes), int)
    return cell_scan(indexed, VectorBatch(ids, queries.schema[query_id].dataType, wanted, nearest), len(centres),
                     metric, key, vector, cell)


def ivf_top_k(indexed: DataFrame, cells: KMeansModel | np.ndarray, queries: DataFrame, probes: int,
              k: int = 10, metric: str = "cosine", key: str = "chunk_id",
              vector: str = "embedding", cell: str = "cell", query_id: str = "query_id",
              query_vector: str = "query_vector",
              max_queries: int = MAX_QUERY_ROWS) -> DataFrame:
    """Search only the ``probes`` cells nearest to each query.

    Cells that no query probes are filtered out by the partition column, and inside a
    task a cell is multiplied only with the queries that probe it. With ``probes`` equal
    to the number of cells the result is exact. More than ``max_queries`` queries are
    answered in several scans of that many, with the same cells each.
    """
    return in_batches(queries, query_id, max_queries, lambda part: _top_k(
        ivf_scan(indexed, cells, part, probes, metric, key, vector, cell, query_id, query_vector), k))


# ---------------------------------------------------------------- LSH candidates

def hash_planes(tables: int, dim: int) -> np.ndarray:
    """Directions of the hash tables, by rule: the same for every table of vectors."""
    place = np.arange(tables)[:, None] * dim + np.arange(dim)[None, :] + 1.0
    return np.sin(place * place)


def _bucket_numbers(values: np.ndarray, bucket_length: float, tables: int) -> np.ndarray:
    return np.floor(values @ hash_planes(tables, values.shape[1]).T / bucket_length).astype(np.int64)


def with_buckets(corpus: DataFrame, dim: int, bucket_length: float = 0.5, tables: int = 8,
                 vector: str = "embedding") -> DataFrame:
    """Add ``buckets``, the bucket of each row in each table; store it with the rows."""
    def numbers(values: np.ndarray) -> pa.Array:
        flat = _bucket_numbers(values, bucket_length, tables)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1) * tables, pa.int32()),
                                        pa.array(flat.ravel()))

    return _append(corpus, "buckets", T.ArrayType(T.LongType()), vector, dim, numbers)


def lsh_scan(corpus: DataFrame, queries: DataFrame, bucket_length: float = 0.5, tables: int = 8,
             metric: str = "cosine", key: str = "chunk_id", vector: str = "embedding",
             query_id: str = "query_id", query_vector: str = "query_vector") -> VectorScan:
    ids, wanted = _batch(queries, query_id, query_vector)
    dim = wanted.shape[1]
    marks = _bucket_numbers(wanted, bucket_length, tables)
    rows = corpus if "buckets" in corpus.columns else with_buckets(
        corpus.select(key, vector), dim, bucket_length, tables, vector)

    def scorer(batch: pa.RecordBatch):
        values = _matrix(batch.column(1), dim)
        held = batch.column(2).flatten().to_numpy().reshape(-1, tables)
        every = np.arange(len(wanted))
        for part in blocks(len(values), max(len(wanted) * tables, dim)):
            shared = (held[part][:, None, :] == marks[None, :, :]).any(axis=2)
            scores = score_matrix(values[part], wanted, metric)
            yield part, every, np.where(shared, scores, np.nan)

    hit = F.lit(False)
    for t in range(tables):
        hit = hit | F.col("buckets")[t].isin(sorted({int(m) for m in marks[:, t]}))
    return VectorScan(_usable(rows.select(key, vector, "buckets"), vector, dim).filter(hit), ids,
                      queries.schema[query_id].dataType, scorer, _refiner(wanted, dim, metric))


def lsh_top_k(corpus: DataFrame, queries: DataFrame, k: int = 10, bucket_length: float = 0.5,
              tables: int = 8, metric: str = "cosine", key: str = "chunk_id",
              vector: str = "embedding", query_id: str = "query_id",
              query_vector: str = "query_vector", max_queries: int = MAX_QUERY_ROWS) -> DataFrame:
    """Search rows that share a random-projection bucket with the query in any table.

    A stored ``buckets`` column (:func:`with_buckets`) is used and rows whose buckets no query
    has are dropped in the JVM; the rest are re-ranked exactly. Pairs are never listed, so a
    bucket that holds many rows costs only its scan. More than ``max_queries`` queries are
    answered in several scans.
    """
    return in_batches(queries, query_id, max_queries, lambda part: _top_k(
        lsh_scan(corpus, part, bucket_length, tables, metric, key, vector, query_id, query_vector), k))


# ---------------------------------------------------------------- quality

def recall_at_k(approximate: DataFrame, exact: DataFrame, k: int,
                key: str = "chunk_id") -> DataFrame:
    """Share of the exact top-k that the approximate search returned, per query."""
    found = approximate.filter(F.col("rank") <= k).select("query_id", key)
    truth = exact.filter(F.col("rank") <= k).select("query_id", key)
    return (truth.join(found.withColumn("hit", F.lit(1)), ["query_id", key], "left")
            .groupBy("query_id")
            .agg((F.count("hit") / F.count(F.lit(1))).alias("recall")))
