"""One search call over the index: vector, full-text or hybrid, for a query batch."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataseek.functions.text import preview
from strataseek.functions.vectors import hashing_embedding
from strataseek.operators.fulltext import bm25_scan, bm25_top_k, corpus_size, normalise_scores
from strataseek.operators.hybrid import count_keyword_matches, pairs_per_query, threshold_top_k
from strataseek.operators.segment_index import SegmentIndex
from strataseek.operators.topk import MAX_QUERY_ROWS, in_batches
from strataseek.operators.vector_search import exact_scan, exact_top_k, ivf_scan, ivf_top_k
from strataseek.session import cut_lineage, fits_broadcast, held_locally

METHODS = ("ANN", "Full-Text", "Hybrid")
# Result lists up to this length are looked up by key.
LOOKUP_ROWS = 1000
# Rows of both lists of one hybrid batch at most: the tasks of its second scan hold them.
HYBRID_PAIRS = 200_000
RESULT_COLUMNS = ["query_id", "method", "rank", "chunk_id", "file_name", "text", "score"]


@dataclass
class SearchIndex:
    """Index rows (``chunk_id, file_name, chunk_text, tokens, embedding``), an optional
    lexicon, and centroids when the rows carry a ``cell`` column. The corpus size is
    read once and kept."""

    rows: DataFrame
    lexicon: DataFrame | None = None
    centroids: KMeansModel | np.ndarray | None = None
    probes: int | None = None
    stored: SegmentIndex | None = None

    @classmethod
    def of(cls, stored: SegmentIndex, probes: int | None = None) -> SearchIndex:
        """Search a stored index: ``probes`` cells per query (default all), postings of the terms."""
        return cls(stored.rows, centroids=stored.centroids,
                   probes=probes or len(stored.centroids), stored=stored)

    @cached_property
    def size(self) -> tuple[int, float]:
        return corpus_size(self.rows) if self.stored is None else self.stored.size


def embed_queries(queries: DataFrame, dim: int = 64) -> DataFrame:
    """Add ``query_vector`` with the same embedder as the chunks."""
    return queries.withColumn("query_vector", hashing_embedding("query", dim))


def vector_list(index: SearchIndex, queries: DataFrame, k: int) -> DataFrame:
    if index.stored is not None:
        return index.stored.vector_top_k(queries, k, index.probes)
    if index.centroids is not None and index.probes is not None:
        return ivf_top_k(index.rows, index.centroids, queries, index.probes, k)
    return exact_top_k(index.rows, queries, k)


def keyword_list(index: SearchIndex, queries: DataFrame, k: int) -> DataFrame:
    if index.stored is not None and "tokens" in index.rows.columns:
        return index.stored.keyword_top_k(queries, k)
    return bm25_top_k(index.rows, queries, k, lexicon=index.lexicon, size=index.size)


def hybrid_list(index: SearchIndex, queries: DataFrame, k: int) -> DataFrame:
    """The k best rows by fused rank, as if both lists were complete (:func:`threshold_top_k`)."""
    if index.centroids is not None and index.probes is not None:
        by_vector = ivf_scan(index.rows, index.centroids, queries, index.probes)
    else:
        by_vector = exact_scan(index.rows, queries)
    by_word = bm25_scan(index.rows, queries, lexicon=index.lexicon, size=index.size)
    if by_word is None:  # too many different terms for one scan: fewer queries at a time
        half = max(1, queries.count() // 2)
        return in_batches(queries, "query_id", half, lambda part: hybrid_list(index, part, k))
    return threshold_top_k(index.rows, by_vector, by_word, k)


def search(index: SearchIndex, queries: DataFrame, query_type: str = "ANN",
           num_results: int = 10, columns: tuple[str, ...] = ("file_name", "chunk_text")) -> DataFrame:
    """Top results per query.

    ``ANN`` needs ``query_vector``; ``FULL_TEXT`` needs ``query`` and ignores a vector;
    ``HYBRID`` needs both and fuses the ranks of both lists (:func:`hybrid_list`).
    """
    kind = query_type.upper()
    needs = {"ANN": {"query_vector"}, "FULL_TEXT": {"query"},
             "HYBRID": {"query", "query_vector"}}
    if kind not in needs:
        raise ValueError(f"query_type must be one of {sorted(needs)}")
    missing = needs[kind] - set(queries.columns)
    if missing:
        raise ValueError(f"{kind} search needs the columns {sorted(missing)}")
    wanted = held_locally(queries, MAX_QUERY_ROWS)
    queries = queries if wanted is None else wanted
    if kind == "ANN":
        found = vector_list(index, queries, num_results)
    elif kind == "FULL_TEXT":
        found = normalise_scores(keyword_list(index, queries, num_results))
    else:
        found = in_batches(queries, "query_id", max(1, HYBRID_PAIRS // pairs_per_query(num_results)),
                           lambda part: hybrid_list(index, part, num_results))
    keywords = kind == "HYBRID" and "keywords" in queries.columns
    stored = tuple(dict.fromkeys([*columns, *(["chunk_text"] if keywords else [])]))
    most = None if wanted is None else wanted.count() * num_results
    result = attach(found, index.rows, stored, most)
    if keywords:
        result = count_keyword_matches(result, queries)
    return result.drop(*(set(stored) - set(columns)))


def attach(found: DataFrame, rows: DataFrame, columns: tuple[str, ...],
           most: int | None) -> DataFrame:
    """Join stored columns to a result list of at most ``most`` rows.

    A short list is looked up by key, which Parquet can answer from the row groups that
    hold the keys; a longer one is broadcast. With an unknown bound Spark chooses.
    """
    if not columns:
        return found
    stored = rows.select("chunk_id", *columns)
    if most is None:
        return found.join(stored, "chunk_id")
    if most > LOOKUP_ROWS:
        found = cut_lineage(found, "result-list")
        return stored.join(F.broadcast(found) if fits_broadcast(found, F.lit(128)) else found, "chunk_id")
    short = held_locally(found, LOOKUP_ROWS)
    keys = sorted({r.chunk_id for r in short.select("chunk_id").collect()})
    return stored.filter(F.col("chunk_id").isin(keys)).join(F.broadcast(short), "chunk_id")


def as_results(found: DataFrame, method: str, score: str = "score") -> DataFrame:
    """The common result shape of all methods, with a text preview."""
    return found.select("query_id", F.lit(method).alias("method"), "rank", "chunk_id",
                        "file_name", preview("chunk_text").alias("text"),
                        F.col(score).alias("score"))


def search_all_methods(index: SearchIndex, queries: DataFrame, num_results: int = 10) -> DataFrame:
    """Results of the three methods in one table."""
    ann = as_results(search(index, queries, "ANN", num_results), "ANN")
    words = as_results(search(index, queries, "FULL_TEXT", num_results), "Full-Text",
                       "normalized_score")
    both = as_results(search(index, queries, "HYBRID", num_results), "Hybrid")
    return ann.unionByName(words).unionByName(both)
