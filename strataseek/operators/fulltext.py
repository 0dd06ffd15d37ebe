"""BM25 full-text search (Robertson and Zaragoza 2009) over chunks.

score(query, row) = sum over the distinct query terms t found in the row of
    idf(t) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / average length)),
    idf(t) = ln(1 + (N - df + 0.5) / (df + 0.5)).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strataseek.functions.text import tokens
from strataseek.operators.skew import balanced_join
from strataseek.operators.topk import (MAX_QUERY_ROWS, Scorer, blocks, in_batches, rank_rows,
                                       scan_top_k, significant_column)

# Usual BM25 parameters.
K1 = 1.2
B = 0.75
# Size of the (term, query) weight matrix that may be sent to the tasks; above it
# terms are joined.
MAX_WEIGHTS = 8_000_000
# A term that more than one of so many queries hold is scored by a matrix product.
DENSE_SHARE = 16
# Up to this many query terms, tokens are filtered before they go to Python.
FEW_TERMS = 200


def with_tokens(rows: DataFrame, text: str = "chunk_text") -> DataFrame:
    """Add the ``tokens`` array; store it with the index so that search does not tokenise."""
    return rows.withColumn("tokens", tokens(text))


def corpus_size(rows: DataFrame) -> tuple[int, float]:
    """Number of rows and average length in tokens."""
    n, total = rows.agg(F.count(F.lit(1)), F.sum(F.size("tokens"))).first()
    return n, (total or 0) / n if n else 0.0


def document_frequency(rows: DataFrame) -> DataFrame:
    """``term, df`` for every term; map-side aggregation leaves one row per term and task."""
    return (rows.select(F.explode(F.array_distinct("tokens")).alias("term"))
            .groupBy("term").agg(F.count(F.lit(1)).alias("df")))


def _query_terms(queries: DataFrame, query_id: str, text: str) -> DataFrame:
    return queries.select(F.col(query_id).alias("query_id"),
                          F.array_distinct(tokens(text)).alias("terms"))


@dataclass
class TermScan:
    """One query batch, ready for a scan over token lists."""

    corpus: DataFrame
    ids: list
    id_type: T.DataType
    scorer: Scorer
    hits: Column | None = None


class _TermWeights:
    """The weights of a query batch, by term: a term of few queries meets only these.

    Terms in more than one of ``DENSE_SHARE`` queries are columns of a matrix; the others are lists, so the work
    follows the terms found in the rows and the queries that ask for them, not all terms times all queries.
    """

    def __init__(self, idf: np.ndarray, asked: np.ndarray, queries: int):
        asked = asked[np.argsort(asked[:, 0], kind="stable")]
        sizes = np.bincount(asked[:, 0], minlength=len(idf))
        dense = sizes * DENSE_SHARE > queries
        self.idf, self.queries, self.query = idf, queries, asked[:, 1]
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes
        self.place = np.where(dense, np.cumsum(dense) - 1, -1)
        self.matrix = np.zeros((int(dense.sum()), queries))
        common = dense[asked[:, 0]]
        self.matrix[self.place[asked[common, 0]], asked[common, 1]] = idf[asked[common, 0]]
        self.cells_per_row = max(len(self.matrix), queries)

    def scores(self, rows: int, row: np.ndarray, term: np.ndarray, gain: np.ndarray) -> np.ndarray:
        """Rows times queries, from the terms found: the row, the term and what one occurrence list of it is worth."""
        common = self.place[term] >= 0
        found = np.zeros((rows, len(self.matrix)))
        found[row[common], self.place[term[common]]] = gain[common]
        total = found @ self.matrix
        flat, rare = total.ravel(), np.flatnonzero(~common)
        ends = np.cumsum(self.sizes[term[rare]])
        low = 0
        while low < len(rare):  # so many pairs at a time that they stay as small as the matrix
            high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + total.size, side="right")))
            at = rare[low:high]
            sizes = self.sizes[term[at]]
            entry = np.repeat(np.arange(len(at)), sizes)
            nth = np.arange(len(entry)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            pair = row[at][entry] * self.queries + self.query[self.starts[term[at]][entry] + nth]
            flat += np.bincount(pair, (gain[at] * self.idf[term[at]])[entry], total.size)
            low = high
        return total


def bm25_scan(rows: DataFrame, queries: DataFrame, key: str = "chunk_id", query_id: str = "query_id",
              query_text: str = "query", lexicon: DataFrame | None = None,
              size: tuple[int, float] | None = None, k1: float = K1, b: float = B) -> TermScan | None:
    """The scan of a query batch, or None when its weight matrix is above ``MAX_WEIGHTS``."""
    wanted = _query_terms(queries, query_id, query_text).collect()
    terms = sorted({t for r in wanted for t in (r.terms or [])})
    if len(terms) * len(wanted) > MAX_WEIGHTS:
        return None
    spark = rows.sparkSession
    n, average = size or corpus_size(rows)
    term_rows = F.broadcast(spark.createDataFrame(
        pa.table({"term": pa.array(terms, type=pa.string())})))
    known = (document_frequency_of(rows, term_rows) if lexicon is None
             else lexicon.join(term_rows, "term"))
    df = {r.term: r.df for r in known.collect()}
    vocabulary = [t for t in terms if t in df]
    number = {t: i for i, t in enumerate(vocabulary)}
    width = len(vocabulary)
    lookup = pa.array(vocabulary, type=pa.string())
    asked = [(number[t], q) for q, r in enumerate(wanted) for t in r.terms or [] if t in number]
    scored = _TermWeights(np.array([math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) for t in vocabulary]),
                          np.array(asked, np.int64).reshape(-1, 2), len(wanted))

    def scorer(batch: pa.RecordBatch):
        lists, lengths = batch.column(1), batch.column(2).to_numpy()
        found = pc.index_in(lists.flatten(), value_set=lookup)
        owner = np.repeat(np.arange(len(lengths)), np.diff(lists.offsets.to_numpy()))
        hit = found.is_valid().to_numpy(zero_copy_only=False)
        owner, term = owner[hit], found.drop_null().to_numpy()
        every = np.arange(len(wanted))
        for part in blocks(len(lengths), scored.cells_per_row):
            low, high = np.searchsorted(owner, [part[0], part[-1] + 1])
            cells = (owner[low:high] - part[0]) * width + term[low:high]
            # term frequency and gain only where a term occurs
            used, tf = np.unique(cells, return_counts=True)
            row, which = np.divmod(used, max(width, 1))
            damp = k1 * (1 - b + b * lengths[part] / average)
            scores = scored.scores(len(part), row, which, tf * (k1 + 1) / (tf + damp[row]))
            yield part, every, np.where(scores > 0, scores, np.nan)

    # with few terms only the tokens that can score leave the JVM
    hits = (F.filter("tokens", lambda t: t.isin(vocabulary)) if 0 < width <= FEW_TERMS
            else F.col("tokens"))
    corpus = (rows.select(key, hits.alias("hits"), F.size("tokens").alias("length"))
              .filter(F.size("hits") > 0))
    if not vocabulary:
        corpus = corpus.filter(F.lit(False))
    return TermScan(corpus, [r.query_id for r in wanted], queries.schema[query_id].dataType, scorer, hits)


def bm25_top_k(rows: DataFrame, queries: DataFrame, k: int = 10, key: str = "chunk_id",
               query_id: str = "query_id", query_text: str = "query",
               lexicon: DataFrame | None = None, size: tuple[int, float] | None = None,
               k1: float = K1, b: float = B, max_queries: int = MAX_QUERY_ROWS) -> DataFrame:
    """The ``k`` best rows per query: ``query_id, <key>, score, rank``.

    ``rows`` needs the key and ``tokens``. Term statistics come from ``lexicon``
    (:func:`document_frequency`) and ``size`` (:func:`corpus_size`) when given, else from
    passes over ``rows``. More than ``max_queries`` queries go in several batches; a batch
    with too many terms is answered by :func:`bm25_joined`. A query without a match has no rows.
    """
    size = size or corpus_size(rows)

    def answer(part: DataFrame) -> DataFrame:
        scan = bm25_scan(rows, part, key, query_id, query_text, lexicon, size, k1, b)
        if scan is None:
            return bm25_joined(rows, part, k, key, query_id, query_text, lexicon, k1, b)
        return scan_top_k(scan.corpus, scan.scorer, scan.ids, scan.id_type, k)

    return in_batches(queries, query_id, max_queries, answer)


def document_frequency_of(rows: DataFrame, term_rows: DataFrame) -> DataFrame:
    """Document frequency of a bounded set of terms."""
    return (rows.select(F.explode(F.array_distinct("tokens")).alias("term"))
            .join(term_rows, "term")
            .groupBy("term").agg(F.count(F.lit(1)).alias("df")))


def bm25_joined(rows: DataFrame, queries: DataFrame, k: int = 10, key: str = "chunk_id",
                query_id: str = "query_id", query_text: str = "query",
                lexicon: DataFrame | None = None, k1: float = K1, b: float = B) -> DataFrame:
    """BM25 as joins: postings with query terms on ``term``, then a sum per (query, row).

    For query sets of any size. The postings side is split on terms that hold many
    rows, and the sum is a partial aggregate.
    """
    n, average = corpus_size(rows)
    lexicon = document_frequency(rows) if lexicon is None else lexicon
    idf = F.log1p((F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    wanted = (_query_terms(queries, query_id, query_text)
              .select("query_id", F.explode("terms").alias("term"))
              .join(lexicon, "term").select("query_id", "term", idf.alias("idf")))
    postings = (rows.select(key, F.size("tokens").alias("length"),
                            F.explode("tokens").alias("term"))
                .groupBy(key, "length", "term").agg(F.count(F.lit(1)).alias("tf")))
    gain = F.col("tf") * (k1 + 1) / (
        F.col("tf") + k1 * (1 - b + b * F.col("length") / F.lit(average)))
    scored = (balanced_join(postings, wanted, ["term"], [key], F.lit(64))
              .groupBy("query_id", key)
              .agg(significant_column(F.sum(F.col("idf") * gain)).alias("score")))
    return rank_rows(scored.select("query_id", key, "score"), key, k)


def normalise_scores(results: DataFrame, score: str = "score",
                     by: list[str] = ("query_id",)) -> DataFrame:
    """Min-max normalise one query's scores; equal scores all become 0."""
    group = Window.partitionBy(*by)
    low, high = F.min(score).over(group), F.max(score).over(group)
    span = F.when(high == low, F.lit(1.0)).otherwise(high - low)
    return results.withColumn("normalized_score", (F.col(score) - low) / span)
