"""Top-k scans: score every row against a query batch, keep k rows per query and task.

The corpus is read once per query batch and never shuffled. Each task holds the batch as one
matrix, scores an Arrow batch at a time and keeps a running best list per query, so
a task emits at most ``k`` rows per query however many rows it reads, and equal or
clustered rows cannot overload one task. A window over those few rows gives the rank.

Scores are compared at ``SCORE_DIGITS`` significant digits, so equal rows tie whatever the
order of summation, small scores keep their order, and the key decides ties.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

# A query batch up to this many rows is sent to the tasks; more rows go in several batches.
MAX_QUERY_ROWS = 4096
SCORE_DIGITS = 9
# Matrix cells scored at a time inside a task.
_BLOCK_CELLS = 4_000_000

# A scorer takes one Arrow batch and yields (row numbers, query numbers, score matrix);
# a score that is not a number marks a pair that is no candidate.
Scorer = Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]
# Scores of (row, query) pairs to full precision, from row numbers of the Arrow batch.
Refiner = Callable[[pa.RecordBatch, np.ndarray, np.ndarray], np.ndarray]


def significant(x: np.ndarray, digits: int = SCORE_DIGITS) -> np.ndarray:
    """Rounded to so many significant digits."""
    size = np.abs(x)
    place = np.zeros_like(size)
    np.log10(size, out=place, where=(size > 0) & np.isfinite(size))
    scale = 10.0 ** (digits - 1 - np.floor(place))
    return np.where(np.isfinite(x), np.round(x * scale) / scale, x)


def significant_column(x: Column, digits: int = SCORE_DIGITS) -> Column:
    scale = F.pow(F.lit(10.0), F.lit(digits - 1) - F.floor(F.log10(F.abs(x))))
    return F.when(x == 0, x).otherwise(F.rint(x * scale) / scale)


def _below(limit: np.ndarray) -> np.ndarray:
    """The limit less what rounding to significant digits can add to a score."""
    return limit - np.where(np.isfinite(limit), np.abs(limit) * 10.0 ** (1 - SCORE_DIGITS), 0.0)


class BestRows:
    """Running top-k of all queries: greatest score first, then smallest key."""

    def __init__(self, queries: int, k: int, key_type: pa.DataType):
        self.k = k
        self.floor = np.full(queries, -np.inf)
        self.held = pa.table({"query": pa.array([], pa.int32()), "score": pa.array([], pa.float64()),
                              "key": pa.array([], key_type), "other": pa.array([], pa.float64())})

    def offer(self, queries: np.ndarray, scores: np.ndarray, keys: pa.Array, other: np.ndarray | None = None) -> None:
        """Pairs of a query number and a row; scores are significant digits already. ``other`` stays with its pair."""
        more = pa.table({"query": pa.array(queries, pa.int32()), "score": scores, "key": keys,
                         "other": np.full(len(scores), np.nan) if other is None else other})
        table = pa.concat_tables([self.held, more])
        table = table.take(pc.sort_indices(table, sort_keys=[
            ("query", "ascending"), ("score", "descending"), ("key", "ascending")]))
        query = table.column("query").to_numpy()
        place = np.arange(len(query)) - np.searchsorted(query, query)
        self.held = table.filter(pa.array(place < self.k)).combine_chunks()
        last = np.flatnonzero(place == self.k - 1)
        self.floor[query[last]] = table.column("score").to_numpy()[last]

    def offer_matrix(self, batch: pa.RecordBatch, rows: np.ndarray, queries: np.ndarray,
                     scores: np.ndarray, refine: Refiner | None, other: np.ndarray | None = None) -> None:
        """All queries of a block at once: only rows that can be among the best are ordered."""
        limit = self.floor[queries]
        near = scores >= _below(limit)
        crowded = np.flatnonzero(near.sum(0) > self.k)
        if len(crowded):  # more rows reach the floor than can stay: raise it to the k-th of the block
            own = scores[:, crowded]
            own = np.where(np.isfinite(own), own, -np.inf)
            least = np.partition(own, len(rows) - self.k, axis=0)[len(rows) - self.k]
            near[:, crowded] = own >= _below(np.maximum(limit[crowded], least))
        row, column = np.nonzero(near)
        finite = np.isfinite(scores[row, column])
        row, column = row[finite], column[finite]
        if len(row):
            found = scores[row, column] if refine is None else refine(batch, rows[row], queries[column])
            self.offer(queries[column], significant(found), batch.column(0).take(pa.array(rows[row])),
                       None if other is None else other[row, column])


def _result_schema(corpus: DataFrame, query_type: T.DataType) -> T.StructType:
    key = corpus.columns[0]
    return T.StructType([T.StructField("query_id", query_type),
                         T.StructField(key, corpus.schema[key].dataType),
                         T.StructField("score", T.DoubleType())])


def scan_top_k(corpus: DataFrame, scorer: Scorer, query_ids: list, query_type: T.DataType,
               k: int, refine: Refiner | None = None) -> DataFrame:
    """Run ``scorer`` over ``corpus`` (its first column is the row key) and rank.

    Returns ``query_id, <key>, score, rank`` with ``rank <= k``. With ``refine`` the matrix
    only selects who can be among the best, and the refined scores decide.
    """
    schema = _result_schema(corpus, query_type)
    key = corpus.columns[0]
    key_arrow, query_arrow = to_arrow_type(schema[key].dataType), to_arrow_type(query_type)
    ids = pa.array(list(query_ids), type=query_arrow)

    def run(batches):
        best = BestRows(len(ids), k, key_arrow)
        for batch in batches:
            if batch.num_rows:
                for rows, columns, scores in scorer(batch):
                    best.offer_matrix(batch, rows, columns, scores, refine)
        held = best.held.combine_chunks()
        yield from pa.table({"query_id": ids.take(held.column("query").combine_chunks()),
                             key: held.column("key"), "score": held.column("score")}).to_batches()

    return rank_rows(corpus.mapInArrow(run, schema), key, k)


def in_batches(queries: DataFrame, query_id: str, most: int, answer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``answer`` of a query set of any size: batches of about ``most`` queries, each with its own scan."""
    total = queries.count()
    if total <= most:
        return answer(queries)
    parts = -(-total // most)
    number = F.pmod(F.xxhash64(query_id), F.lit(parts))
    found = None
    for part in range(parts):
        one = answer(queries.filter(number == part))
        found = one if found is None else found.unionByName(one)
    return found


def rank_rows(scored: DataFrame, key: str, k: int | None, by: list[str] = ("query_id",),
              score: str = "score") -> DataFrame:
    """``row_number`` per query by score, ties by key; Spark prunes to k before the shuffle."""
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(key))
    ranked = scored.withColumn("rank", F.row_number().over(order))
    return ranked if k is None else ranked.filter(F.col("rank") <= k)


def blocks(rows: int, width: int) -> Iterator[np.ndarray]:
    step = max(1, _BLOCK_CELLS // max(1, width))
    for start in range(0, rows, step):
        yield np.arange(start, min(rows, start + step))
