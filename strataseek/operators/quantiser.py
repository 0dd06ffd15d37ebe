"""A two-level quantiser of vectors: coarse centres, and fine ones below each of them.

Both levels are trained from the rows by k-means: coarse centres from a bounded sample in one task, fine ones in a task
for each coarse cell, from the sampled rows in it. A fine cell that holds more than ``most_rows`` rows of the whole
table is divided again, from rows of that cell, until none is too large or its rows are all equal.
Vectors are compared by direction (unit length), as cosine search does. The sample is picked by a
hash of the key and has about ``SAMPLE_ROWS`` rows at most; every row is assigned.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from strataseek.session import cut_lineage

SAMPLE_ROWS = 65_536
ROUNDS = 8
_SEED = 11


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows at length one; a zero vector stays."""
    length = np.sqrt((vectors ** 2).sum(axis=1, keepdims=True))
    return np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0)


def _matrix(column, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _lists(matrix: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1], matrix.ravel())


def _sorted(made: pa.Table, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Parents and centres, in ascending order of both."""
    parents, centres = made["parent"].to_numpy().astype(int), _matrix(made["centre"], dim)
    order = np.lexsort((*centres.T[::-1], parents))
    return parents[order], centres[order]


def _nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres ** 2).sum(1)[None, :] - 2 * rows @ centres.T).argmin(axis=1)


def cluster(rows: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Plain k-means of a bounded sample, at most ``k`` different centres; the first ones are rows far from those before them."""
    random = np.random.default_rng(_SEED)
    squares = (rows ** 2).sum(1)
    centres = rows[random.integers(len(rows))][None]
    gap = np.full(len(rows), np.inf)
    while True:
        gap = np.minimum(gap, np.maximum(squares - 2 * rows @ centres[-1] + (centres[-1] ** 2).sum(), 0))
        gap[gap < 1e-12] = 0
        if len(centres) >= k or not gap.any():
            break
        centres = np.vstack([centres, rows[random.choice(len(rows), p=gap / gap.sum())]])
    for _ in range(rounds):
        owner = _nearest(rows, centres)
        order = np.argsort(owner, kind="stable")
        held, begins, counts = np.unique(owner[order], return_index=True, return_counts=True)
        moved = centres.copy()
        moved[held] = np.add.reduceat(rows[order], begins, axis=0) / counts[:, None]
        if np.allclose(moved, centres, atol=1e-9):
            break
        centres = moved
    return centres


@dataclass
class Quantiser:
    """``coarse`` centres, all fine ``centres``, and the coarse cell (``parents``) of each fine one."""

    coarse: np.ndarray
    centres: np.ndarray
    parents: np.ndarray

    @classmethod
    def flat(cls, centres: np.ndarray) -> Quantiser:
        """One level: given centres below a single coarse cell."""
        centres = np.asarray(centres, float)
        return cls(centres.mean(axis=0, keepdims=True), centres, np.zeros(len(centres), int))

    @cached_property
    def _below(self) -> list[np.ndarray]:
        """Fine cells below each coarse one, ascending."""
        order = np.argsort(self.parents, kind="stable")
        return np.split(order, np.searchsorted(self.parents[order], np.arange(1, len(self.coarse))))

    def numbers(self, vectors: np.ndarray, normed: bool) -> tuple[np.ndarray, np.ndarray]:
        """Coarse and fine cell of each vector: the nearest coarse centre, then the nearest below it."""
        rows = unit(vectors) if normed else vectors
        tops = _nearest(rows, self.coarse)
        cells = np.empty(len(rows), np.int64)
        for top in np.unique(tops):
            below, members = self._below[top], np.flatnonzero(tops == top)
            cells[members] = below[_nearest(rows[members], self.centres[below])]
        return tops, cells

    def assign(self, rows: DataFrame, vector: str = "embedding") -> DataFrame:
        """Add ``cell`` and ``top``; rows whose vector has another length are left out."""
        dim, normed = self.centres.shape[1], len(self.coarse) > 1

        # only the vectors go to Python
        @arrow_udf("struct<cell: int, top: int>")
        def place(vectors: pa.Array) -> pa.Array:
            tops, cells = self.numbers(_matrix(vectors, dim), normed)
            return pa.StructArray.from_arrays([pa.array(cells.astype(np.int32)), pa.array(tops.astype(np.int32))], ["cell", "top"])

        return rows.filter(F.size(vector) == dim).select("*", place(vector).alias("__place")) \
            .select(*[f"`{c}`" for c in rows.columns], "__place.cell", "__place.top")

    def save(self, spark: SparkSession, path: str) -> None:
        levels = [("coarse", np.arange(len(self.coarse)), self.coarse), ("fine", self.parents, self.centres)]
        table = pa.concat_tables(pa.table({
            "level": pa.array([level] * len(centres), pa.string()), "cell": pa.array(np.arange(len(centres)), pa.int32()),
            "parent": pa.array(parents, pa.int32()), "centre": _lists(centres)}) for level, parents, centres in levels)
        spark.createDataFrame(table).coalesce(1).write.parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Quantiser:
        held = spark.read.parquet(path).orderBy("level", "cell").toArrow()
        coarse, fine = (held.filter(pc.equal(held["level"], level)) for level in ("coarse", "fine"))
        dim = len(held["centre"][0])
        return cls(_matrix(coarse["centre"], dim), _matrix(fine["centre"], dim), fine["parent"].to_numpy().astype(int))


def sampled(rows: DataFrame, most: int, key: str) -> DataFrame:
    """About ``most`` rows at most, picked by a hash of the key."""
    share = max(1, math.ceil(rows.count() / most))
    return rows.filter(F.pmod(F.xxhash64(key), F.lit(share)) == 0) if share > 1 else rows


def train(rows: DataFrame, rows_per_cell: int, most_rows: int | None = None, key: str = "chunk_id", vector: str = "embedding",
          sample_rows: int = SAMPLE_ROWS, coarse: int | None = None) -> Quantiser:
    """Centres for cells of about ``rows_per_cell`` rows and, by division, at most ``most_rows`` (default: four times as many)."""
    most_rows = most_rows or 4 * rows_per_cell
    usable = cut_lineage(rows.select(key, F.col(vector).cast("array<double>").alias(vector))
                         .filter(F.col(vector).isNotNull() & (F.size(vector) > 0)), "vectors")
    total, dim = usable.agg(F.count(F.lit(1)), F.max(F.size(vector))).first()
    if not total:
        raise ValueError("no vectors to train from")
    usable = usable.filter(F.size(vector) == dim)
    cells = max(1, round(total / rows_per_cell))
    tops = min(cells, coarse or max(2, round(math.sqrt(cells))))
    sample = cut_lineage(sampled(usable, sample_rows, key), "vector-sample")
    schema = "parent int, centre array<double>"

    def divide(parts: dict[int, int]):
        """Centres for each group of sampled rows, as many as asked for."""
        def run(table: pa.Table) -> pa.Table:
            own = table["group"][0].as_py()
            centres = cluster(unit(_matrix(table[vector], dim)), parts.get(own) or max(1, math.ceil(table.num_rows / per_cell)))
            return pa.table({"parent": pa.array([own] * len(centres), pa.int32()), "centre": _lists(centres)})
        return run

    per_cell = rows_per_cell * min(1.0, sample.count() / total)
    # the sample is bounded, so one task holds it for the coarse level
    top = sample.select(vector, F.lit(0).alias("group")).groupBy("group").applyInArrow(divide({0: tops}), schema).toArrow()
    quantiser = Quantiser(_sorted(top, dim)[1], np.zeros((0, dim)), np.zeros(0, int))

    def with_top(frame: DataFrame) -> DataFrame:
        single = Quantiser(quantiser.coarse, quantiser.coarse, np.arange(len(quantiser.coarse)))
        return single.assign(frame, vector).withColumnRenamed("top", "group").drop("cell")

    parents, centres = _sorted(with_top(sample).groupBy("group").applyInArrow(divide({}), schema).toArrow(), dim)
    empty = np.setdiff1d(np.arange(len(quantiser.coarse)), parents)
    quantiser = Quantiser(quantiser.coarse, np.vstack([centres, quantiser.coarse[empty]]), np.r_[parents, empty])
    settled: set[tuple] = set()
    for _ in range(ROUNDS):
        placed = quantiser.assign(usable, vector)
        sizes = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().filter(F.col("count") > most_rows).collect()}
        crowded = [c for c in sizes if tuple(quantiser.centres[c]) not in settled]
        if not crowded:
            break
        # each crowded cell gives at most a bounded number of its rows to its task; a row finds its cell by hash
        shares = rows.sparkSession.createDataFrame(pa.table({
            "cell": pa.array(crowded, pa.int32()),
            "share": pa.array([max(1, sizes[c] * len(crowded) // sample_rows) for c in crowded], pa.int64())}))
        part = placed.join(F.broadcast(shares), "cell").filter(F.pmod(F.xxhash64(key), "share") == 0) \
            .select(vector, F.col("cell").alias("group"))

        wanted = {c: math.ceil(sizes[c] / rows_per_cell) for c in crowded}
        owners, centres = _sorted(part.groupBy("group").applyInArrow(divide(wanted), schema).toArrow(), dim)
        parts = np.bincount(owners, minlength=len(quantiser.centres))
        settled |= {tuple(quantiser.centres[c]) for c in crowded if parts[c] < 2}
        keep, split = parts < 2, parts[owners] > 1
        if keep.all():
            break
        quantiser = Quantiser(quantiser.coarse, np.vstack([quantiser.centres[keep], centres[split]]),
                              np.r_[quantiser.parents[keep], quantiser.parents[owners[split]]])
    return quantiser
