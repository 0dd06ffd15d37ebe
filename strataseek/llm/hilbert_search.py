"""Nearest neighbours by shifted Hilbert orderings (operator 6).

Each of ``CURVES`` orderings rotates the vectors into a few dimensions, shifts them, and numbers
the cells of a grid along a Hilbert curve. The rows of an ordering are range-partitioned by that
number into blocks; a query is compared with the blocks around its own place, in all orderings, and
the candidates are merged and ranked by their exact distance.

Only the rotation, the cut points of the blocks and the width of the window are fitted, on a sample
of at most ``SAMPLE_ROWS`` rows taken by a hash; every row is indexed. The window is a share of the
blocks, the smallest tried one whose recall on the sample against brute force reaches
``SAMPLE_RECALL``. A sample is thinner than the table, so its neighbours lie further apart, and
the recall over the table comes out higher. Vectors without structure need wide windows.

A block with many more rows than the others (equal vectors have one number) is split by a hash of
vec_id, and its queries go to every part, so no task gets more than a few blocks' rows.

Vectors that are null, zero, hold null or non-finite components, or have not the commonest length
take no part, nor do rows without vec_id; a repeated vec_id counts once, with its nearest row.
Ties go to the smaller vec_id. An empty table, or one without queries, gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CURVES = 12
DIMENSIONS = 6
GRID_BITS = 10
SAMPLE_ROWS = 16_384
SAMPLE_QUERIES = 256
SAMPLE_RECALL = 0.93
BLOCK_ROWS = 2048
MOST_BLOCKS = 65_536
WINDOWS = (0.002, 0.005, 0.01, 0.02, 0.035, 0.05, 0.07, 0.1, 0.125, 0.15, 0.2, 0.3, 0.4, 0.5, 0.7, 1.0)

RESULT = "query_id long, vec_id long, score double"


def hilbert_number(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of grid cells (one row each); ``bits`` per dimension, 63 in all.

    From the top bit down, a cell's sub-cube decides how the axes are mirrored or swapped inside
    it; then the Gray code of the interleaved bits is undone.
    """
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    n = len(x)
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for i in range(n):
            mirror = (x[i] & bit) != 0
            swap = np.where(mirror, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(mirror, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, n):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[n - 1] & (1 << level), (1 << level) - 1, 0)
    number = np.zeros(len(cells), np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            number = number << 1 | ((x[i] ^ flip) >> level & 1)
    return number


class Orderings:
    """The rotations, shifts and scales of all curves; made from a sample, the same for every row."""

    def __init__(self, sample: np.ndarray, curves: int = CURVES, dimensions: int = DIMENSIONS, seed: int = 7):
        random = np.random.default_rng(seed)
        width = sample.shape[1]
        dimensions = min(dimensions, width)
        self.bits = min(GRID_BITS, 62 // dimensions)
        columns = []
        while len(columns) < curves * dimensions:  # axes of the curves are orthogonal as far as they go
            columns += list(np.linalg.qr(random.normal(size=(width, width)))[0].T)
        self.axes = [np.array(columns[c * dimensions:(c + 1) * dimensions]).T for c in range(curves)]
        self.low, self.scale = [], []
        for axes in self.axes:
            seen = sample @ axes
            low, high = seen.min(0), seen.max(0)
            span = np.where(high > low, high - low, 1.0)
            shift = random.uniform(0, 1, dimensions)
            self.low.append(low - span * shift / 2)
            self.scale.append((1 << self.bits) / (span * 1.5))

    def numbers(self, vectors: np.ndarray, curve: int) -> np.ndarray:
        cells = (vectors @ self.axes[curve] - self.low[curve]) * self.scale[curve]
        return hilbert_number(np.clip(cells, 0, (1 << self.bits) - 1).astype(np.int64), self.bits)


def nearest(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray,
            k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, distance) of the ``k`` nearest rows of each query, its own id left out.

    A product of matrices finds who can be among them; their distance is then taken directly.
    """
    out_q, out_r, out_d = [], [], []
    squares = (rows * rows).sum(1)
    for low in range(0, len(queries), 256):
        part = queries[low:low + 256]
        own = (part * part).sum(1)
        rough = own[:, None] + squares - 2.0 * (part @ rows.T)
        rough[query_ids[low:low + 256, None] == row_ids] = np.inf
        slack = 1e-9 * (own[:, None] + squares.max())
        if len(rows) > k:
            limit = np.partition(rough, k - 1, axis=1)[:, k - 1:k]
            chosen = (rough <= limit + slack) & np.isfinite(rough)
        else:
            chosen = np.isfinite(rough)
        at, row = np.nonzero(chosen)
        distance = np.sqrt(((part[at] - rows[row]) ** 2).sum(1))
        order = np.lexsort((row_ids[row], distance, at))
        at, row, distance = at[order], row[order], distance[order]
        begin = np.searchsorted(at, at)
        keep = np.arange(len(at)) - begin < k
        out_q.append(query_ids[low:low + 256][at[keep]])
        out_r.append(row_ids[row[keep]])
        out_d.append(distance[keep])
    return np.concatenate(out_q), np.concatenate(out_r), np.concatenate(out_d)


def fit_window(sample: np.ndarray, orderings: Orderings, k: int) -> float:
    """Smallest tried window whose recall on the sample reaches ``SAMPLE_RECALL``."""
    n = len(sample)
    queries = np.arange(0, n, max(1, n // SAMPLE_QUERIES))
    ids = np.arange(n)
    query, row, _ = nearest(sample[queries], ids[queries], sample, ids, k)
    gap = np.full(len(query), np.inf)
    for curve in range(len(orderings.axes)):
        rank = np.empty(n, np.int64)
        rank[np.argsort(orderings.numbers(sample, curve), kind="stable")] = ids
        gap = np.minimum(gap, np.abs(rank[query] - rank[row]))
    for share in WINDOWS:
        if (gap <= share * n / 2).mean() >= SAMPLE_RECALL:
            return share
    return 1.0


def usable(vector: Column, width: int | None = None) -> Column:
    """Whether a vector takes part."""
    good = (vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                                          & (F.abs(x) != float("inf"))) & F.exists(vector, lambda x: x != 0))
    return good if width is None else good & (F.size(vector) == width)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), float).reshape(-1, width)


def search(table: DataFrame, queries: DataFrame, k: int = 10, vec_id: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest rows found for each query."""
    def prepared(df: DataFrame) -> DataFrame:
        return df.select(F.col(vec_id).cast("long").alias("vec_id"),
                         F.col(vector).alias("vector")).filter(
            F.col("vec_id").isNotNull() & F.coalesce(usable(F.col("vector")), F.lit(False)))

    rows, asked = prepared(table), prepared(queries)
    sizes = rows.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").take(1)
    empty = rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not sizes:
        return empty
    width, total = sizes[0]["width"], sizes[0]["count"]
    rows, asked = (df.filter(F.size("vector") == width) for df in (rows, asked))
    most = (SAMPLE_ROWS / total - 0.5) * 2.0 ** 64
    picked = rows if total <= SAMPLE_ROWS else rows.filter(F.xxhash64("vec_id", F.lit(3)) < F.lit(int(most)))
    sample = _matrix(picked.select("vector").toArrow().column(0).combine_chunks(), width)
    orderings = Orderings(sample)
    share = fit_window(sample, orderings, k)
    blocks = int(min(MOST_BLOCKS, max(1, np.ceil(total / BLOCK_ROWS)), len(sample)))
    curves = len(orderings.axes)
    cuts = [np.quantile(orderings.numbers(sample, c), np.arange(1, blocks) / blocks, method="lower").astype(np.int64)
            for c in range(curves)]
    reach = int(np.ceil(share * blocks / 2))
    context = rows.sparkSession.sparkContext.broadcast((orderings, cuts))

    def place(batches):
        made, cut = context.value
        for batch in batches:
            vectors = _matrix(batch.column("vector"), width)
            for c in range(curves):
                block = np.searchsorted(cut[c], made.numbers(vectors, c), side="right") * curves + c
                yield pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), *batch.columns],
                                                 names=["block", "vec_id", "vector"])

    schema = f"block long, vec_id long, vector {rows.schema['vector'].dataType.simpleString()}"
    placed = rows.mapInArrow(place, schema)
    counts = placed.groupBy("block").count()  # one short row per block, at most MOST_BLOCKS * CURVES
    wide = F.broadcast(counts.select("block", F.ceil(F.col("count") / (3 * BLOCK_ROWS)).cast("int").alias("parts"))
                       .filter("parts > 1"))
    parts = F.coalesce(F.col("parts"), F.lit(1))
    spread = placed.join(wide, "block", "left").select(
        "block", F.pmod(F.xxhash64("vec_id"), parts).cast("int").alias("part"),
        F.lit(None).cast("long").alias("query_id"), "vec_id", "vector")
    own = F.floor(F.col("block") / curves)
    sent = (asked.mapInArrow(place, schema).withColumn("other", F.explode(F.sequence(
        F.greatest(own - reach, F.lit(0)), F.least(own + reach, F.lit(blocks - 1)))))
        .withColumn("block", F.col("other") * curves + F.col("block") % curves)
        .join(wide, "block", "left")
        .select("block", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"),
                F.col("vec_id").alias("query_id"), F.lit(None).cast("long").alias("vec_id"), "vector"))

    def compare(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        is_row = group.column("query_id").is_null()
        here, queries_here = group.filter(is_row), group.filter(pc.invert(is_row))
        if not here.num_rows or not queries_here.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()),
                             "score": pa.array([], pa.float64())})
        q, r, d = nearest(_matrix(queries_here.column("vector").combine_chunks(), width),
                          queries_here.column("query_id").to_numpy(),
                          _matrix(here.column("vector").combine_chunks(), width),
                          here.column("vec_id").to_numpy(), k)
        return pa.table({"query_id": q, "vec_id": r, "score": d})

    found = spread.unionByName(sent).groupBy("block", "part").applyInArrow(compare, RESULT)
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
