"""Helpers shared by the text operators: word hashes on Arrow buffers, key packing, bucket counts.

Words are maximal runs of bytes other than space and 0x09-0x0D; A-Z count as a-z. They are hashed
without building Python objects: a byte is replaced by a fixed 64-bit value, the values are summed
with powers of an odd base, and the sum of a word is the difference of two prefix sums. Blocks of
fixed size bound the memory whatever the length of a text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataseek.session import cut_lineage, ship_package

BLOCK = 1 << 18
SLICE_BYTES = 2 << 20

_MASK = (1 << 64) - 1
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Fixed odd multipliers that combine the hashes of consecutive words.
_STEP = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
         0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def _byte_values() -> np.ndarray:
    """A pseudo-random value per byte; upper-case ASCII letters get those of lower case."""
    values = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_STEP[0]))
    values[65:91] = values[97:123]
    return values


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(base: int) -> np.ndarray:
    steps = np.full(BLOCK, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


_VALUES = _byte_values()
_UP, _DOWN = _powers(_BASE), _powers(_INVERSE)
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column in one array, and the offset of each row (nulls are empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    column = column.fill_null(b"") if column.null_count else column
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[offsets[0]:offsets[-1]], offsets - offsets[0]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                values: np.ndarray = _VALUES) -> np.ndarray:
    """64-bit hash of each byte span ``[start, end)``; spans are ordered and do not overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    at_start, at_end, down = (np.zeros(len(starts), np.uint64) for _ in range(3))
    carry, first = np.uint64(0), 0
    with np.errstate(over="ignore"):
        for low in range(0, len(data), BLOCK):
            part = data[low:low + BLOCK]
            scale = np.uint64(pow(_BASE, low, 1 << 64))
            sums = np.empty(len(part) + 1, np.uint64)
            sums[0] = carry
            np.cumsum(values[part] * _UP[:len(part)] * scale, out=sums[1:])
            sums[1:] += carry
            high = low + len(part)
            a, b = np.searchsorted(starts, [low, high])
            at_start[a:b] = sums[starts[a:b] - low]
            down[a:b] = _DOWN[starts[a:b] - low] * np.uint64(pow(_INVERSE, low, 1 << 64))
            a, b = np.searchsorted(ends, [low, high], side="right")
            at_end[a:b] = sums[ends[a:b] - low]
            carry = sums[-1]
        return mix((at_end - at_start) * down + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the row it belongs to."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    solid = ~BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    edge[0] = True
    starts = solid.copy()
    starts[1:] &= ~solid[:-1] | edge[1:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word, in order."""
    starts, ends, rows = word_spans(data, offsets)
    return span_hashes(data, starts, ends), rows


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the words ``i .. i + n - 1`` for each i that has them."""
    with np.errstate(over="ignore"):
        count = max(0, len(words) - n + 1)
        total = np.full(count, n, np.uint64)
        for j in range(n):
            total = mix(total * np.uint64(_STEP[j % 5]) + words[j:j + count])
        return total


def shingle_sets(words: np.ndarray, rows: np.ndarray, n_rows: int, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``n``-word shingles of each row, sorted by row and hash: (row, hash).

    A row with fewer words has its whole sequence as one shingle, one without words none.
    """
    counts = np.bincount(rows, minlength=n_rows)
    grams = gram_hashes(words, n)
    inside = rows[:len(grams)] == rows[n - 1:] if len(grams) else np.zeros(0, bool)
    out_rows, out = [rows[:len(grams)][inside]], [grams[inside]]
    begins = np.concatenate([[0], np.cumsum(counts)])[:-1]
    for size in range(1, n):
        short = np.flatnonzero(counts == size)
        if len(short):
            with np.errstate(over="ignore"):
                total = np.full(len(short), size, np.uint64)
                for j in range(size):
                    total = mix(total * np.uint64(_STEP[j % 5]) + words[begins[short] + j])
            out_rows.append(short)
            out.append(total)
    all_rows, hashes = np.concatenate(out_rows), np.concatenate(out)
    order = np.lexsort((hashes, all_rows))
    all_rows, hashes = all_rows[order], hashes[order]
    if len(hashes):
        keep = np.r_[True, (hashes[1:] != hashes[:-1]) | (all_rows[1:] != all_rows[:-1])]
        all_rows, hashes = all_rows[keep], hashes[keep]
    return all_rows, hashes


def release_memory() -> None:
    """Give freed memory back to the system: a Python worker lives on for the tasks of later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose ``column`` holds about ``limit`` bytes; a longer row stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        group = (np.cumsum(sizes) - 1) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)
    release_memory()


def in_slices(function, column: str = "text", limit: int = SLICE_BYTES):
    """A function for ``mapInArrow`` that calls ``function`` with record batches of bounded size."""
    def run(batches):
        for batch in slices(batches, column, limit):
            yield from function(batch)
    return run


def with_bytes(documents: DataFrame, *more: str | Column) -> DataFrame:
    """doc_id and the UTF-8 bytes of the text; a null text is empty."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                            F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"), *more)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` less the columns that an operator is about to add."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns if c.lower() not in gone])


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with columns c0, c1, ..: ``mapInArrow`` takes no names with a dot."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def splits(df: DataFrame) -> int:
    """Number of input splits: a measure of size that needs no job."""
    return max(1, df.rdd.getNumPartitions())


def bucket_count(df: DataFrame, per_split: int = 2, least: int = 24, most: int = 1 << 16) -> int:
    """Hash buckets for the data of ``df``: in proportion to it, so a bucket's size is bounded."""
    spark = df.sparkSession
    return min(most, max(least, per_split * splits(df),
                         2 * int(spark.conf.get("spark.sql.shuffle.partitions"))))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def runs_by(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal values in a sorted array."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return begins, np.diff(np.r_[begins, len(keys)])


__all__ = ["BLANK", "bucket_count", "buffers", "cut_lineage", "gram_hashes", "in_slices", "mix", "read",
           "release_memory", "runs_by", "shingle_sets", "slices", "span_hashes", "splits", "with_bytes", "word_hashes",
           "word_spans"]
