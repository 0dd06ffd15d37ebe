"""Postings in compressed blocks with maxima and skips, and BM25 top-k that opens few of them.

Rows are dealt to shards by a hash of their key; inside a shard they are numbered in the order of the
key, so ties are decided by number. A term of a shard has its entries (number, frequency, length of
the row) in ascending number, cut into blocks of ``BLOCK_ENTRIES``. A block is one table row: its
first and last number (skips), its greatest frequency and least length (a bound of its scores that
holds whatever the average length becomes), and its entries in the narrowest whole bytes.

A search reads the blocks of its terms only. One task answers the whole query batch for one shard:
terms go in descending order of what they can add; as soon as the k-th best sum so far is out of
reach for a row that was not met yet, only the rows met are looked up in the other terms, by skips, and
those that cannot catch up are dropped before their blocks are opened. Rows on equal scores are
never dropped, so the result is that of a full scan.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strataseek.functions.text import tokens
from strataseek.operators.fulltext import B, K1
from strataseek.operators.topk import MAX_QUERY_ROWS, in_batches, rank_rows, significant
from strataseek.session import BROADCAST_LIMIT_BYTES, cut_lineage

BLOCK_ENTRIES = 256
#: Rows of a shard at most, on average; small tables get shards for all cores.
SHARD_ROWS, LEAST_SHARD_ROWS = 65_536, 4_096
#: Rows of all shards that are named before they are ranked.
FEW_ROWS = 1_000_000
#: Partial sums may differ from whole ones by rounding; bounds are widened by this share.
_SLACK = 1e-7

_SCHEMA = ("shard int, term string, block int, entries int, first int, last int, most_tf int, "
           "least_length int, payload binary")
_WIDTHS = (np.dtype("<u1"), np.dtype("<u2"), np.dtype("<u4"))


def shard_count(rows: int, cores: int) -> int:
    return max(1, math.ceil(rows / SHARD_ROWS), min(cores, rows // LEAST_SHARD_ROWS))


def _narrow(values: np.ndarray) -> tuple[int, bytes]:
    top = int(values.max(initial=0))
    width = 0 if top < 1 << 8 else 1 if top < 1 << 16 else 2
    return width, values.astype(_WIDTHS[width]).tobytes()


def pack(numbers: np.ndarray, frequencies: np.ndarray, lengths: np.ndarray) -> bytes:
    """Gaps of the numbers, frequencies and lengths, each as wide as its greatest value needs."""
    parts = [_narrow(np.diff(numbers, prepend=numbers[0])), _narrow(frequencies), _narrow(lengths)]
    return bytes(width for width, _ in parts) + b"".join(raw for _, raw in parts)


def unpack(payload: bytes, entries: int, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    at, out = 3, []
    for width in payload[:3]:
        out.append(np.frombuffer(payload, _WIDTHS[width], entries, at))
        at += entries * _WIDTHS[width].itemsize
    return first + np.cumsum(out[0], dtype=np.int64), out[1], out[2]


def _numbered(key: str, carried: tuple[str, ...] = ()):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(key)
        numbers = np.arange(table.num_rows, dtype=np.int32)
        if not carried:
            return pa.table({"shard": table["shard"], "number": pa.array(numbers), key: table[key]})
        # a number for each place of its key, as a join of both would give: one, unless keys repeat
        keys = table[key].combine_chunks()
        keys = keys.drop_null()
        table, numbers = table.slice(0, len(keys)), numbers[:len(keys)]
        runs = np.cumsum(np.r_[False, pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)]) if len(keys) else numbers
        sizes = np.bincount(runs) if len(keys) else numbers
        times = sizes[runs] if len(keys) else numbers
        begins = np.repeat(np.cumsum(sizes) - sizes, sizes)
        place = np.repeat(begins, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        table = table.take(pa.array(place))
        return pa.table({"shard": table["shard"], "number": pa.array(np.repeat(numbers, times)), key: table[key],
                         **{c: table[c] for c in carried}})
    return run


def _packed(numbers: np.ndarray, frequencies: np.ndarray, lengths: np.ndarray, begins: np.ndarray) -> pa.Array:
    """:func:`pack` of all blocks at once; ``begins`` are their first entries."""
    entries = np.diff(begins, append=len(numbers))
    gaps = np.diff(numbers, prepend=0)
    gaps[begins] = 0
    parts = (gaps, frequencies, lengths)
    widths = [np.searchsorted([1 << 8, 1 << 16], np.maximum.reduceat(part, begins), side="right") for part in parts]
    ends = np.cumsum(3 + entries * sum(1 << w for w in widths))
    offsets = np.r_[0, ends]
    data = np.zeros(offsets[-1], np.uint8)
    at = offsets[:-1]
    for i, width in enumerate(widths):
        data[at + i] = width
    at, inside = at + 3, np.arange(len(numbers)) - np.repeat(begins, entries)
    for part, width in zip(parts, widths):
        size = np.repeat(1 << width, entries)
        spot = np.repeat(at, entries) + inside * size
        data[spot] = part & 255
        for byte in (1, 2, 3):
            wide = np.flatnonzero(size > byte)
            if len(wide):
                data[spot[wide] + byte] = part[wide] >> 8 * byte & 255
        at = at + (entries << width)
    if offsets[-1] >= 1 << 31:
        return pa.chunked_array([pa.array([data[a:b].tobytes() for a, b in zip(offsets, ends)], pa.binary())])
    return pa.BinaryArray.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def _blocks(key: str, block_entries: int):
    kinds = (pa.int32(), pa.string(), *(pa.int32(),) * 6, pa.binary())
    schema = pa.schema([(c.split()[0], kind) for c, kind in zip(_SCHEMA.split(", "), kinds)])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(key)
        lists = table["tokens"].combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        held, owner = lists.flatten(), np.repeat(np.arange(len(sizes)), sizes)
        if held.null_count:  # a null is no term, and counts for the length of its row
            owner, held = owner[held.is_valid().to_numpy(zero_copy_only=False)], held.drop_null()
        if not len(held):
            return schema.empty_table()
        words = held.dictionary_encode()
        order = pc.array_sort_indices(words.dictionary).to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        # terms in their order, rows in ascending number
        pairs, frequency = np.unique(place[words.indices.to_numpy()] * len(sizes) + owner, return_counts=True)
        term, number = pairs // len(sizes), pairs % len(sizes)
        firsts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
        inside = np.arange(len(term)) - np.repeat(firsts, np.diff(firsts, append=len(term)))
        begins = np.flatnonzero(inside % block_entries == 0)
        entries, length = np.diff(begins, append=len(term)), sizes[number]
        columns = [np.full(len(begins), table["shard"][0].as_py()), words.dictionary.take(pa.array(order[term[begins]])),
                   inside[begins] // block_entries, entries, number[begins], number[begins + entries - 1],
                   np.maximum.reduceat(frequency, begins), np.minimum.reduceat(length, begins),
                   _packed(number, frequency, length, begins)]
        return pa.table([pa.array(c.astype(np.int32)) if isinstance(c, np.ndarray) else c for c in columns], schema=schema)
    return run


def with_shard(rows: DataFrame, key: str, shards: int) -> DataFrame:
    return rows.withColumn("shard", F.pmod(F.xxhash64(key), F.lit(shards)).cast("int"))


def _apart(rows: DataFrame, shards: int) -> DataFrame:
    """Shards in tasks of their own, also when they are small: adaptive execution would put them into one."""
    return rows.repartition(max(1, 3 * shards), "shard")


def build_blocks(rows: DataFrame, shards: int, key: str = "chunk_id", block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """Block rows of ``rows`` (key, ``tokens``); keys are unique. A shard is built by one task."""
    return _apart(with_shard(rows.select(key, "tokens"), key, shards), shards).groupBy("shard") \
        .applyInArrow(_blocks(key, block_entries), _SCHEMA)


def shard_numbers(rows: DataFrame, shards: int, key: str = "chunk_id", carried: tuple[str, ...] = ()) -> DataFrame:
    """``shard, number, <key>``: the key behind every number, and what else is ``carried``; rows without a key are not then."""
    kind = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("number", T.IntegerType()),
                         *(T.StructField(c, rows.schema[c].dataType) for c in (key, *carried))])
    return _apart(with_shard(rows.select(key, *carried), key, shards), shards).groupBy("shard") \
        .applyInArrow(_numbered(key, carried), kind)


def lexicon_of(blocks: DataFrame) -> DataFrame:
    """``term, df``: rows that hold each term."""
    return blocks.groupBy("term").agg(F.sum("entries").alias("df"))


def _add(found: np.ndarray, rows: np.ndarray, idf: float, numbers: np.ndarray, gain: np.ndarray) -> None:
    """Add, in place, what a term gives to those ``rows`` that it holds."""
    spot = np.minimum(np.searchsorted(numbers, rows), len(numbers) - 1)
    hit = numbers[spot] == rows
    found[hit] += idf * gain[spot[hit]]


@dataclass
class ShardPostings:
    """The blocks of one shard that a query batch may need; counts what it opens."""

    table: pa.Table
    average: float
    k1: float = K1
    b: float = B
    dead: np.ndarray | None = None
    opened: int = 0
    _open: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)
    _whole: dict[int, tuple[np.ndarray, np.ndarray]] = field(default_factory=dict)

    def __post_init__(self):
        table = self.table = self.table.sort_by([("term", "ascending"), ("block", "ascending")]).combine_chunks()
        self.first, self.last, self.entries = (table[c].to_numpy() for c in ("first", "last", "entries"))
        self.bound = self._gain(table["most_tf"].to_numpy(), table["least_length"].to_numpy())
        self.payload = table["payload"]
        terms = table["term"].combine_chunks().dictionary_encode() if table.num_rows else None
        self.range: dict[str, tuple[int, int]] = {}
        if terms is not None:
            terms = terms.chunk(0) if isinstance(terms, pa.ChunkedArray) else terms
            codes = terms.indices.to_numpy()
            begins = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
            for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(codes)]):
                self.range[terms.dictionary[int(codes[a])].as_py()] = (a, b)
        self.size = int(self.last.max(initial=-1)) + 1

    @property
    def blocks(self) -> int:
        return len(self.first)

    def _gain(self, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        return tf * (self.k1 + 1) / (tf + self.k1 * (1 - self.b + self.b * length / self.average))

    def block(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and gains of block ``i``."""
        held = self._open.get(i)
        if held is None:
            numbers, tf, length = unpack(self.payload[i].as_py(), int(self.entries[i]), int(self.first[i]))
            held = self._open[i] = (numbers, self._gain(tf.astype(float), length))
            self.opened += 1
        return held

    def whole(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """All entries of a term."""
        held = self._whole.get(low)
        if held is None:
            parts = [self.block(i) for i in range(low, high)]
            held = self._whole[low] = parts[0] if len(parts) == 1 else tuple(map(np.concatenate, zip(*parts)))
        return held

    def top_k(self, weights: dict[str, float], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and scores of the ``k`` best rows; greater score first, then smaller number."""
        terms = [(idf * self.bound[slice(*self.range[t])].max(), idf, *self.range[t])
                 for t, idf in weights.items() if t in self.range]
        terms.sort(key=lambda t: -t[0])
        rest = np.r_[np.cumsum([t[0] for t in terms][::-1])[::-1], 0.0] * (1 + _SLACK)
        scores = np.zeros(self.size)
        if self.dead is not None:
            scores[self.dead[self.dead < self.size]] = -np.inf
        floor, done = 0.0, 0
        # any row may still be among the best
        while done < len(terms) and floor <= rest[done]:
            _, idf, low, high = terms[done]
            numbers, gain = self.whole(low, high)
            scores[numbers] += idf * gain
            done += 1
            if done & (done - 1) == 0 or done == len(terms):
                floor = self._floor(scores, k, floor)
        rows = np.flatnonzero(scores > 0)
        found = scores[rows]
        # only rows that were met can
        looked_at = math.inf
        for at in range(done, len(terms) + 1):
            if at == len(terms) or len(found) < looked_at / 2 or (at - done) % 4 == 0:
                floor, looked_at = self._floor(found, k, floor), len(found)
            fine = found + rest[at] >= floor * (1 - _SLACK)
            rows, found = rows[fine], found[fine]
            if at == len(terms) or not len(rows):
                break
            _, idf, low, high = terms[at]
            if low in self._whole:
                _add(found, rows, idf, *self._whole[low])
                continue
            place = low + np.searchsorted(self.last[low:high], rows)
            inside = place < high
            inside[inside] &= self.first[place[inside]] <= rows[inside]
            # with the best of its block and of the terms to come, can it reach the floor?
            reach = found + rest[at + 1]
            reach[inside] += idf * self.bound[place[inside]] * (1 + _SLACK)
            keep = reach >= floor * (1 - _SLACK)
            rows, found, place, inside = rows[keep], found[keep], place[keep], inside[keep]
            for i in np.unique(place[inside]).tolist():
                mine = slice(*np.searchsorted(place, [i, i + 1]))  # rows and so their blocks ascend
                _add(found[mine], rows[mine], idf, *self.block(i))
        found = significant(found)
        order = np.lexsort((rows, -found))[:k]
        return rows[order], found[order]

    @staticmethod
    def _floor(scores: np.ndarray, k: int, least: float) -> float:
        """The k-th best sum so far: no result can be below it. It is not below ``least``, so only sums above that are ordered."""
        above = scores[scores > least]
        if len(above) < k:
            return least
        return float(np.partition(above, len(above) - k)[len(above) - k])


@dataclass
class QueryBatch:
    ids: list
    id_type: T.DataType
    terms: list[list[str]]

    @classmethod
    def of(cls, queries: DataFrame, query_id: str, text: str) -> QueryBatch:
        held = queries.select(F.col(query_id).alias("q"), F.array_distinct(tokens(text)).alias("terms")).collect()
        return cls([r.q for r in held], queries.schema[query_id].dataType, [r.terms or [] for r in held])

    def vocabulary(self) -> list[str]:
        return sorted({t for terms in self.terms for t in terms})


def search_blocks(blocks: DataFrame, batch: QueryBatch, lexicon: DataFrame, size: tuple[int, float], k: int,
                  dead: DataFrame | None = None, shards: int | None = None, k1: float = K1, b: float = B) -> DataFrame:
    """``query, shard, number, score``: up to k rows of every shard for each query (its place in the batch).

    ``lexicon`` (term, df; several rows of a term are summed) and ``size`` (rows, average length) count
    living rows only; ``dead`` (shard, number) are passed over. The batch and the statistics of
    its terms go to the tasks.
    """
    spark, vocabulary = blocks.sparkSession, batch.vocabulary()
    asked = spark.createDataFrame(pa.table({"term": pa.array(vocabulary, pa.string())}))
    if sum(map(len, vocabulary)) * 4 + 16 * len(vocabulary) <= BROADCAST_LIMIT_BYTES:
        asked = F.broadcast(asked)
    n, average = size
    df = {r.term: r.df for r in lexicon.join(asked, "term").groupBy("term").agg(F.sum("df").alias("df")).collect() if r.df > 0}
    idf = {t: math.log(1 + (n - d + 0.5) / (d + 0.5)) for t, d in df.items()}
    weights = [{t: idf[t] for t in terms if t in idf} for terms in batch.terms]

    def answer(table: pa.Table, gone: pa.Table | None = None) -> pa.Table:
        shard = ShardPostings(table, average, k1, b, None if gone is None else gone["number"].to_numpy())
        found = [shard.top_k(w, k) for w in weights]
        sizes = [len(rows) for rows, _ in found]
        name = table["shard"][0].as_py() if table.num_rows else 0
        return pa.table({"query": pa.array(np.repeat(np.arange(len(found)), sizes).astype(np.int32)),
                         "shard": pa.array(np.full(sum(sizes), name, np.int32)),
                         "number": pa.array(np.concatenate([r for r, _ in found] or [np.zeros(0)]).astype(np.int32)),
                         "score": pa.array(np.concatenate([s for _, s in found] or [np.zeros(0)]).astype(float))})

    few = blocks.join(asked, "term", "left_semi") if len(vocabulary) > 200 else blocks.filter(F.col("term").isin(vocabulary))
    schema = "query int, shard int, number int, score double"
    few = few if shards is None else _apart(few, shards)
    if dead is None:
        return few.groupBy("shard").applyInArrow(lambda table: answer(table), schema)
    return few.groupBy("shard").cogroup(dead.select("shard", "number").groupBy("shard")).applyInArrow(answer, schema)


def ranked_keys(found: DataFrame, numbers: DataFrame, batch: QueryBatch, k: int, key: str = "chunk_id",
                shards: int | None = None) -> DataFrame:
    """``query_id, <key>, score, rank`` from rows of shards.

    Of many rows, those that others of their query beat k times go before keys are looked up; rows on the k-th score stay.
    """
    spark = found.sparkSession
    if shards is not None and shards * len(batch.ids) * k <= FEW_ROWS:
        found = F.broadcast(cut_lineage(found, "shard-results"))  # the numbers of all rows are not shuffled
    else:
        found = found.withColumn("place", F.rank().over(Window.partitionBy("query").orderBy(F.col("score").desc()))) \
            .filter(F.col("place") <= k).drop("place")
    ids = spark.createDataFrame(list(enumerate(batch.ids)),
                                T.StructType([T.StructField("query", T.IntegerType()), T.StructField("query_id", batch.id_type)]))
    named = numbers.join(found, ["shard", "number"]).join(F.broadcast(ids), "query")
    return rank_rows(named.select("query_id", key, "score"), key, k)


def bm25_blocks(blocks: DataFrame, numbers: DataFrame, queries: DataFrame, lexicon: DataFrame, size: tuple[int, float],
                k: int = 10, key: str = "chunk_id", query_id: str = "query_id", query_text: str = "query",
                dead: DataFrame | None = None, shards: int | None = None, max_queries: int = MAX_QUERY_ROWS) -> DataFrame:
    """The ``k`` best rows per query from stored blocks: ``query_id, <key>, score, rank``."""
    def answer(part: DataFrame) -> DataFrame:
        batch = QueryBatch.of(part, query_id, query_text)
        found = search_blocks(blocks, batch, lexicon, size, k, dead, shards)
        return ranked_keys(found, numbers, batch, k, key, shards)

    return in_batches(queries, query_id, max_queries, answer)


def count_blocks(parts: Iterator[ShardPostings]) -> tuple[int, int]:
    """(opened, all) blocks of some shards."""
    parts = list(parts)
    return sum(p.opened for p in parts), sum(p.blocks for p in parts)
