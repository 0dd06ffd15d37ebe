"""SimHash fingerprints of documents and the search for near ones (operator 12).

Terms are the pairs and triples of neighbouring words (the start of a text counts as a word, words of
more than ``LONG_WORD`` bytes are cut into pieces), so every text with a word has terms. Each occurrence
votes with the weight of its kind on 256 bits, for one and against zero by the bits of its hash; a
fingerprint holds the sign of each sum. The share of bits in which two fingerprints differ estimates
the angle between the weighted term vectors, and ``likeness`` is its cosine, at least 0.

``near_links`` finds all pairs of fingerprints within a Hamming radius: the bits are cut into more
blocks than the radius, so near fingerprints agree on some set of blocks. There is one table for each
such set, in which these blocks come first as the key; rows of a key are compared in full. A key that
more than ``HOT_ROWS`` fingerprints share is divided again, by the same rule on its other bits. A pair is
given by the first table that holds it, so no pair comes twice and none is lost.

Null texts count as empty; an empty text has all bits zero, a text of blanks only votes as one term.
Equal texts have equal fingerprints. Documents with null doc_id come first in the order; those with one doc_id are
ordered by the xxhash64 of their text, equal rows follow one another. With one document, it is its own next one.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataseek.llm.common import bucket_count, buffers, cut_lineage, mix, slices, span_hashes, word_spans
from strataseek.operators.skew import balanced_join

WORDS = 4
BITS = 64 * WORDS
RADIUS = 7
BLOCKS = 8
PAIR_WEIGHT, TRIPLE_WEIGHT = 1, 1
LONG_WORD, PIECE = 24, 12
HOT_ROWS = 50_000

_PARTS = [f"f{k}" for k in range(WORDS)]
_START = np.uint64(0x2545F4914F6CDD1D)
_SALT = mix(np.arange(1, 2 + WORDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_LANES = np.uint64(0x0101010101010101)


def _pieces(starts: np.ndarray, ends: np.ndarray, rows: np.ndarray):
    """Long words as consecutive pieces."""
    size = ends - starts
    count = np.where(size > LONG_WORD, -(-size // PIECE), 1)
    if count.max(initial=1) == 1:
        return starts, ends, rows
    number = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    first, last = np.repeat(starts, count) + number * PIECE, np.repeat(ends, count)
    cut = np.repeat(count > 1, count)
    return first, np.where(cut, np.minimum(first + PIECE, last), last), np.repeat(rows, count)


def _ones(hashes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set in the hashes of each row (rows start at ``begins``).

    Eight counters share a number; 255 terms at most are summed before they are spread.
    """
    sizes = np.diff(np.r_[begins, len(hashes)])
    parts = -(-sizes // 255)
    owner = np.cumsum(parts) - parts
    cuts = np.repeat(begins, parts) + 255 * (np.arange(int(parts.sum())) - np.repeat(owner, parts))
    out = np.empty((len(begins), 8, 8), np.int64)
    for k in range(8):
        sums = np.add.reduceat(hashes >> np.uint64(k) & _LANES, cuts)
        out[:, :, k] = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8), owner, axis=0, dtype=np.int64)
    return out.reshape(len(begins), 64)


def fingerprints(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows, WORDS) fingerprints of texts given as bytes and offsets."""
    n_rows = len(offsets) - 1
    found = np.zeros((n_rows, WORDS), np.uint64)
    starts, ends, rows = word_spans(data, offsets)
    blank = np.setdiff1d(np.flatnonzero(np.diff(offsets)), rows)
    starts, ends, rows = _pieces(starts, ends, rows)
    words = span_hashes(data, starts, ends)
    if len(blank):
        at = np.searchsorted(rows, blank)
        rows, words = np.insert(rows, at, blank), np.insert(words, at, span_hashes(data, offsets[blank], offsets[blank + 1]))
    if not len(words):
        return found
    first = np.r_[True, rows[1:] != rows[:-1]]
    begins = np.flatnonzero(first)
    with np.errstate(over="ignore"):
        before = np.r_[_START, words[:-1]]
        before[first] = _START
        pairs = mix(before * np.uint64(0xC2B2AE3D27D4EB4F) + words)
        earlier = np.r_[_START, pairs[:-1]]
        earlier[first] = _START
        triples = mix(earlier * np.uint64(0x165667B19E3779F9) + words)
    terms = np.diff(np.r_[begins, len(words)])
    for k in range(WORDS):
        votes = sum(weight * (2 * _ones(mix(h ^ _SALT[k]), begins) - terms[:, None])
                    for weight, h in ((PAIR_WEIGHT, pairs), (TRIPLE_WEIGHT, triples)))
        # bit 8 * lane + k of the little-endian number
        found[rows[begins], k] = np.packbits(votes > 0, axis=1, bitorder="little").view("<u8")[:, 0]
    return found


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated cosine of the term vectors behind two arrays of fingerprints."""
    differ = np.bitwise_count(a ^ b).sum(axis=1)
    return np.maximum(0.0, np.where(differ == 0, 1.0, np.cos(np.pi * differ / BITS)))


def hex_text(prints: np.ndarray) -> list[str]:
    raw = prints.astype(">u8").tobytes().hex()
    return [raw[k:k + 16 * WORDS] for k in range(0, len(raw), 16 * WORDS)]


def with_fingerprint(documents: DataFrame, text: str = "text", prefix: str = "f") -> DataFrame:
    """doc_id and the fingerprint of every text as columns f0 .. f3 (long)."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                            F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))

    def run(batches):
        for batch in slices(batches, "text"):
            found = fingerprints(*buffers(batch.column("text"))).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(found[:, k]) for k in range(WORDS))],
                                             names=["doc_id", *(f"{prefix}{k}" for k in range(WORDS))])

    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"{prefix}{k} long" for k in range(WORDS)))


# -- near fingerprints -------------------------------------------------------------------------

def _bit_range(begin: int, end: int) -> Column:
    """Bits ``begin`` to before ``end`` of a fingerprint as one number; they lie in one word."""
    word, shift = divmod(begin, 64)
    value = F.shiftrightunsigned(_PARTS[word], shift)
    return value if end - begin == 64 else value.bitwiseAND(F.lit((1 << (end - begin)) - 1))


def _ranges(bits: list[tuple[int, int]], blocks: int) -> list[list[tuple[int, int]]]:
    """The bits of some ranges, dealt to ``blocks`` blocks of consecutive ones; a block is a list of ranges."""
    single = [b for begin, end in bits for b in range(begin, end)]
    out = []
    for k in range(blocks):
        own = single[len(single) * k // blocks:len(single) * (k + 1) // blocks]
        ranges = []
        for b in own:
            if ranges and ranges[-1][1] == b and b % 64:
                ranges[-1][1] = b + 1
            else:
                ranges.append([b, b + 1])
        out.append([tuple(r) for r in ranges])
    return out


def _key(chosen: list[list[tuple[int, int]]]) -> Column:
    return F.xxhash64(*(_bit_range(a, b) for block in chosen for a, b in block))


def _same(block: list[tuple[int, int]], left: str, right: str) -> str:
    """SQL: both fingerprints agree on a block."""
    tests = []
    for begin, end in block:
        word, shift = divmod(begin, 64)
        mask = ((1 << (end - begin)) - 1) << shift
        mask -= (mask >> 63) << 64
        tests.append(f"(({left}.f{word} ^ {right}.f{word}) & {mask}L) = 0" if mask != -(1 << 63)
                     else f"shiftright({left}.f{word} ^ {right}.f{word}, 63) = 0")
    return " AND ".join(tests)


def near_links(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """All pairs of different fingerprints (f0 .. f3) that differ in at most ``radius`` bits.

    Columns a0 .. a3 and b0 .. b3, the smaller fingerprint first, and ``distance``. Repeated and null
    fingerprints count once and not at all.
    """
    if not radius < blocks <= BITS:
        raise ValueError("there must be more blocks than the radius")
    rows = cut_lineage(prints.select(*_PARTS).dropna().distinct(), "prints")
    tables = list(combinations(range(blocks), blocks - radius))
    outer = _ranges([(64 * k, 64 * k + 64) for k in range(WORDS)], blocks)
    keyed = rows.select(*_PARTS, F.explode(F.array(*(
        F.struct(F.lit(t).alias("t"), _key([outer[b] for b in chosen]).alias("key"))
        for t, chosen in enumerate(tables)))).alias("k")).select(*_PARTS, "k.t", "k.key")
    hot = cut_lineage(keyed.groupBy("t", "key").count().filter(F.col("count") > hot_rows).select("t", "key"), "hot-keys")
    cold = keyed if hot.isEmpty() else keyed.join(hot, ["t", "key"], "left_anti")
    cold = cold.withColumns({"t2": F.lit(-1), "key2": F.lit(0).cast("long")})
    parts = [cold]
    inner: dict[int, list] = {}
    if not hot.isEmpty():
        crowded = keyed.join(hot, ["t", "key"], "left_semi")
        for t, chosen in enumerate(tables):
            rest = sorted(r for b in range(blocks) if b not in chosen for r in outer[b])
            inner[t] = _ranges(rest, blocks)
            parts.append(crowded.filter(F.col("t") == t).select(*_PARTS, "t", "key", F.explode(F.array(*(
                F.struct(F.lit(s).alias("t2"), _key([inner[t][b] for b in again]).alias("key2"))
                for s, again in enumerate(tables)))).alias("k")).select(*_PARTS, "t", "key", "k.t2", "k.key2"))
    all_rows = parts[0]
    for part in parts[1:]:
        all_rows = all_rows.unionByName(part)
    distance = " + ".join(f"bit_count(a.f{k} ^ b.f{k})" for k in range(WORDS))
    smaller = "struct(a.f0, a.f1, a.f2, a.f3) < struct(b.f0, b.f1, b.f2, b.f3)"

    def first_table(layout):
        """The number of the first set of blocks on which both agree: that of the first blocks that do."""
        return "CASE " + " ".join(
            f"WHEN {' AND '.join(_same(layout[b], 'a', 'b') for b in chosen if layout[b])} THEN {s}"
            for s, chosen in enumerate(tables) if any(layout[b] for b in chosen)) + " ELSE 0 END"

    joined = all_rows.alias("a").join(all_rows.alias("b"), F.expr(
        f"a.t = b.t AND a.key = b.key AND a.t2 = b.t2 AND a.key2 = b.key2 AND {smaller} "
        f"AND {distance} <= {radius} AND a.t = {first_table(outer)}"
        + (" AND CASE a.t2 WHEN -1 THEN true ELSE a.t2 = CASE a.t " + " ".join(
            f"WHEN {t} THEN {first_table(layout)}" for t, layout in inner.items())
           + " END END" if inner else "")))
    return joined.select(*(F.expr(f"{s}.f{k}").alias(f"{s}{k}") for s in "ab" for k in range(WORDS)),
                         F.expr(distance).alias("distance"))


# -- every document with the next one ----------------------------------------------------------

_ROW = ("kind int, part int, doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double, "
        + ", ".join(f"f{k} long" for k in range(WORDS)) + ", text binary")
_NAMES = [c.split()[0] for c in _ROW.split(", ")]
_DONE, _HEAD, _TAIL = 0, 1, 2


def _prints_of(texts: list[bytes]) -> np.ndarray:
    return fingerprints(*buffers(pa.array(texts, pa.binary())))


def _batch(kind: int, part: int, ids: list, texts: list[bytes] | None, done=None) -> pa.RecordBatch:
    size = len(ids)
    done = done or [pa.nulls(size, t) for t in (pa.int64(), *(pa.string(),) * 3, *(pa.float64(),) * 2, *(pa.int64(),) * WORDS)]
    raw = pa.nulls(size, pa.binary()) if texts is None else pa.array(texts, pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([kind] * size, pa.int32()), pa.array([part] * size, pa.int32()),
                                       pa.array(ids, pa.int64()), *done, raw], names=_NAMES)


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _strings(texts: list[bytes]) -> list[str]:
    return [t.decode("utf-8", "surrogateescape") for t in texts]


def _compare(part: int, ids: list, texts: list[str], own: np.ndarray, following: list[str],
             next_prints: np.ndarray) -> pa.RecordBatch:
    changed = [edited(a, b).encode("utf-8", "surrogateescape") for a, b in zip(texts, following)]
    prints = _prints_of(changed)
    done = [pa.array(list(map(len, texts)), pa.int64()),
            pa.array([hashlib.sha256(c).hexdigest() for c in changed], pa.string()),
            pa.array(hex_text(own), pa.string()), pa.array(hex_text(prints), pa.string()),
            pa.array(likeness(own, prints)), pa.array(likeness(own, next_prints)),
            *(pa.array(own[:, k].view(np.int64)) for k in range(WORDS))]
    return _batch(_DONE, part, ids, None, done)


def _stream(batches):
    """Rows of one sorted range: each is compared with the one after it; the first and the last are passed on."""
    part = TaskContext.get().partitionId()
    held = None  # (doc_id, text, fingerprint) of the row before this slice
    for batch in slices(batches, "text"):
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
        prints = fingerprints(*buffers(batch.column("text")))
        if held is None:
            yield _batch(_HEAD, part, ids[:1], texts[:1])
        else:
            ids, texts, prints = [held[0], *ids], [held[1], *texts], np.vstack([held[2][None], prints])
        if len(ids) > 1:
            strings = _strings(texts)
            yield _compare(part, ids[:-1], strings[:-1], prints[:-1], strings[1:], prints[1:])
        held = (ids[-1], texts[-1], prints[-1])
    if held is not None:
        yield _batch(_TAIL, part, [held[0]], [held[1]])


def _finish(batches):
    """The last row of a range with the first of the next one."""
    for batch in slices(batches, "text"):
        texts, following = batch.column("text").to_pylist(), batch.column("next_text").to_pylist()
        for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), texts, following):
            yield _compare(-1, [doc_id], _strings([a]), _prints_of([a]), _strings([b]), _prints_of([b]))


def compare_with_next(documents: DataFrame) -> DataFrame:
    """Every document with its fingerprint, that of its edited text and that of the next document.

    Texts move once, to the range of their doc_id. Only the first and last text of a range move again.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                            F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    order = ["doc_id", "tie", "row"]
    ranges = rows.withColumns({"tie": F.xxhash64(F.col("text").cast("string")), "row": F.monotonically_increasing_id()}) \
        .repartitionByRange(bucket_count(rows, per_split=2, least=8), *order).sortWithinPartitions(*order)
    made = cut_lineage(ranges.select("doc_id", "text").mapInArrow(_stream, _ROW), "compared")
    heads = sorted(r["part"] for r in made.filter(F.col("kind") == _HEAD).select("part").toLocalIterator())
    following = spark.createDataFrame(list(zip(heads, heads[1:] + heads[:1])), "part int, next_part int")
    edges = made.filter(F.col("kind") == _TAIL).select("part", "doc_id", "text").join(following, "part").join(
        made.filter(F.col("kind") == _HEAD).select(F.col("part").alias("next_part"), F.col("text").alias("next_text")),
        "next_part").select("doc_id", "text", "next_text")
    return made.filter(F.col("kind") == _DONE).unionAll(edges.mapInArrow(_finish, _ROW)).drop("kind", "part", "text")


def fingerprint_report(documents: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The columns of ``compare_with_next``, and how many other fingerprints of the table lie within ``radius`` bits."""
    rows = cut_lineage(compare_with_next(documents), "fingerprints")
    links = near_links(rows, radius)
    ends = links.select(*(F.col(f"a{k}").alias(f"f{k}") for k in range(WORDS))).unionAll(
        links.select(*(F.col(f"b{k}").alias(f"f{k}") for k in range(WORDS))))
    counts = cut_lineage(ends.groupBy(*_PARTS).agg(F.count(F.lit(1)).alias("n_near")), "near-counts")
    return balanced_join(rows, counts, _PARTS, ["doc_id", "edited_sha256"], F.lit(8 * WORDS + 24), how="left") \
        .drop(*_PARTS).withColumn("n_near", F.coalesce("n_near", F.lit(0).cast("long")))
