"""Alignment of two tokenizers over the same bytes (operator 13).

A is a byte-level BPE over a space and the text, B a SentencePiece model over the text, which adds
that space. Where tokens of both end, the text is cut into groups. The ends are found by a galloping
intersection: in each document the shorter list of ends drives a search in the longer one, from the
rank that is likely, in doubling steps and then by halves. Positions of common ends slice the groups,
and differences of ranks give the range of tokens of the other side that each group holds.

Counts of linked id pairs are taken over all documents: a task numbers the pairs of a batch of texts
(``BATCH_BYTES``), the numbers stay with the documents, and one row a batch and pair is summed, ranked
within its B id and brought back to the batch. So no key holds more than one row a batch, and
nothing is broadcast by force.

Texts that are null, empty, or that either tokenizer does not give back byte by byte have no tokens:
all numbers are 0 and ``groups_sha256`` is ''. Repeated rows are counted as often as they stand.
Null doc_ids are kept. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataseek.llm.byte_bpe import ByteBpe, _byte_letters
from strataseek.llm.common import buffers, cut_lineage, slices
from strataseek.llm.sentencepiece import SentencePieceCodec
from strataseek.llm.spans import gather

BATCH_BYTES = 32 << 20
SLICE_BYTES = 1 << 20
#: Pairs of a batch are numbered by two bytes while there are no more than this.
NARROW = 1 << 16


class PlainByteBpe(ByteBpe):
    """Strings of special tokens are plain text."""

    def __init__(self, vocabulary: str):
        super().__init__(vocabulary)
        self.tokenizer.encode_special_tokens = True
        self._special = []
        back = {chr(c): b for b, c in enumerate(_byte_letters())}
        entries = self.tokenizer.get_vocab(with_added_tokens=True)
        texts = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            texts[i] = bytes(back[c] for c in entry) if all(c in back for c in entry) else entry.encode()
        self.size = np.fromiter(map(len, texts), np.int64, len(texts))
        self.at = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)


def gallop(values: np.ndarray, ends: np.ndarray, guess: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """First place in ``ends[low:high]`` that is not below each value, searched for from ``guess``.

    Steps away from the guess double until they pass the value; halving the last step finds the place.
    """
    below = ends[guess] < values
    left, right = np.where(below, guess + 1, low), np.where(below, high, guess)
    active, step = np.flatnonzero(left < right), 1
    while len(active):
        ahead = below[active]
        probe = guess[active] + np.where(ahead, step, -step)
        inside = np.where(ahead, probe < right[active], probe >= left[active])
        active, probe, ahead = active[inside], probe[inside], ahead[inside]
        less = ends[probe] < values[active]
        left[active[less]] = probe[less] + 1
        right[active[~less]] = probe[~less]
        active, step = active[ahead == less], 2 * step
    active = np.flatnonzero(left < right)
    while len(active):
        middle = (left[active] + right[active]) >> 1
        less = ends[middle] < values[active]
        left[active[less]] = middle[less] + 1
        right[active[~less]] = middle[~less]
        active = active[left[active] < right[active]]
    return left


def common_ends(a_ends: np.ndarray, b_ends: np.ndarray, a_counts: np.ndarray,
                b_counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in both lists of the ends that they share.

    The lists are those of all rows one after the other, ascending; a row has ``counts`` of them.
    """
    a_first, b_first = np.cumsum(a_counts) - a_counts, np.cumsum(b_counts) - b_counts
    a_leads = a_counts <= b_counts
    found = []
    for lead, ends, firsts, counts, others, other_firsts, other_counts in (
            (a_leads, a_ends, a_first, a_counts, b_ends, b_first, b_counts),
            (~a_leads, b_ends, b_first, b_counts, a_ends, a_first, a_counts)):
        rows = np.repeat(np.arange(len(counts)), np.where(lead, counts, 0))
        rank = np.arange(len(rows)) - np.repeat(np.cumsum(np.where(lead, counts, 0)) - np.where(lead, counts, 0),
                                                np.where(lead, counts, 0))
        own = firsts[rows] + rank
        low, high = other_firsts[rows], other_firsts[rows] + other_counts[rows]
        guess = low + rank * other_counts[rows] // np.maximum(counts[rows], 1)
        place = gallop(ends[own], others, guess, low, high)
        hit = (place < high) & (others[np.minimum(place, max(len(others) - 1, 0))] == ends[own]) if len(own) else \
            np.zeros(0, bool)
        found.append((own[hit], place[hit]))
    a_at, b_at = np.r_[found[0][0], found[1][1]], np.r_[found[0][1], found[1][0]]
    order = np.argsort(a_at, kind="stable")
    return a_at[order], b_at[order]


class _Decimals:
    """Decimal texts of small numbers, each with a sign behind it, for joining many at once."""

    SIGNS = b",|;"

    def __init__(self, most: int):
        texts = [b"%d%c" % (i, sign) for sign in self.SIGNS for i in range(most)]
        self.most = most
        self.size = np.fromiter(map(len, texts), np.int64, len(texts))
        self.at = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)


@dataclass
class Aligned:
    """Tokens of the rows of a slice. Groups are (a_at, b_at): the last token of each side."""

    a_ids: np.ndarray
    b_ids: np.ndarray
    a_counts: np.ndarray
    b_counts: np.ndarray
    a_ends: np.ndarray
    a_at: np.ndarray
    b_at: np.ndarray
    groups: np.ndarray  # number of groups of each row


class Aligner:
    """Both encoders of one worker."""

    def __init__(self, vocabulary: str, model_file: str):
        self.a = PlainByteBpe(vocabulary)
        self.b = SentencePieceCodec(model_file)
        self.decimals = _Decimals(max(len(self.a.size), len(self.b.piece_size)))

    def align(self, data: np.ndarray, offsets: np.ndarray) -> Aligned:
        lengths = np.diff(offsets)
        spaced, spaced_at = np.insert(data, offsets[:-1], 32), offsets + np.arange(len(offsets))
        a_ids, a_counts = self.a.encode(spaced, spaced_at)
        b_ids, b_counts, _ = self.b.encode(data, offsets)
        a_size, b_size = self.a.size[a_ids], self.b.piece_size[b_ids]
        keep = (lengths > 0) & _gives_back(spaced, spaced_at, gather(self.a.bytes, self.a.at[a_ids], a_size), a_size, a_counts) \
            & _gives_back(spaced, spaced_at, gather(self.b.piece_bytes, self.b.piece_at[b_ids], b_size), b_size, b_counts)
        if not keep.all():
            a_on, b_on = np.repeat(keep, a_counts), np.repeat(keep, b_counts)
            a_ids, a_size, b_ids, b_size = a_ids[a_on], a_size[a_on], b_ids[b_on], b_size[b_on]
            a_counts, b_counts = np.where(keep, a_counts, 0), np.where(keep, b_counts, 0)
        a_ends, b_ends = np.cumsum(a_size), np.cumsum(b_size)
        a_at, b_at = common_ends(a_ends, b_ends, a_counts, b_counts)
        rows = np.repeat(np.arange(len(lengths)), a_counts)
        groups = np.bincount(rows[a_at], minlength=len(lengths)).astype(np.int64)
        return Aligned(a_ids.astype(np.int64), b_ids.astype(np.int64), a_counts, b_counts, a_ends, a_at, b_at, groups)

    def group_texts(self, x: Aligned) -> list[bytes]:
        """``a1,a2|b1;a3|b2`` of every row."""
        a_per, b_per = np.diff(np.r_[-1, x.a_at]), np.diff(np.r_[-1, x.b_at])
        # A token stands behind the B tokens of the groups before its own, and a B token behind the A tokens up to its own.
        a_place = np.arange(len(x.a_ids)) + np.repeat(x.b_at + 1 - b_per, a_per)
        b_place = np.arange(len(x.b_ids)) + np.repeat(x.a_at + 1, b_per)
        which = np.empty(len(x.a_ids) + len(x.b_ids), np.int64)
        which[a_place], which[b_place] = x.a_ids, x.b_ids
        which[a_place[x.a_at]] += self.decimals.most
        which[b_place[x.b_at]] += 2 * self.decimals.most
        size = self.decimals.size[which]
        raw = gather(self.decimals.bytes, self.decimals.at[which], size).tobytes()
        ends = np.r_[0, np.cumsum(size)][np.r_[0, np.cumsum(x.a_counts + x.b_counts)]].tolist()
        return [raw[a:b - 1] if b > a else b"" for a, b in zip(ends, ends[1:])]


def _gives_back(data: np.ndarray, offsets: np.ndarray, joined: np.ndarray, size: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Which rows the joined bytes of their tokens equal."""
    if len(joined) == len(data) and np.array_equal(joined, data):
        return np.ones(len(counts), bool)
    ends = np.r_[0, np.cumsum(size)][np.r_[0, np.cumsum(counts)]]
    return np.array([np.array_equal(joined[a:b], data[c:d]) for a, b, c, d in zip(
        ends[:-1].tolist(), ends[1:].tolist(), offsets[:-1].tolist(), offsets[1:].tolist())], bool)


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                            F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))


def _int_lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), pa.array(values.astype(np.int32)))


_GROUPS = "array<struct<end_byte:long,a_from:int,a_to:int,b_from:int,b_to:int>>"


def alignments(documents: DataFrame, vocabulary: str, model_file: str) -> DataFrame:
    """doc_id, the ids of both sides and the groups of every document.

    A group has the byte at which it ends in a space and the text, and the ranges of its tokens on
    either side (the last one not included). Each token of a group overlaps only tokens of that group.
    """
    def run(batches):
        aligner = Aligner(vocabulary, model_file)
        for batch in slices(batches, "text", SLICE_BYTES):
            x = aligner.align(*buffers(batch.column("text")))
            a_first, b_first = np.cumsum(x.a_counts) - x.a_counts, np.cumsum(x.b_counts) - x.b_counts
            rows = np.repeat(np.arange(len(x.groups)), x.groups)
            starts = np.r_[0, np.cumsum(x.groups)]
            a_to, b_to = x.a_at + 1 - a_first[rows], x.b_at + 1 - b_first[rows]
            first = np.zeros(len(rows), bool)
            first[starts[:-1][x.groups > 0]] = True
            a_from, b_from = (np.where(first, 0, np.r_[0, to[:-1]]) if len(to) else to for to in (a_to, b_to))
            base = np.r_[0, x.a_ends][a_first]
            group = pa.StructArray.from_arrays(
                [pa.array(x.a_ends[x.a_at] - base[rows]), *(pa.array(v.astype(np.int32)) for v in (a_from, a_to, b_from, b_to))],
                names=["end_byte", "a_from", "a_to", "b_from", "b_to"])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), _int_lists(x.a_ids, x.a_counts), _int_lists(x.b_ids, x.b_counts),
                 pa.ListArray.from_arrays(pa.array(starts, pa.int32()), group)],
                names=["doc_id", "a_ids", "b_ids", "groups"])

    return _texts(documents).mapInArrow(run, f"doc_id long, a_ids array<int>, b_ids array<int>, groups {_GROUPS}")


# -- counts over all documents -----------------------------------------------------------------

_MADE = ("batch long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
         "wide boolean, links binary, pairs binary, counts binary")


class _Batch:
    """Numbers of the id pairs of one batch, in the order in which they come."""

    def __init__(self, number: int):
        self.number, self.bytes = number, 0
        self.known: dict[int, int] = {}
        self.counts = np.zeros(NARROW, np.int64)

    def add(self, pairs: np.ndarray) -> np.ndarray:
        values, back, times = np.unique(pairs, return_inverse=True, return_counts=True)
        codes = np.fromiter((self.known.setdefault(v, len(self.known)) for v in values.tolist()), np.int64, len(values))
        while len(self.known) > len(self.counts):
            self.counts = np.r_[self.counts, np.zeros_like(self.counts)]
        self.counts[codes] += times
        return codes[back]

    def table(self) -> pa.RecordBatch:
        pairs = np.fromiter(self.known, np.int64, len(self.known))
        values = {"batch": pa.array([self.number], pa.int64()), "pairs": pa.array([pairs.tobytes()], pa.binary()),
                  "counts": pa.array([self.counts[:len(pairs)].tobytes()], pa.binary())}
        return _made(values, 1)


_TYPES = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}


def _made(values: dict, size: int) -> pa.RecordBatch:
    fields = [f.split() for f in _MADE.split(", ")]
    return pa.RecordBatch.from_arrays([values.get(name, pa.nulls(size, _TYPES[kind])) for name, kind in fields],
                                      names=[name for name, _ in fields])


def _encode(vocabulary: str, model_file: str, batch_bytes: int):
    def run(batches):
        aligner, number = Aligner(vocabulary, model_file), TaskContext.get().partitionId() << 32
        batch = _Batch(number)
        for rows in slices(batches, "text", SLICE_BYTES):
            data, offsets = buffers(rows.column("text"))
            x = aligner.align(data, offsets)
            pairs = x.a_ids[x.a_at] << 32 | x.b_ids[x.b_at]
            if batch.bytes and (batch.bytes + len(data) > batch_bytes or len(batch.known) + len(pairs) > NARROW
                                and len(batch.known) + len(np.unique(pairs)) > NARROW):
                yield batch.table()
                batch = _Batch(batch.number + 1)
            batch.bytes += len(data)
            codes = batch.add(pairs)
            wide = len(batch.known) > NARROW
            codes = codes.astype("<u4" if wide else "<u2")
            cuts = np.r_[0, np.cumsum(x.groups)].tolist()
            hashes = [hashlib.sha256(t).hexdigest() if t else "" for t in aligner.group_texts(x)]
            size = rows.num_rows
            yield _made({"batch": pa.array(np.full(size, batch.number)), "doc_id": rows.column("doc_id"),
                         "n_a": pa.array(x.a_counts), "n_b": pa.array(x.b_counts), "n_groups": pa.array(x.groups),
                         "n_links": pa.array(x.groups), "groups_sha256": pa.array(hashes, pa.string()),
                         "wide": pa.array([wide] * size, pa.bool_()),
                         "links": pa.array([codes[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary())}, size)
        if batch.known:
            yield batch.table()
    return run


def _pair_rows(batches):
    for batch in batches:
        for number, pairs, counts in zip(*(batch.column(c).to_pylist() for c in ("batch", "pairs", "counts"))):
            pairs, counts = np.frombuffer(pairs, np.int64), np.frombuffer(counts, np.int64)
            for k in range(0, len(pairs), NARROW):
                part = pairs[k:k + NARROW]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), number)), pa.array(np.arange(k, k + len(part))), pa.array(part >> 32),
                     pa.array(part & 0xFFFFFFFF), pa.array(counts[k:k + len(part)])], names=["batch", "code", "a", "b", "n"])


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(a, b, count, best): links of each id pair, and whether no other pair of its B id has more."""
    counts = pairs.groupBy("a", "b").agg(F.sum("n").alias("count"))
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(most, "b").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


_REPORT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups_sha256 string")


def _sum_up(documents: pa.Table, told: pa.Table) -> pa.Table:
    told = told.sort_by("code")
    counts, best = told["count"].to_numpy(), told["best"].to_numpy(zero_copy_only=False).astype(np.int64)
    n_best, sums = [], []
    for links, wide in zip(documents["links"].to_pylist(), documents["wide"].to_pylist()):
        codes = np.frombuffer(links, "<u4" if wide else "<u2")
        n_best.append(int(best[codes].sum()))
        sums.append(int(counts[codes].sum()))
    out = {c: documents[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    return pa.table(out | {"n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(sums, pa.int64()),
                           "groups_sha256": documents["groups_sha256"]})


def alignment_report(documents: DataFrame, vocabulary: str, model_file: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Numbers of tokens, groups and links of every document, and how its links fare in the whole table."""
    made = cut_lineage(_texts(documents).mapInArrow(_encode(vocabulary, model_file, batch_bytes), _MADE), "aligned")
    pairs = made.filter("pairs is not null").select("batch", "pairs", "counts") \
        .mapInArrow(_pair_rows, "batch long, code long, a long, b long, n long")
    told = pairs.join(pair_counts(pairs), ["a", "b"]).select("batch", "code", "count", "best")
    rows = made.filter("pairs is null").drop("pairs", "counts")
    return rows.groupBy("batch").cogroup(told.groupBy("batch")).applyInArrow(_sum_up, _REPORT)
