"""Removal of byte spans that occur in an earlier document, by sorted windows (operator 9).

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts in a document with a smaller
doc_id. Strings are judged on the input and matches stay within a document.

1. *Equal texts.* Of documents with one text only the first takes part; the others are covered whole.
2. *Anchors.* Among the ``GRAM``-byte strings that start in a window of ``LENGTH`` bytes, the one with the
   smallest hash is the window's anchor (the leftmost of equals). Equal windows have equal anchors, so a
   window can occur twice only if its anchor does. Documents are taken in batches; a batch sends its
   distinct anchors to hash buckets and is told which of them occur in several documents.
3. *Contexts.* Windows with one anchor form a run. For each run with a shared anchor its bytes go to
   the bucket of the anchor; runs of one batch with equal bytes go once, with their first document, and
   the others are settled at once. Anchors that very many batches have are split by window.
4. *Sorted windows.* A bucket sorts the windows of ``LENGTH`` bytes of the distinct contexts of an anchor by their
   bytes. A window is covered if a window of the same bytes has a smaller doc_id. Bytes are compared, not
   hashes. No suffix order beyond ``LENGTH`` bytes and no factor lengths are computed: a factor of
   ``LENGTH`` or more is the union of its windows, and each of these is judged here.
5. Covered ranges are merged per document and cut out.

Anchors in step 2 are compared by 32 bits besides the bucket, in steps 3 and 4 by 64 bits and by their
bytes; collisions only cost work. A bucket's share is bounded, as buckets grow with the input.

Null texts are empty. Rows without doc_id are left out. Rows with one doc_id do not cover each other:
neither id is smaller; each row gives a row. Texts shorter than ``LENGTH`` lose nothing. Only doc_id
and text are read, so other columns cannot clash; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataseek.llm.common import bucket_count, buffers, cut_lineage, mix, runs_by, slices
from strataseek.session import fits_broadcast

LENGTH = 50
GRAM = 20
#: Anchors that more batches than this send are split by window.
HOT_BATCHES = 2000
BATCH_BYTES = 2 << 20
WINDOWS_AT_ONCE = 1 << 16
SEGMENT = 1 << 18

_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
RUN = "bucket int, key long, doc_id long, row int, starts array<long>, size int, bytes binary"
SPAN = "doc_id long, row int, low long, high long"


def rolling_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of the ``length`` bytes that start at each place; strings are put together by doubling."""
    with np.errstate(over="ignore"):
        total, power, have = None, _VALUES[data], 1
        base = np.uint64(0x5851F42D4C957F2D)
        left, at, scale = length, 0, base
        while left:  # total covers ``at`` bytes; power covers ``have`` bytes from each place
            if left & 1:
                count = len(data) - at - have + 1
                if count <= 0:
                    return np.zeros(0, np.uint64)
                total = power[:count] if total is None else total[:count] * scale + power[at:at + count]
                at += have
            left >>= 1
            if left:
                power = power[:-have] * scale + power[have:] if len(power) > have else power[:0]
                scale = scale * scale
                have *= 2
        return mix(total)


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: row, first window, number of windows, hash of the anchor.

    The bytes are taken in segments of fixed size, whatever the length of a text; a run that a
    segment's end cuts comes as two.
    """
    parts = []
    for low in range(0, max(1, len(data)), SEGMENT):
        part = data[low:low + SEGMENT + LENGTH - 1]
        rows, starts, sizes, hashes = _segment_anchors(part, np.clip(offsets - low, 0, len(part)))
        parts.append((rows, starts + low, sizes, hashes))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _segment_anchors(data: np.ndarray, offsets: np.ndarray):
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, np.zeros(0, np.uint64)
    least = rolling_hashes(data, GRAM)
    count = len(data) - LENGTH + 1
    place = np.arange(len(least), dtype=np.int32)
    width, need = 1, LENGTH - GRAM + 1
    while width < need:  # the least of ``width`` neighbours, and where it is
        step = min(width, need - width)
        other = least[step:]
        take = other < least[:len(other)]
        place = np.where(take, place[step:], place[:len(other)])
        least = np.where(take, other, least[:len(other)])
        width += step
    sizes = np.diff(offsets)
    inside = np.zeros(len(data) + 1, np.int8)
    fit = sizes >= LENGTH
    np.add.at(inside, offsets[:-1][fit], 1)
    np.add.at(inside, offsets[1:][fit] - LENGTH + 1, -1)
    valid = np.flatnonzero(np.cumsum(inside[:count], dtype=np.int8) > 0)
    if not len(valid):
        return none, none, none, np.zeros(0, np.uint64)
    place, least = place[valid], least[valid]
    new = np.r_[True, (place[1:] != place[:-1]) | (valid[1:] != valid[:-1] + 1)]
    first = np.flatnonzero(new)
    starts = valid[first]
    return (np.searchsorted(offsets[1:], starts, side="right"), starts,
            np.diff(np.r_[first, len(valid)]), mix(least[first]))  # minima are small: spread them again


def earlier(windows: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Whether an equal window (row of bytes) belongs to a smaller document.

    Windows are sorted by their bytes; in a stretch of equal ones all but the least document have one.
    """
    padded = np.zeros((len(windows), -(-windows.shape[1] // 8) * 8), np.uint8)
    padded[:, :windows.shape[1]] = windows
    columns = padded.view(">u8").astype(np.uint64)
    order = np.lexsort(columns.T[::-1])
    ordered = columns[order]
    begins = np.flatnonzero(np.r_[True, (ordered[1:] != ordered[:-1]).any(axis=1)])
    least = np.minimum.reduceat(docs[order], begins)
    out = np.empty(len(windows), bool)
    out[order] = docs[order] > np.repeat(least, np.diff(np.r_[begins, len(windows)]))
    return out


def _find_spans(table: pa.Table) -> pa.Table:
    """Covered ranges among the runs of one bucket; runs without bytes are settled already."""
    table = table.combine_chunks()
    key = table.column("key").to_numpy()
    docs, rows = table.column("doc_id").to_numpy(), table.column("row").to_numpy()
    size = table.column("size").to_numpy().astype(np.int64)
    lists = table.column("starts").combine_chunks()
    places, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
    column = table.column("bytes").combine_chunks()
    settled = column.is_null().to_numpy(zero_copy_only=False)
    data, offsets = buffers(column)
    out = []

    def cover(runs: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """Bytes ``low`` to ``high`` of these runs, at every place where they stand."""
        times = ends[runs + 1] - ends[runs]
        start = places[np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(ends[runs], times)]
        out.append((np.repeat(docs[runs], times), np.repeat(rows[runs], times),
                    start + np.repeat(low, times), start + np.repeat(high, times)))

    known = np.flatnonzero(settled)
    cover(known, np.zeros(len(known), np.int64), size[known] + LENGTH - 1)
    # runs with one key, key by key; keys with a single run have no partner
    live = np.flatnonzero(~settled)
    live = live[np.argsort(key[live], kind="stable")]
    begins, counts = runs_by(key[live])
    several = np.repeat(counts > 1, counts)
    live, group = live[several], np.repeat(np.arange(len(begins)), counts)[several]
    edges = np.cumsum(size[live])
    low = 0
    while low < len(live):  # whole keys, about WINDOWS_AT_ONCE windows at a time
        high = np.searchsorted(edges, (edges[low - 1] if low else 0) + WINDOWS_AT_ONCE, side="right")
        high = max(low + 1, high)
        high = np.searchsorted(group, group[high - 1], side="right")
        some = live[low:high]
        low = high
        n = size[some]
        spot = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = np.repeat(offsets[some], n) + spot
        windows = np.lib.stride_tricks.sliding_window_view(data, LENGTH)[at]
        hit = earlier(windows, np.repeat(docs[some], n))
        if not hit.any():
            continue
        run = np.repeat(np.arange(len(some)), n)
        where = np.flatnonzero(hit)
        first = np.r_[True, (where[1:] != where[:-1] + 1) | (run[where[1:]] != run[where[:-1]])]
        last = np.r_[first[1:], True]
        a, b = where[first], where[last]
        cover(some[run[a]], spot[a], spot[b] + LENGTH)
    parts = [np.concatenate(x) for x in zip(*out)]
    return pa.table({"doc_id": parts[0], "row": pa.array(parts[1], pa.int32()), "low": parts[2].astype(np.int64),
                     "high": parts[3].astype(np.int64)})


def _numbered(df: DataFrame, function, schema: str) -> DataFrame:
    """``function(batch, number)`` for batches of bounded size; a batch keeps its number in every run."""
    def run(batches):
        task, number = TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text", BATCH_BYTES):
            yield function(batch, task << 24 | number)
            number += 1

    return df.mapInArrow(run, schema)


def _batch_anchors(batch: pa.RecordBatch, n_buckets: int):
    """The runs of a batch, its distinct anchors by bucket, and how many documents have each."""
    data, offsets = buffers(batch.column("text"))
    rows, starts, sizes, hashes = anchors(data, offsets)
    unique, place = np.unique(hashes, return_inverse=True)
    pairs = np.unique(place * np.int64(batch.num_rows) + rows)
    docs = np.bincount(pairs // batch.num_rows, minlength=len(unique)) if len(pairs) else np.zeros(0, np.int64)
    bucket = ((unique >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)
    return data, offsets, (rows, starts, sizes, place), unique, bucket.astype(np.int64), docs


def covered_spans(texts: DataFrame) -> DataFrame:
    """Covered ranges (SPAN, not merged) of the documents (doc_id, row, text)."""
    n_buckets = bucket_count(texts)

    def send(batch: pa.RecordBatch, number: int) -> pa.RecordBatch:
        *_, unique, bucket, docs = _batch_anchors(batch, n_buckets)
        used, ends = np.unique(bucket, return_index=True)
        ends = np.append(ends, len(unique))  # hashes ascend, and so do their buckets
        short = unique.astype(np.uint32)
        several = docs > 1
        return pa.RecordBatch.from_pydict({
            "bucket": pa.array(used, pa.int32()), "batch": pa.array(np.full(len(used), number)),
            "keys": pa.array([short[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary()),
            "several": pa.array([np.packbits(several[a:b]).tobytes() for a, b in zip(ends, ends[1:])], pa.binary())})

    def compare(table: pa.Table) -> pa.Table:
        """For each anchor sent: 0 if only one document has it, 1 if several have, 2 if very many batches have."""
        keys = [np.frombuffer(x, np.uint32) for x in table.column("keys").to_pylist()]
        flags = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(k))
                 for x, k in zip(table.column("several").to_pylist(), keys)]
        flat = np.concatenate(keys)
        order = np.argsort(flat)
        begins, sizes = runs_by(flat[order])
        many = np.maximum.reduceat(np.concatenate(flags)[order], begins) > 0
        answer = np.empty(len(flat), np.uint8)
        answer[order] = np.repeat(np.where(sizes > HOT_BATCHES, 2, (sizes > 1) | many).astype(np.uint8), sizes)
        ends = np.cumsum([0, *map(len, keys)])
        return pa.table({"batch": table.column("batch"), "bucket": table.column("bucket"), "answer": pa.array(
            [answer[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary())})

    def bring(batch: pa.RecordBatch, number: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(batch.num_rows, number)), *batch.columns],
                                          names=["batch", "doc_id", "row", "text"])

    def contexts(left: pa.Table, right: pa.Table) -> pa.Table:
        batch = left.combine_chunks().to_batches()[0].select(["doc_id", "row", "text"])
        data, offsets, (rows, starts, sizes, place), unique, _, _ = _batch_anchors(batch, n_buckets)
        answers = sorted(zip(right.column("bucket").to_pylist(), right.column("answer").to_pylist()))
        verdict = np.frombuffer(b"".join(a for _, a in answers), np.uint8)[place]
        keys = unique[place]
        hot = verdict == 2
        kept, n_kept = np.flatnonzero(verdict == 1), sizes[verdict == 1]
        key, row, start = keys[kept], rows[kept], starts[kept]
        size = n_kept
        if hot.any():  # every window for itself, under a hash of its own bytes
            n = sizes[hot]
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[hot], n)
            key = np.concatenate([key, rolling_hashes(data, LENGTH)[at]])
            row = np.concatenate([row, np.repeat(rows[hot], n)])
            start, size = np.concatenate([start, at]), np.concatenate([size, np.ones(len(at), np.int64)])
        doc_ids, marks = batch.column("doc_id").to_numpy(), batch.column("row").to_numpy()
        raw = data.tobytes()
        ends = start + size + LENGTH - 1
        pieces = [raw[a:b] for a, b in zip(start.tolist(), ends.tolist())]
        docs = doc_ids[row]
        least: dict[tuple[int, bytes], int] = {}
        for k, piece, doc in zip(key.tolist(), pieces, docs.tolist()):
            least[k, piece] = min(doc, least.get((k, piece), doc))
        held: dict[tuple[int, bytes, int], list[int]] = {}  # the run that stands for its repeats in a document
        stands, settled = [], np.zeros(len(key), bool)
        places = (start - offsets[row]).tolist()
        for i, (k, piece, doc, r) in enumerate(zip(key.tolist(), pieces, docs.tolist(), row.tolist())):
            if least[k, piece] < doc:  # covered by the first document of the batch that has it
                settled[i] = True
                stands.append(i)
                held[i, b"", r] = [places[i]]
            elif (k, piece, r) in held:
                held[k, piece, r].append(places[i])
            else:
                stands.append(i)
                held[k, piece, r] = [places[i]]
        stands = np.array(stands, np.int64)
        key, row, size, docs, settled = key[stands], row[stands], size[stands], docs[stands], settled[stands]
        bucket = ((key >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)
        bucket = np.where(settled, docs % n_buckets, bucket.astype(np.int64))
        return pa.table({
            "bucket": pa.array(bucket, pa.int32()), "key": key.view(np.int64), "doc_id": docs,
            "row": pa.array(marks[row], pa.int32()), "starts": pa.array(list(held.values()), pa.list_(pa.int64())),
            "size": pa.array(size, pa.int32()),
            "bytes": pa.array([None if x else pieces[i] for i, x in zip(stands, settled)], pa.binary())})

    sent = _numbered(texts, send, "bucket int, batch long, keys binary, several binary")
    answers = sent.groupBy("bucket").applyInArrow(compare, "batch long, bucket int, answer binary")
    brought = _numbered(texts, bring, "batch long, doc_id long, row int, text binary")
    runs = brought.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(contexts, RUN)
    return runs.groupBy("bucket").applyInArrow(_find_spans, SPAN)


def _documents(documents: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.filter("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.hash(text).alias("row"),
        text.cast("binary").alias("text"))


def repeated_spans(documents: DataFrame) -> DataFrame:
    """doc_id, row (a hash of the text, for rows that share a doc_id) and spans, the merged covered ranges."""
    texts = _documents(documents)
    prints = texts.select("doc_id", "row", F.length("text").alias("n"), F.unhex(F.md5("text")).alias("print")) \
        .filter(F.col("n") >= LENGTH)
    first = prints.groupBy("print").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("k")).filter("k > 1")
    copies = cut_lineage(prints.join(first, "print").filter("doc_id > first")
                         .select("doc_id", "row", "n").distinct(), "equal-texts")
    without = F.broadcast(copies) if fits_broadcast(copies, F.lit(40)) else copies
    rest = texts.join(without.select("doc_id", "row"), ["doc_id", "row"], "left_anti")
    spans = covered_spans(rest).unionByName(copies.select("doc_id", "row", F.lit(0).cast("long").alias("low"),
                                                          F.col("n").cast("long").alias("high")))
    ranges = spans.groupBy("doc_id", "row").agg(F.collect_list(F.struct("low", "high")).alias("ranges"))

    def merge(batches):
        for batch in batches:
            lists = batch.column("ranges")
            ends, values = lists.offsets.to_numpy(), lists.values
            low, high = values.field("low").to_numpy(), values.field("high").to_numpy()
            merged = []
            for a, b in zip(ends[:-1], ends[1:]):
                order = np.argsort(low[a:b], kind="stable")
                x, y = low[a:b][order], np.maximum.accumulate(high[a:b][order])
                new = np.r_[True, x[1:] > y[:-1]]
                last = np.r_[new[1:], True]
                merged.append(np.stack([x[new], y[last]], axis=1).ravel())
            flat = np.concatenate([np.zeros(0, np.int64), *merged])
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("row"), pa.ListArray.from_arrays(
                    pa.array(np.cumsum([0, *map(len, merged)]), pa.int32()), pa.array(flat))],
                names=["doc_id", "row", "spans"])

    return cut_lineage(ranges.mapInArrow(merge, "doc_id long, row int, spans array<long>"), "repeated-spans")


def remove_spans(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the bytes that are left) of every document."""
    spans = repeated_spans(documents)
    if fits_broadcast(spans, F.size("spans") * 8 + 40):
        spans = F.broadcast(spans)

    def cut(batches):
        for batch in slices(batches, "text", BATCH_BYTES):
            kept, removed, runs = [], [], []
            for text, ranges in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                edges = [0, *(ranges or []), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
                removed.append(len(text) - len(kept[-1]))
                runs.append(len(ranges or []) // 2)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pc.binary_length(batch.column("text")).cast(pa.int64()),
                pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    joined = _documents(documents).join(spans, ["doc_id", "row"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def span_report(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return remove_spans(documents).select("doc_id", "n_bytes", "n_removed", "n_spans",
                                          F.sha2("kept", 256).alias("kept_sha256"))
