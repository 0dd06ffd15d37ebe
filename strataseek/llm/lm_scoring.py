"""Stupid-backoff scores of documents from n-gram counts of the corpus (operator 1).

Every document is scored by the counts of all other documents. With ``c`` the count of an n-gram
less the document's own occurrences, a word after its context scores ``c(context word) / c(context)``
if that n-gram occurs elsewhere, and else ``BACKOFF`` times the score after a context one word
shorter; a single word scores ``c(word) / N``, or ``BACKOFF / N`` if it occurs nowhere else. A document's
score is the sum of the logarithms.

Documents are taken in batches. A batch sends its distinct n-grams of all orders, each with its
count in the batch, to count tables partitioned by hash; a table adds the counts up and answers each
batch with the totals of what it sent; the answers meet the batch's texts, whose n-grams are then
scored in place. So an n-gram travels once per batch, however often it occurs, and no table
holds more than its share of the distinct n-grams. Within a row the sorted 64-bit hashes are stored
as differences; counts and the texts of a batch travel compressed.

Words are maximal runs of bytes other than space and 0x09-0x0D, A-Z as a-z. Texts without words
(null or empty) have score 0. Rows without doc_id are scored and counted like any other; equal rows
are different documents. ``op1_lm_scoring`` uses ``TRIGRAMS``, ``op1_lm_scoring_pairs`` pairs (``ORDER`` 2).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataseek.llm.common import bucket_count, buffers, cut_lineage, gram_hashes, slices, with_bytes, word_hashes

ORDER = 2
TRIGRAMS = 3
BACKOFF = 0.4
BATCH_BYTES = 6 << 20


def pack(keys: np.ndarray) -> bytes:
    """Ascending unsigned integers as the first one and the differences, in as few bytes as they need.

    The bytes of a difference stand apart; the highest ones differ little and are compressed.
    """
    steps = np.diff(keys)
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    planes = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    head = bytes([width]) + int(keys[0]).to_bytes(8, "little") + len(steps).to_bytes(8, "little")
    return head + planes[:-1].tobytes() + (_compressed(planes[-1].tobytes()) if len(steps) else b"")


def unpack(raw: bytes) -> np.ndarray:
    width, n = raw[0], int.from_bytes(raw[9:17], "little")
    keys = np.zeros((n + 1, 8), np.uint8)
    if n:
        low = n * (width - 1)
        keys[1:, :width - 1] = np.frombuffer(raw, np.uint8, low, 17).reshape(width - 1, n).T
        keys[1:, width - 1] = np.frombuffer(pa.decompress(raw[17 + low:], n, "zstd", asbytes=True), np.uint8)
    keys = keys.view("<u8").ravel()
    keys[0] = int.from_bytes(raw[1:9], "little")
    return np.cumsum(keys, dtype=np.uint64)


def _compressed(raw: bytes) -> bytes:
    return pa.compress(raw, "zstd", asbytes=True)


def _small(counts: np.ndarray) -> bytes:
    """Counts in the narrowest of one, two, four or eight bytes; equal bytes of all stand together, compressed."""
    width = next(w for w in (1, 2, 4, 8) if not len(counts) or int(counts.max()) < 1 << (8 * w))
    planes = counts.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return bytes([width]) + len(counts).to_bytes(8, "little") + _compressed(planes.tobytes())


def _counts(raw: bytes) -> np.ndarray:
    width, n = raw[0], int.from_bytes(raw[1:9], "little")
    planes = np.frombuffer(pa.decompress(raw[9:], n * width, "zstd", asbytes=True), np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.int64)


def _frozen(batch: pa.RecordBatch) -> bytes:
    """A batch as a compressed Arrow stream."""
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=5))
    with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _grams(batch: pa.RecordBatch, order: int):
    """Words' rows, and for each n the hash of the n-gram that starts at each word (within its text)."""
    words, rows = word_hashes(*buffers(batch.column("text")))
    grams = []
    for n in range(1, order + 1):
        inside = rows[:len(rows) - n + 1] == rows[n - 1:] if len(rows) >= n else np.zeros(0, bool)
        grams.append((np.flatnonzero(inside), gram_hashes(words, n)[inside]))
    return rows, grams


def _numbered(df: DataFrame, function, schema: str) -> DataFrame:
    """``function(batch, number)`` for batches of bounded size; a batch keeps its number in every run."""
    def run(batches):
        task, number = TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text", BATCH_BYTES):
            yield function(batch, task << 24 | number)
            number += 1

    return df.mapInArrow(run, schema)


def score_documents(documents: DataFrame, order: int = ORDER) -> DataFrame:
    """doc_id, n_words, n_full (words scored at the full order), log_score."""
    texts = with_bytes(documents)
    n_tables = bucket_count(texts)

    def send(batch: pa.RecordBatch, number: int) -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate([g for _, g in _grams(batch, order)[1]]), return_counts=True)
        edges = np.searchsorted(keys, np.array([(t << 64) // n_tables for t in range(n_tables)], np.uint64))
        edges = np.append(edges, len(keys))
        used = [t for t in range(n_tables) if edges[t] < edges[t + 1]]
        return pa.RecordBatch.from_pydict({
            "tab": pa.array(used, pa.int32()), "batch": pa.array(np.full(len(used), number)),
            "keys": pa.array([pack(keys[edges[t]:edges[t + 1]]) for t in used], pa.binary()),
            "counts": pa.array([_small(counts[edges[t]:edges[t + 1]]) for t in used], pa.binary())})

    def add_up(table: pa.Table) -> pa.Table:
        keys = [unpack(x) for x in table.column("keys").to_pylist()]
        counts = np.concatenate([_counts(x) for x in table.column("counts").to_pylist()])
        ends = np.cumsum([0, *map(len, keys)])
        _, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(place.max() + 1, np.int64)
        np.add.at(total, place, counts)
        answer = total[place]
        return pa.table({"batch": table.column("batch"), "tab": table.column("tab"), "totals": pa.array(
            [_small(answer[a:b]) for a, b in zip(ends, ends[1:])], pa.binary())})

    def bring(batch: pa.RecordBatch, number: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"batch": pa.array([number], pa.int64()),
                                           "docs": pa.array([_frozen(batch)], pa.binary())})

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        left = pa.ipc.open_stream(left.column("docs")[0].as_py()).read_all()
        n_rows = len(left)
        rows, grams = _grams(pa.RecordBatch.from_arrays([left.column("text").combine_chunks()], names=["text"]), order)
        keys = np.unique(np.concatenate([g for _, g in grams]))
        answers = sorted(zip(right.column("tab").to_pylist(), right.column("totals").to_pylist()))
        total = np.concatenate([np.zeros(0, np.int64), *[_counts(x) for _, x in answers]])
        elsewhere = []  # for each n: by first word, the count in other documents
        for spot, gram in grams:
            place = np.searchsorted(keys, gram)
            _, where, own = np.unique(rows[spot] * len(keys) + place, return_inverse=True, return_counts=True)
            count = np.zeros(len(rows) + 1, np.int64)
            count[spot] = total[place] - own[where]
            elsewhere.append(count)
        logs, single = np.zeros(len(rows)), np.zeros(len(rows), bool)
        left_over = np.ones(len(rows), bool)
        factor = np.zeros(len(rows))
        full = np.zeros(len(rows), bool)
        begin = np.searchsorted(rows, rows)
        for n in range(order, 1, -1):
            at = np.flatnonzero(left_over & (np.arange(len(rows)) - begin >= n - 1))
            seen = elsewhere[n - 1][at - n + 1]
            hit = at[seen > 0]
            logs[hit] = factor[hit] + np.log(seen[seen > 0]) - np.log(elsewhere[n - 2][hit - n + 1])
            full[hit] = n == order
            left_over[hit] = False
            factor[at[seen == 0]] += np.log(BACKOFF)
        seen = elsewhere[0][:len(rows)][left_over]
        logs[left_over] = factor[left_over] + np.log(np.where(seen > 0, seen, BACKOFF))
        single[left_over] = True
        return pa.table({
            "doc_id": left.column("doc_id"), "n_words": np.bincount(rows, minlength=n_rows).astype(np.int64),
            "n_full": np.bincount(rows, weights=full, minlength=n_rows).astype(np.int64),
            "n_single": np.bincount(rows, weights=single, minlength=n_rows).astype(np.int64),
            "logs": np.bincount(rows, weights=logs, minlength=n_rows)})

    sent = _numbered(texts, send, "tab int, batch long, keys binary, counts binary")
    answers = sent.groupBy("tab").applyInArrow(add_up, "batch long, tab int, totals binary")
    brought = _numbered(texts, bring, "batch long, docs binary")
    made = cut_lineage(brought.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        score, "doc_id long, n_words long, n_full long, n_single long, logs double"), "language-scores")
    total = made.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0]
    others = F.greatest(F.lit(total) - F.col("n_words"), F.lit(1)).cast("double")
    return made.select("doc_id", "n_words", "n_full", (F.col("logs") - F.col("n_single") * F.log(others)).alias("log_score"))


def score_report(documents: DataFrame, order: int = ORDER) -> DataFrame:
    scores = score_documents(documents, order)
    return scores.select("doc_id", "n_words", "n_full", F.round("log_score", 4).alias("log_score"))


#: DuckDB SQL of ``score_report``.
ORACLE = f"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM texts),
pairs AS (SELECT *, lag(word) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM words),
total AS (SELECT count(*) AS n FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
own1 AS (SELECT doc_id, word, count(*) AS c FROM words GROUP BY ALL),
all1 AS (SELECT word, sum(c) AS c FROM own1 GROUP BY word),
rest1 AS (SELECT doc_id, word, all1.c - own1.c AS c FROM own1 JOIN all1 USING (word)),
own2 AS (SELECT doc_id, before, word, count(*) AS c FROM pairs WHERE before IS NOT NULL GROUP BY ALL),
all2 AS (SELECT before, word, sum(c) AS c FROM own2 GROUP BY ALL),
rest2 AS (SELECT doc_id, before, word, all2.c - own2.c AS c FROM own2 JOIN all2 USING (before, word)),
scored AS (
  SELECT p.doc_id, coalesce(r2.c, 0) > 0 AS is_full,
         CASE WHEN coalesce(r2.c, 0) > 0 THEN ln(r2.c) - ln(b.c)
              ELSE CASE WHEN p.before IS NULL THEN 0 ELSE ln({BACKOFF}) END
                   + ln(CASE WHEN r1.c > 0 THEN r1.c ELSE {BACKOFF} END) - ln(greatest(total.n - sizes.n, 1)) END AS s
  FROM pairs p JOIN sizes USING (doc_id) CROSS JOIN total
  JOIN rest1 r1 ON r1.doc_id = p.doc_id AND r1.word = p.word
  LEFT JOIN rest1 b ON b.doc_id = p.doc_id AND b.word = p.before
  LEFT JOIN rest2 r2 ON r2.doc_id = p.doc_id AND r2.before = p.before AND r2.word = p.word)
SELECT texts.doc_id, len(any_value(w))::BIGINT AS n_words, coalesce(count(*) FILTER (WHERE is_full), 0)::BIGINT AS n_full,
       round(coalesce(sum(s), 0), 4) AS log_score
FROM texts LEFT JOIN scored USING (doc_id) GROUP BY texts.doc_id
"""

#: DuckDB SQL of ``score_report`` with ``TRIGRAMS``.
TRIGRAM_ORACLE = f"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS c, generate_subscripts(w, 1) AS i FROM texts),
grams AS (SELECT doc_id, i, c, lag(c) OVER d AS b, lag(c, 2) OVER d AS a
          FROM words WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
total AS (SELECT count(*) AS n FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
own1 AS (SELECT doc_id, c, count(*) AS n FROM grams GROUP BY ALL),
own2 AS (SELECT doc_id, b, c, count(*) AS n FROM grams WHERE b IS NOT NULL GROUP BY ALL),
own3 AS (SELECT doc_id, a, b, c, count(*) AS n FROM grams WHERE a IS NOT NULL GROUP BY ALL),
rest1 AS (SELECT doc_id, c, sum(n) OVER (PARTITION BY c) - n AS n FROM own1),
rest2 AS (SELECT doc_id, b, c, sum(n) OVER (PARTITION BY b, c) - n AS n FROM own2),
rest3 AS (SELECT doc_id, a, b, c, sum(n) OVER (PARTITION BY a, b, c) - n AS n FROM own3),
scored AS (
  SELECT g.doc_id, coalesce(r3.n, 0) > 0 AS is_full,
         CASE WHEN r3.n > 0 THEN ln(r3.n) - ln(c2.n) ELSE
           CASE WHEN g.a IS NULL THEN 0 ELSE ln({BACKOFF}) END
           + CASE WHEN r2.n > 0 THEN ln(r2.n) - ln(c1.n) ELSE
               CASE WHEN g.b IS NULL THEN 0 ELSE ln({BACKOFF}) END
               + ln(CASE WHEN r1.n > 0 THEN r1.n ELSE {BACKOFF} END) - ln(greatest(total.n - sizes.n, 1)) END END AS s
  FROM grams g JOIN sizes USING (doc_id) CROSS JOIN total
  JOIN rest1 r1 ON r1.doc_id = g.doc_id AND r1.c = g.c
  LEFT JOIN rest1 c1 ON c1.doc_id = g.doc_id AND c1.c = g.b
  LEFT JOIN rest2 r2 ON r2.doc_id = g.doc_id AND r2.b = g.b AND r2.c = g.c
  LEFT JOIN rest2 c2 ON c2.doc_id = g.doc_id AND c2.b = g.a AND c2.c = g.b
  LEFT JOIN rest3 r3 ON r3.doc_id = g.doc_id AND r3.a = g.a AND r3.b = g.b AND r3.c = g.c)
SELECT texts.doc_id, len(any_value(w))::BIGINT AS n_words, coalesce(count(*) FILTER (WHERE is_full), 0)::BIGINT AS n_full,
       round(coalesce(sum(s), 0), 4) AS log_score
FROM texts LEFT JOIN scored USING (doc_id) GROUP BY texts.doc_id
"""
