"""Benchmark decontamination with a BM25 index of the test items and block-max WAND (operator 4).

The test items are the indexed collection and every passage of every training document is a query.
A passage is a window of ``2 * stride`` words, one starting at every ``stride`` words; the stride is
1.25 times the longest item (32 words at least), so an occurrence up to that long lies whole in one.

An item is reported when a passage holds at least ``COVERAGE`` of its distinct five-word shingles
(an item with fewer words is one shingle). Such a passage lacks only so many of the item's words,
which gives each item a lowest BM25 score: its own, less its largest weights for the words that may
be missing. Retrieval returns every item at or above that score, so it loses nothing that the check
of the shingles would accept. Weights are stored divided by that score, so the threshold is 1.

The search skips as WAND does: first by the sum of each term's largest weight over all items, then
by the sum of its largest weights within blocks of similar items; only blocks that can reach the
threshold are scored. All passages of a batch go through these steps together.

The index is broadcast. It is bounded: items are indexed in portions of at most
``PORTION_BYTES`` of text, and each portion is a pass of its own over the documents.

The question is the item's text up to its last line break, the answer the rest. Texts and items
that are null or without words match nothing; rows without doc_id take no part; equal rows give
equal results once per doc_id and item; items with an equal id are told apart by their text and the
best is reported; without items or documents the result is empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataseek.llm.common import (buffers, free_name, gram_hashes, runs_by, shingle_sets, slices, with_bytes,
                                   word_hashes)

SHINGLE = 5
COVERAGE = 0.75
K1, B = 1.2, 0.75
BLOCK_ITEMS = 4
PORTION_BYTES = 1 << 19
SLICE = 1 << 20
SCHEMA = ("doc_id long, item_id long, n_shared long, n_shingles long, bm25 double, "
          "question_overlap double, answer_overlap double")


class ItemIndex:
    """Postings, block maxima and shingles of one portion of the items; plain arrays."""

    def __init__(self, item_ids: list[int], texts: list[str], stride: int):
        self.stride = stride
        parts = [_question_answer(t) for t in texts]
        words, rows = word_hashes(*buffers(pa.array(texts, pa.string())))
        length = np.bincount(rows, minlength=len(texts))
        self.terms, codes = np.unique(words, return_inverse=True)
        pair, tf = np.unique(rows * len(self.terms) + codes, return_counts=True)
        item, term = np.divmod(pair, max(1, len(self.terms)))
        df = np.bincount(term, minlength=len(self.terms))
        idf = np.log(1 + (len(texts) - df + 0.5) / (df + 0.5))
        size = 1 - B + B * length / max(1.0, length.mean())
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * size[item])
        item_rows, shingles = shingle_sets(words, rows, len(texts), SHINGLE)
        n_shingles = np.bincount(item_rows, minlength=len(texts))
        lowest = np.array([_lowest(weight[item == i], length[i], n_shingles[i]) for i in range(len(texts))])

        # similar items side by side: by the common terms they hold
        common = np.argsort(-df, kind="stable")[:24]
        held = np.zeros((len(texts), len(self.terms) + 1), bool)
        held[item, term] = True
        order = np.lexsort(held[:, common[::-1]].T) if len(common) else np.arange(len(texts))
        place = np.empty(len(texts), np.int64)
        place[order] = np.arange(len(texts))
        self.item_ids = np.array(item_ids, np.int64)[order]
        self.n_shingles = n_shingles[order]
        self.lowest = lowest[order]
        n_blocks = -(-len(texts) // BLOCK_ITEMS)
        block, slot = np.divmod(place[item], BLOCK_ITEMS)
        self.block_max = np.zeros((len(self.terms), n_blocks), np.float32)
        np.maximum.at(self.block_max, (term, block), weight / lowest[item])
        self.term_max = self.block_max.max(axis=1, initial=0)
        self.blocks = []  # of each block: its terms, and a row of weights for each
        for i in range(n_blocks):
            here = block == i
            terms, line = np.unique(term[here], return_inverse=True)
            weights = np.zeros((len(terms) + 1, BLOCK_ITEMS))  # line 0: terms that the block lacks
            weights[line + 1, slot[here]] = (weight / lowest[item])[here]
            self.blocks.append((terms, weights))
        key = np.lexsort((place[item_rows], shingles))
        self.shingles, self.shingle_item = shingles[key], place[item_rows][key]
        self.shingle_sizes = sorted(set(np.minimum(length[length > 0], SHINGLE).tolist()))
        self.parts = [_part_sets([parts[i][j] for i in order]) for j in (0, 1)]


def _question_answer(text: str) -> tuple[str, str]:
    head, _, tail = text.strip().rpartition("\n")
    return (head, tail) if head else (tail, "")


def _part_sets(texts: list[str]) -> list[np.ndarray]:
    words, rows = word_hashes(*buffers(pa.array(texts, pa.string())))
    return [np.unique(words[rows == i]) for i in range(len(texts))]


def _lowest(weights: np.ndarray, n_words: int, n_shingles: int) -> float:
    """Least score of a passage that holds ``COVERAGE`` of the shingles.

    A missing word takes with it the shingle that starts with it; only the words that occur just
    among the last four start none.
    """
    missing = int(n_shingles - np.ceil(COVERAGE * n_shingles)) + SHINGLE - 1 if n_words >= SHINGLE else 0
    rest = np.sort(weights)[:max(0, len(weights) - missing)].sum()
    return max(float(rest) * (1 - 1e-5), 1e-6)  # the stored weights are rounded


def _windows(rows: np.ndarray, stride: int) -> tuple[np.ndarray, np.ndarray]:
    """First word of every passage and the word after its last; passages do not cross rows."""
    begins, sizes = runs_by(rows)
    counts = np.maximum(1, -(-sizes // stride) - 1)
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    first = np.repeat(begins, counts) + nth * stride
    return first, np.minimum(first + 2 * stride, np.repeat(begins + sizes, counts))


def _ranges(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers ``begin .. begin + size - 1`` of every pair, one after the other."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(begins, sizes)


def candidates(index: ItemIndex, words: np.ndarray, first: np.ndarray,
               last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(passage, item, score) of everything at or above the threshold."""
    at = np.minimum(np.searchsorted(index.terms, words), len(index.terms) - 1)
    known = np.flatnonzero(index.terms[at] == words)
    low, high = np.searchsorted(known, first), np.searchsorted(known, last)
    size = high - low
    passage = np.repeat(np.arange(len(first)), size)
    keys = np.unique(passage * len(index.terms) + at[known[_ranges(low, size)]])
    passage, term = np.divmod(keys, len(index.terms))
    begins, sizes = runs_by(passage)
    none = np.zeros(0, np.int64)
    if not len(begins):
        return none, none, np.zeros(0)
    strong = np.add.reduceat(index.term_max[term], begins) >= 1
    keep = np.repeat(strong, sizes)
    passage, term = passage[keep], term[keep]
    begins, sizes = runs_by(passage)
    if not len(begins):
        return none, none, np.zeros(0)
    reached = []
    for low in range(0, len(begins), 512):  # bounded memory: a few hundred passages at a time
        starts = begins[low:low + 512]
        end = starts[-1] + sizes[low:low + 512][-1]
        bound = np.add.reduceat(index.block_max[term[starts[0]:end]], starts - starts[0], axis=0)
        block, nth = np.nonzero(bound.T >= 1)
        reached.append((block, nth + low))
    blocks, nths = (np.concatenate(x) for x in zip(*reached))
    out = []
    line = np.zeros(len(index.terms), np.int64)
    for block in np.unique(blocks):
        nth = nths[blocks == block]
        terms, weights = index.blocks[block]
        line[terms] = np.arange(1, len(terms) + 1)
        for low in range(0, len(nth), 4096):
            some = nth[low:low + 4096]
            spots = _ranges(begins[some], sizes[some])
            starts = np.cumsum(sizes[some]) - sizes[some]
            score = np.add.reduceat(weights[line[term[spots]]], starts, axis=0)
            p, slot = np.nonzero(score >= 1)
            out.append((passage[begins[some[p]]], block * BLOCK_ITEMS + slot, score[p, slot]))
        line[terms] = 0
    if not out:
        return none, none, np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*out))


def _matches(index: ItemIndex, doc_ids: np.ndarray, data: np.ndarray, offsets: np.ndarray):
    words, rows = word_hashes(data, offsets)
    if not len(words) or not len(index.terms):
        return
    first, last = _windows(rows, index.stride)
    passage, item, score = candidates(index, words, first, last)
    best: dict[tuple[int, int], tuple] = {}
    for p, i, s in zip(passage.tolist(), item.tolist(), score.tolist()):
        inside = words[first[p]:last[p]]
        grams = np.unique(np.concatenate([gram_hashes(inside, n) for n in index.shingle_sizes]))
        low, high = np.searchsorted(index.shingles, grams), np.searchsorted(index.shingles, grams, side="right")
        shared = sum(int((index.shingle_item[a:b] == i).any()) for a, b in zip(low[high > low], high[high > low]))
        if shared and shared >= COVERAGE * index.n_shingles[i]:
            key = (int(doc_ids[rows[first[p]]]), int(index.item_ids[i]))
            overlaps = [float(np.isin(part[i], inside).mean()) if len(part[i]) else 1.0 for part in index.parts]
            found = (shared, int(index.n_shingles[i]), s * float(index.lowest[i]), *overlaps)
            best[key] = max(best.get(key, found), found)
    for (doc, item_id), found in best.items():
        yield (doc, item_id, *found)


def contaminated(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Every (document, item) with the item in a passage of the document (SCHEMA)."""
    spark = documents.sparkSession
    listed = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")) \
        .filter("item_id is not null and text is not null").distinct()
    sizes = listed.agg(F.sum(F.octet_length("text")).alias("bytes"), F.max(
        F.size(F.split(F.col("text"), r"[\x20\x09-\x0D]+"))).alias("longest")).first()
    if not sizes["bytes"]:
        return spark.createDataFrame([], SCHEMA)
    portions = -(-sizes["bytes"] // PORTION_BYTES)
    texts = with_bytes(documents).filter("doc_id is not null")
    found = None
    for portion in range(portions):
        rows = listed.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(portions)) == portion) \
            .orderBy("item_id", "text").toArrow().to_pydict()
        index = spark.sparkContext.broadcast(
            ItemIndex(rows["item_id"], rows["text"], max(32, -(-5 * sizes["longest"] // 4))))

        def run(batches, index=index):
            for batch in slices(batches, "text", SLICE):
                hits = list(_matches(index.value, batch.column("doc_id").to_numpy(), *buffers(batch.column("text"))))
                if hits:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in zip(*hits)], names=[f.split()[0] for f in SCHEMA.split(", ")])

        part = texts.mapInArrow(run, SCHEMA)
        found = part if found is None else found.unionByName(part)
    best = F.max(F.struct("n_shared", "n_shingles", "bm25", "question_overlap", "answer_overlap")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.*")


def decontaminate(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no test item; rows without doc_id stay."""
    key = free_name(documents, "__hit")
    hit = contaminated(documents, items).select(F.col("doc_id").alias(key)).distinct()
    return documents.join(hit, F.col("doc_id").cast("long") == F.col(key), "left_anti")


#: DuckDB SQL for doc_id, item_id, n_shared and n_shingles: every shingle of every passage, by brute force.
ORACLE = f"""
WITH items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\\x20\\x09-\\x0D]+') AS w FROM benchmark WHERE text IS NOT NULL),
wide AS (SELECT greatest(32, ceil(1.25 * max(len(w)))::BIGINT) AS stride FROM items),
item_grams AS (
  SELECT DISTINCT item_id, len(g) AS size, array_to_string(g, ' ') AS gram FROM (
    SELECT item_id, unnest(list_transform(range(1, greatest(1, len(w) - {SHINGLE} + 1) + 1),
                                          lambda p: w[p:p + {SHINGLE} - 1])) AS g FROM items WHERE len(w) > 0)),
item_sizes AS (SELECT item_id, count(*) AS n_shingles FROM item_grams GROUP BY item_id),
sizes AS (SELECT DISTINCT size FROM item_grams),
words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents WHERE doc_id IS NOT NULL),
spots AS (SELECT doc_id, w, size, unnest(range(0, len(w) - size + 1)) AS p FROM words, sizes),
grams AS (SELECT doc_id, len(w) AS n, p, size, array_to_string(w[p + 1:p + size], ' ') AS gram FROM spots),
hits AS (SELECT item_id, doc_id, n, p, size, gram FROM grams JOIN item_grams USING (size, gram)),
placed AS (
  SELECT item_id, doc_id, gram, unnest([p // stride - 1, p // stride]) AS passage, n, p, size, stride FROM hits, wide),
counted AS (
  SELECT doc_id, item_id, passage, count(DISTINCT gram) AS n_shared FROM placed
  WHERE passage BETWEEN 0 AND greatest(1, ceil(n / stride)::BIGINT - 1) - 1
    AND p + size <= (passage + 2) * stride
  GROUP BY doc_id, item_id, passage)
SELECT doc_id, item_id, max(n_shared)::BIGINT AS n_shared, any_value(n_shingles)::BIGINT AS n_shingles
FROM counted JOIN item_sizes USING (item_id)
WHERE n_shared >= {COVERAGE} * n_shingles GROUP BY doc_id, item_id
"""
