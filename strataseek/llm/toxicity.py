"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams (operator 7).

Features of a text: its distinct words, their stems (the first four characters, which inflected and
compound words share), word pairs, and pairs with one word between, each hashed to ``2 ** BITS``
places; nothing but the text goes in. Learning rates are kept per coordinate and an L1
term keeps weights at exactly zero until the evidence for them is strong, so the model is a short
list of (place, weight), at most ``8 * 2 ** BITS`` bytes whatever the data, and is broadcast.

Learning uses a bounded sample of the labelled rows: at most about ``MAX_TRAINING_ROWS``, picked by
a hash of doc_id, in the order of that hash, in one task. Scoring reads every whole text.

Null and empty texts have no features; their score is that of the bias alone. Labels that are null
are left out, and a doc_id with several labels is toxic if one of them says so. Without any label
the model is empty and every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataseek.llm.common import buffers, cut_lineage, gram_hashes, mix, numbered, slices, span_hashes, \
    with_bytes, without, word_spans

BITS = 20
STEM = 4
MAX_TRAINING_ROWS = 16_000
EPOCHS = 3
ALPHA, BETA, L2 = 1.0, 1.0, 1.0
#: The L1 term grows with the number of rows learned from, as evidence does.
L1_PER_ROW, LEAST_L1 = 1 / 600, 2.0
THRESHOLD = 0.7
_SKIP = np.uint64(0x2545F4914F6CDD1D)


def _stem_ends(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """End of the first ``STEM`` characters of each word, or of the word."""
    characters = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    after = np.minimum(np.searchsorted(characters, starts) + STEM, len(characters) - 1)
    return np.minimum(ends, characters[after])


def features(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of each feature of each row, with repeats.

    Words and stems take a quarter of the places each, pairs and skip-grams share the upper half.
    """
    starts, ends, rows = word_spans(data, offsets)
    words = span_hashes(data, starts, ends)
    stems = span_hashes(data, starts, _stem_ends(data, starts, ends))
    half, quarter = 1 << (bits - 1), 1 << (bits - 2)
    narrow, wide = np.uint64(66 - bits), np.uint64(65 - bits)
    pairs, same = gram_hashes(words, 2), rows[:-1] == rows[1:]
    skips = mix(words[:-2] * _SKIP + words[2:]) if len(words) > 2 else words[:0]
    skip_same = rows[:-2] == rows[2:]
    return (np.concatenate([rows, rows, rows[1:][same], rows[2:][skip_same]]),
            np.concatenate([(words >> narrow).astype(np.int32), quarter + (stems >> narrow).astype(np.int32),
                            half + (pairs[same] >> wide).astype(np.int32),
                            half + (skips[skip_same] >> wide).astype(np.int32)]))


class Ftrl:
    def __init__(self, bits: int = BITS, l1: float = LEAST_L1):
        self.z = np.zeros((1 << bits) + 1)
        self.n = np.zeros((1 << bits) + 1)  # the last place is the bias, which has no L1 term
        self.penalty = np.full((1 << bits) + 1, l1)
        self.penalty[-1] = 0.0

    def weights(self, at) -> np.ndarray:
        z, penalty = self.z[at], self.penalty[at]
        size = np.maximum(np.abs(z) - penalty, 0.0)
        return -np.sign(z) * size / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2)

    def learn(self, places: np.ndarray, label: int) -> None:
        at = np.append(places, len(self.z) - 1)
        weights = self.weights(at)
        slope = 1.0 / (1.0 + np.exp(-np.clip(weights.sum(), -35, 35))) - label
        old = self.n[at]
        new = old + slope * slope
        self.z[at] += slope - (np.sqrt(new) - np.sqrt(old)) / ALPHA * weights
        self.n[at] = new


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def training_rows(documents: DataFrame, labels: DataFrame, most: int = MAX_TRAINING_ROWS) -> DataFrame:
    """order, label and text of the sample that is learned from."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
             .filter(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("label").alias("label"))
             .withColumn("order", F.xxhash64("doc_id")))
    total = known.count()
    if total > most:  # a share of the hash range; the hash is uniform, so the sample has about ``most`` rows
        known = known.filter(F.col("order") < F.lit(int((most / total - 0.5) * 2.0 ** 64)))
    return with_bytes(documents).filter("doc_id is not null").join(known, "doc_id")


def train(documents: DataFrame, labels: DataFrame, bits: int = BITS) -> DataFrame:
    """The model: (place, weight) of every weight that is not zero."""
    def to_features(batches) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows, places = features(*buffers(batch.column("text")), bits)
            pairs = np.unique(rows.astype(np.int64) << 32 | places)
            ends = np.searchsorted(pairs, np.arange(batch.num_rows + 1, dtype=np.int64) << 32)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(pairs.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("order"), batch.column("label"), lists],
                                             names=["order", "label", "places"])

    def learn(batches) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            column = batch.column("places")
            ends, flat = column.offsets.to_numpy(), column.values.to_numpy()
            held += [(flat[a:b], y) for a, b, y in zip(ends[:-1], ends[1:], batch.column("label").to_pylist())]
        model = Ftrl(bits, max(LEAST_L1, len(held) * L1_PER_ROW))
        for _ in range(EPOCHS):
            for places, label in held:
                model.learn(places, label)
        weights = model.weights(slice(None))
        kept = np.flatnonzero(weights)
        yield pa.RecordBatch.from_pydict({"place": pa.array(kept, pa.int32()), "weight": weights[kept]})

    sample = training_rows(documents, labels).select("order", "label", "text")
    made = sample.mapInArrow(to_features, "order long, label int, places array<int>")
    ordered = made.repartition(1).sortWithinPartitions("order")
    return ordered.mapInArrow(learn, "place int, weight double")


def score(documents: DataFrame, model: DataFrame, text: str = "text", column: str = "score",
          bits: int = BITS) -> DataFrame:
    """The rows with ``column``: the probability that the text is toxic. A column of that name is replaced."""
    documents = without(documents, column)
    rows = model.toArrow()  # at most 2 ** bits rows
    table = np.zeros((1 << bits) + 1, np.float32)
    table[rows.column("place").to_numpy()] = rows.column("weight").to_numpy()
    shared = documents.sparkSession.sparkContext.broadcast(table.tobytes())
    schema = T.StructType([*documents.schema.fields, T.StructField(column, T.DoubleType())])
    place_of = documents.columns.index(text)

    def run(batches):
        weights = np.frombuffer(shared.value, np.float32)
        for batch in slices(batches, f"c{place_of}"):
            rows, places = features(*buffers(batch.column(place_of)), bits)
            useful = weights[places] != 0
            pairs = np.unique(rows[useful].astype(np.int64) << 32 | places[useful])
            total = np.bincount(pairs >> 32, weights=weights[pairs & 0xFFFFFFFF].astype(float),
                                minlength=batch.num_rows) + float(weights[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(1.0 / (1.0 + np.exp(-np.clip(total, -35, 35))))], names=schema.names)

    return numbered(documents).mapInArrow(run, schema)


def toxicity_report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = cut_lineage(train(documents, labels), "toxicity-model")
    return score(with_bytes(documents), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
