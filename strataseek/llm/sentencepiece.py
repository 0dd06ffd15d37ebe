"""SentencePiece encoding and decoding of whole texts with the tokenizers library (operator 2).

Texts are cut where no piece of the vocabulary spans the cut: two neighbouring bytes that occur
side by side in no piece can never be merged, so the parts are encoded apart with the same result.
Distinct parts of a batch are encoded in one call (one thread unless ``threads`` is given), and each is compared with the
ids of the sentencepiece library (``parity``). Models that do not fit this rule (unigram scores,
a character map, or trimmed spaces) are encoded text by text.

Null texts are null in and null ids out; empty texts have no ids; rows, ties, repeated rows and
columns of any other name pass through untouched, apart from the added columns, whose names the
caller chooses.
"""

from __future__ import annotations

import os
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataseek.llm.common import buffers, numbered, slices, without
from strataseek.llm.sentencepiece_model import BYTE, CONTROL, MARK, MERGES, Model, rebuild
from strataseek.llm.spans import SpanTable, gather, per_row

#: Appended to a model: normalizer_spec { add_dummy_prefix: false }.
_NO_PREFIX = b"\x1a\x02\x18\x00"


class SentencePieceCodec:
    """Encoder and decoder of one worker."""

    def __init__(self, model_file: str, threads: int = 1):
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        import sentencepiece as native

        with open(model_file, "rb") as stream:
            raw = stream.read()
        self.model = Model.parse(raw)
        self.whole = rebuild(self.model)
        self.by_part = (self.model.kind == MERGES and not self.model.charsmap and not self.model.trim_spaces
                        and self.model.escape_spaces)
        self.parts = rebuild(self.model, whole_text=False)
        self.native = native.SentencePieceProcessor(model_proto=raw + (_NO_PREFIX if self.by_part else b""))
        self.pairs = self.model.inner_pairs()
        self.spans = SpanTable(self._fill, np.uint32)
        texts = [bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL
                 else p.replace(MARK, " ").encode() for p, _, kind in self.model.pieces]
        self.piece_size = np.fromiter(map(len, texts), np.int64, len(texts))
        self.piece_at = np.cumsum(self.piece_size) - self.piece_size
        self.piece_bytes = np.frombuffer(b"".join(texts), np.uint8)

    def _fill(self, spans: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each part; a first value of 1 says that both libraries agree."""
        texts = [s.decode() for s in spans]
        marked = [t.replace(" ", MARK) for t in texts] if self.by_part else texts
        encoder = self.parts if self.by_part else self.whole
        ours = [e.ids for e in encoder.encode_batch_fast(marked, add_special_tokens=False)]
        theirs = self.native.encode(texts, num_threads=1)
        rows = [[int(a == b), *a] for a, b in zip(ours, theirs)]
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        return sizes, np.fromiter(chain.from_iterable(rows), np.uint32, int(sizes.sum()))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids in one array, the number of ids of each row, and whether its parts have parity."""
        n_rows = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(n_rows, np.int64), np.ones(n_rows, bool)
        start = np.zeros(len(data) + 1, bool)
        if self.by_part:
            data, offsets = _as_spaces(data, offsets)
            start = np.zeros(len(data) + 1, bool)
            start[1:-1] = ~self.pairs[data[:-1], data[1:]]
        start[offsets] = True
        starts = np.flatnonzero(start[:-1])
        ends = np.append(starts[1:], len(data))
        rows = np.searchsorted(offsets, starts, side="right") - 1
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        marks = first[starts] if self.by_part and self.model.dummy_prefix else None
        at, size = self.spans.look_up(data, starts, ends, marks, b" ")
        parity = np.bincount(rows, weights=self.spans.pool[at] == 0, minlength=n_rows) == 0
        return gather(self.spans.pool, at + 1, size - 1), per_row(rows, size - 1, n_rows), parity

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The text of each row: pieces joined, markers as spaces, byte pieces as bytes, prefix dropped."""
        sizes = self.piece_size[ids]
        raw = gather(self.piece_bytes, self.piece_at[ids], sizes).tobytes()
        rows = np.repeat(np.arange(len(counts)), counts)
        edges = np.r_[0, np.cumsum(np.bincount(rows, weights=sizes, minlength=len(counts)).astype(np.int64))]
        texts = [raw[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
        return [t[1:] if t[:1] == b" " else t for t in texts] if self.model.dummy_prefix else texts


def _as_spaces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The library takes the marker character itself for a space."""
    raw = data.tobytes()
    if MARK.encode() not in raw:
        return data, offsets
    rows = [raw[a:b].replace(MARK.encode(), b" ") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    return buffers(pa.array(rows, pa.binary()))


def encode_decode(documents: DataFrame, model_file: str, text: str = "text", ids: str = "input_ids",
                  keep_ids: bool = True, threads: int = 1) -> DataFrame:
    """The rows of ``documents`` with ``ids`` (array<int>), ``n_tokens``, ``ids_crc32``, ``parity``
    and ``round_trip``: whether decoding gives the text back (markers in it come back as spaces).

    Columns that have one of these names are replaced.
    """
    documents = without(documents, *([ids] if keep_ids else []), "n_tokens", "ids_crc32", "parity", "round_trip")
    added = [T.StructField(ids, T.ArrayType(T.IntegerType()))] if keep_ids else []
    added += [T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()),
              T.StructField("parity", T.BooleanType()), T.StructField("round_trip", T.BooleanType())]
    schema = T.StructType([*documents.schema.fields, *added])
    place = documents.columns.index(text)

    def run(batches):
        codec = SentencePieceCodec(model_file, threads)
        for batch in slices(batches, f"c{place}"):
            column = batch.column(place)
            data, offsets = buffers(column)
            found, counts, parity = codec.encode(data, offsets)
            ends = np.cumsum(counts)
            raw, wide = data.tobytes(), found.astype("<u4")
            back = codec.decode(found, counts)
            trip = [raw[a:b].replace(MARK.encode(), b" ") == t
                    for a, b, t in zip(offsets[:-1].tolist(), offsets[1:].tolist(), back)]
            sums = [zlib.crc32(wide[b - c:b]) for b, c in zip(ends.tolist(), counts.tolist())]
            empty = column.is_null().to_numpy(zero_copy_only=False)
            new = [pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), pa.array(wide.astype(np.int32)),
                                            mask=pa.array(empty))] if keep_ids else []
            new += [pa.array(counts), pa.array(sums, pa.int64()), pa.array(parity), pa.array(trip, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=schema.names)

    return numbered(documents).mapInArrow(run, schema)


def token_report(documents: DataFrame, model_file: str) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, parity, round_trip of every document."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return encode_decode(texts, model_file, keep_ids=False).drop("text")
