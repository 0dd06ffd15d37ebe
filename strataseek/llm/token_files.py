"""Token ids in files of independent zstandard frames (operator 3).

A file holds the ids of a range of documents, in ascending ``doc_id`` order, as little-endian
integers of two or four bytes. It is cut into frames of about ``FRAME_IDS`` ids that are compressed
apart; a longer document takes several frames. After them come two skippable frames: the document
index (doc_id and number of ids of each document) and, last, the seek table of the public
zstandard seekable format (compressed size, size and checksum of each frame). A reader loads the
tail, then only the frames of the documents it is asked for, and checks each against its checksum.

Every task writes one file under a name of its own and then moves it into place, so a task that is
run again replaces its file by an equal one. Rows without doc_id cannot be addressed and are not
written; null and empty texts have only the end id; rows with one doc_id are written one after the
other, ordered by text; an empty table gives no file and no rows.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataseek.llm.byte_bpe import ByteBpe
from strataseek.llm.common import buffers, cut_lineage, slices, splits, with_bytes
from strataseek.session import work_path

FRAME_IDS = 1 << 16
LEVEL = 3
# Fixed values of the public seekable format.
_SKIPPABLE_INDEX, _SKIPPABLE_SEEK, _SEEK_MAGIC, _WITH_CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80

FILE_SCHEMA = "shard int, path string, width int, n_docs long, n_ids long"
DOC_SCHEMA = "shard int, doc_id long, before long, n_tokens long, ids_crc32 long"


class FrameWriter:
    def __init__(self, stream, dtype: np.dtype):
        self.stream, self.dtype = stream, dtype
        self.packer = zstandard.ZstdCompressor(level=LEVEL)
        self.frames: list[tuple[int, int, int]] = []
        self.doc_ids: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.waiting: list[np.ndarray] = []
        self.held = 0

    def add(self, doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_ids)
        self.counts.append(counts)
        edges = np.cumsum(counts)
        low = 0
        while low < len(ids):  # a frame ends with a document, or is full
            reach = low + FRAME_IDS - self.held
            fit = edges[np.searchsorted(edges, reach, side="right") - 1] if edges[0] <= reach else 0
            high = min(int(fit) if fit > low else reach if not self.held else low, len(ids))
            if high > low:
                self.waiting.append(ids[low:high])
                self.held += high - low
            if high < len(ids) or self.held >= FRAME_IDS:
                self._frame()
            low = high

    def _frame(self) -> None:
        raw = np.concatenate(self.waiting).astype(self.dtype).tobytes() if self.waiting else b""
        if raw:
            packed = self.packer.compress(raw)
            self.stream.write(packed)
            self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.waiting, self.held = [], 0

    def close(self) -> tuple[int, int]:
        self._frame()
        doc_ids = np.concatenate([np.zeros(0, np.int64), *self.doc_ids]).astype("<i8")
        counts = np.concatenate([np.zeros(0, np.int64), *self.counts]).astype("<i8")
        index = self.packer.compress(doc_ids.tobytes() + counts.tobytes())
        self.stream.write(struct.pack("<II", _SKIPPABLE_INDEX, len(index) + 16) + index
                          + struct.pack("<QQ", len(doc_ids), len(index)))
        table = b"".join(struct.pack("<III", *frame) for frame in self.frames)
        self.stream.write(struct.pack("<II", _SKIPPABLE_SEEK, len(table) + 9) + table
                          + struct.pack("<IBI", len(self.frames), _WITH_CHECKSUMS, _SEEK_MAGIC))
        return len(doc_ids), int(counts.sum())


class FrameReader:
    """Reads the documents of one file; only the frames that hold them are loaded."""

    def __init__(self, stream, dtype: np.dtype):
        self.stream, self.dtype = stream, dtype
        size = stream.size()
        n, flag, magic = struct.unpack("<IBI", self._bytes(size - 9, 9))
        if magic != _SEEK_MAGIC or flag != _WITH_CHECKSUMS:
            raise ValueError("no seek table at the end of the file")
        seek = size - 17 - 12 * n
        table = np.frombuffer(self._bytes(seek + 8, 12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.sizes, self.checks = table[:, 0], table[:, 2]
        self.at = np.cumsum(self.sizes) - self.sizes
        self.edges = np.cumsum(table[:, 1]) // dtype.itemsize
        n_docs, packed = struct.unpack("<QQ", self._bytes(seek - 16, 16))
        raw = zstandard.ZstdDecompressor().decompress(self._bytes(seek - 16 - packed, packed),
                                                      max_output_size=16 * n_docs)
        self.doc_ids = np.frombuffer(raw[:8 * n_docs], "<i8")
        self.counts = np.frombuffer(raw[8 * n_docs:], "<i8")
        self.before = np.cumsum(self.counts) - self.counts

    def _bytes(self, at: int, size: int) -> bytes:
        self.stream.seek(at)
        return self.stream.read(size)

    def frame(self, k: int) -> np.ndarray:
        raw = zstandard.ZstdDecompressor().decompress(self._bytes(int(self.at[k]), int(self.sizes[k])))
        if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.checks[k]:
            raise ValueError(f"checksum of frame {k} does not match")
        return np.frombuffer(raw, self.dtype)

    def parts(self, places: Iterable[int]) -> Iterator[tuple[int, np.ndarray]]:
        """(place, ids) of the documents at these places of the index; long ones come in several parts."""
        loaded, ids, low = -1, np.zeros(0, self.dtype), 0
        for place in places:
            at, end = int(self.before[place]), int(self.before[place] + self.counts[place])
            while at < end:
                k = int(np.searchsorted(self.edges, at, side="right"))
                if k != loaded:
                    loaded, ids = k, self.frame(k)
                    low = int(self.edges[k]) - len(ids)
                high = min(end, low + len(ids))
                yield place, ids[at - low:high - low]
                at = high

    def document(self, doc_id: int) -> list[np.ndarray]:
        """Ids of every row with this doc_id."""
        places = np.flatnonzero(self.doc_ids == doc_id)
        found = {int(p): [] for p in places}
        for place, part in self.parts(places.tolist()):
            found[place].append(part)
        return [np.concatenate(x) if x else np.zeros(0, self.dtype) for x in found.values()]


def _open(path: str):
    return arrow_fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") \
        else (arrow_fs.LocalFileSystem(), path)


def write_token_files(documents: DataFrame, vocabulary: str, end_id: int = 0,
                      folder: str | None = None) -> DataFrame:
    """Encode every text, append ``end_id`` and write the files; returns one row per file (FILE_SCHEMA).

    The documents are range-partitioned by doc_id, so the files are in order of their number and
    no task holds more than a frame besides its current batch.
    """
    spark = documents.sparkSession
    folder = folder or work_path(spark, "token-files")
    rows = with_bytes(documents).filter(F.col("doc_id").isNotNull())
    ordered = rows.repartitionByRange(max(8, 2 * splits(documents)), "doc_id").sortWithinPartitions("doc_id", "text")

    def write(batches):
        shard = TaskContext.get().partitionId()
        encoder = writer = None
        for batch in slices(batches, "text"):
            if writer is None:
                encoder = ByteBpe(vocabulary)
                store, base = _open(folder)
                store.create_dir(base, recursive=True)
                draft = f"{base}/.{shard}-{uuid.uuid4().hex}"
                stream = store.open_output_stream(draft)
                writer = FrameWriter(stream, encoder.dtype)
            ids, counts = encoder.encode(*buffers(batch.column("text")))
            ends = np.cumsum(counts)
            writer.add(batch.column("doc_id").to_numpy(zero_copy_only=False), counts + 1,
                       np.insert(ids, ends, end_id))
        if writer is not None:
            n_docs, n_ids = writer.close()
            stream.close()
            name = f"shard-{shard:06d}.zst"
            store.move(draft, f"{base}/{name}")
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "path": [f"{folder}/{name}"],
                "width": pa.array([encoder.dtype.itemsize], pa.int32()), "n_docs": [n_docs], "n_ids": [n_ids]})

    return cut_lineage(ordered.mapInArrow(write, FILE_SCHEMA), "token-file-list")


def read_documents(files: DataFrame, doc_ids: list[int] | None = None) -> DataFrame:
    """Every document of the files, or those asked for: position in its file, ids and their crc32."""
    def load(batches):
        for batch in batches:
            for row in batch.to_pylist():
                store, path = _open(row["path"])
                with store.open_input_file(path) as stream:
                    reader = FrameReader(stream, np.dtype(f"<u{row['width']}"))
                    places = np.arange(len(reader.doc_ids)) if doc_ids is None \
                        else np.flatnonzero(np.isin(reader.doc_ids, doc_ids))
                    sums = np.zeros(len(reader.doc_ids), np.int64)
                    for place, part in reader.parts(places.tolist()):
                        sums[place] = zlib.crc32(part.astype("<u4"), int(sums[place]))
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array(np.full(len(places), row["shard"]), pa.int32()),
                    "doc_id": reader.doc_ids[places], "before": reader.before[places],
                    "n_tokens": reader.counts[places], "ids_crc32": sums[places]})

    return files.repartition(max(1, files.count()), "shard").mapInArrow(load, DOC_SCHEMA)


def token_files_report(documents: DataFrame, vocabulary: str, end_id: int = 0) -> DataFrame:
    """Write the files and read them back: doc_id, start, n_tokens, ids_crc32.

    The list of files has one short row per file; its running sum gives the place of each file.
    """
    files = write_token_files(documents, vocabulary, end_id)
    base = files.select("shard", (F.sum("n_ids").over(Window.orderBy("shard")) - F.col("n_ids")).alias("base"))
    read = read_documents(files)
    return read.join(F.broadcast(base), "shard").select(
        "doc_id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def open_reader(spark: SparkSession, path: str, width: int) -> FrameReader:
    store, inside = _open(path)
    return FrameReader(store.open_input_file(inside), np.dtype(f"<u{width}"))
