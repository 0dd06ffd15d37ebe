"""A search index as a log of segments: small writes, commits, and a log of changes.

Below one folder, each kind of data has a folder of its own, and in it one folder a segment:

* ``rows/segment=S/top=T`` - index rows, sorted by vector cell within the coarse cell T;
* ``blocks``, ``numbers``, ``lexicon`` - postings blocks (:mod:`block_postings`), the key behind
  every row number, and how many rows hold each term (negative for rows that the segment replaced);
* ``dead`` - rows of earlier segments that this one replaced or deleted;
* ``changes`` - their images before and after;
* ``cells`` - the centres of the quantiser;
* ``commits`` - one file a version with the segments in use and the totals.

An upsert or delete writes one segment in proportion to its batch and takes the next version. If another writer was first, what the
batch replaces is looked up again in the newer state. :meth:`SegmentIndex.merge` rewrites
small segments as one. Readers keep the version that they opened. A clone has its own commits and
reads the segments of its origin where they are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataseek.functions.text import iso_text
from strataseek.operators import block_postings
from strataseek.operators.commit_log import CommitLog
from strataseek.operators.dedupe import earliest_per_key
from strataseek.operators.index_table import check_rows, describe_index, row_hash
from strataseek.operators.quantiser import Quantiser, unit
from strataseek.operators.topk import MAX_QUERY_ROWS, in_batches
from strataseek.operators.vector_search import VectorBatch, cell_top_k
from strataseek.session import cut_lineage, together

KEY = "chunk_id"
PLACES = ("segment", "top", "cell")
#: Segments below this share of the largest one are merged when there are more than ``MERGE_FROM``.
MERGE_FROM, MERGE_SHARE = 8, 0.25
ATTEMPTS = 20

_NUMBERS = f"shard int, number int, {KEY} string, top int, cell int"
_DEAD = f"target string, shard int, number int, {KEY} string"
_LEXICON = "term string, df long"


@dataclass(frozen=True)
class Segment:
    id: str
    base: str
    rows: int
    shards: int


class WriteConflict(RuntimeError):
    """Other writers were first in all attempts."""


def _stamped(rows: DataFrame, stamp: Column | None) -> DataFrame:
    return rows.withColumn("updated_at", F.lit(None).cast("string") if stamp is None else iso_text(stamp))


def exists(spark: SparkSession, path: str) -> bool:
    return bool(CommitLog(spark, f"{path}/commits").versions())


def create_index(rows: DataFrame, path: str, cells: Quantiser | np.ndarray) -> SegmentIndex:
    """Write ``rows`` (chunk_id, embedding and any others; ``tokens`` for keyword search) as version 0.

    An index that is already there is opened as it is.
    """
    spark = rows.sparkSession
    if exists(spark, path):
        return open_index(spark, path)
    quantiser = cells if isinstance(cells, Quantiser) else Quantiser.flat(cells)
    quantiser.save(spark, f"{path}/cells")
    index = SegmentIndex(spark, path, {"version": -1, "segments": [], "dead": [], "rows": 0, "tokens": 0,
                                       "words": "tokens" in rows.columns, "cells": f"{path}/cells",
                                       "columns": json.loads(_stamped(rows, None).schema.json())})
    index.__dict__["quantiser"] = quantiser
    segment, totals = index._write_segment(_stamped(rows, None))
    index._claim({"operation": "create", "segments": [segment], "dead": [], "changes": [], **totals})
    return open_index(spark, path)


def open_index(spark: SparkSession, path: str, version: int | None = None) -> SegmentIndex:
    log = CommitLog(spark, f"{path}/commits")
    known = log.versions()
    if not known or version is not None and version not in known:
        raise FileNotFoundError(f"no index at {path}" if not known else f"no version {version} at {path}")
    return SegmentIndex(spark, path, log.read(known[-1] if version is None else version))


@dataclass
class SegmentIndex:
    spark: SparkSession
    path: str
    state: dict

    # -- reading --------------------------------------------------------------------------------

    @property
    def version(self) -> int:
        return self.state["version"]

    @property
    def segments(self) -> list[Segment]:
        return [Segment(**s) for s in self.state["segments"]]

    @cached_property
    def quantiser(self) -> Quantiser:
        return Quantiser.load(self.spark, self.state["cells"])

    @property
    def centroids(self) -> np.ndarray:
        return self.quantiser.centres

    @property
    def settings(self) -> dict:
        return {"dimension": self.centroids.shape[1]}

    @property
    def size(self) -> tuple[int, float]:
        """Rows and their average number of tokens."""
        rows = self.state["rows"]
        return rows, self.state["tokens"] / rows if rows else 0.0

    @property
    def _full(self) -> list[Segment]:
        """Segments that hold rows; others only take counts off."""
        return [s for s in self.segments if s.rows]

    def _schema(self) -> T.StructType:
        return T.StructType.fromJson(self.state["columns"])

    def _read(self, kind: str, schema, where: list[Segment]) -> DataFrame:
        """One kind of data of some segments; ``segment`` says whose it is."""
        schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        whole = T.StructType([*schema.fields, T.StructField("segment", T.StringType())])
        parts = [self.spark.read.schema(whole).option("basePath", f"{base}/{kind}").parquet(
            *(f"{base}/{kind}/segment={s.id}" for s in where if s.base == base)) for base in sorted({s.base for s in where})]
        if not parts:
            return self.spark.createDataFrame([], whole)
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def _dead(self) -> DataFrame | None:
        """Rows of the segments in use that a later one replaced."""
        if not self.state["dead"]:
            return None
        return self._read("dead", _DEAD, [Segment(**s) for s in self.state["dead"]]).drop("segment") \
            .filter(F.col("target").isin([s.id for s in self.segments]))

    def _living(self, rows: DataFrame) -> DataFrame:
        dead = self._dead()
        if dead is None:
            return rows
        gone = dead.select(F.col("target").alias("segment"), KEY)
        return rows.join(gone, ["segment", KEY], "left_anti").select(*rows.columns)

    def _all_rows(self) -> DataFrame:
        places = [T.StructField("cell", T.IntegerType()), T.StructField("top", T.IntegerType())]
        return self._read("rows", T.StructType([*self._schema().fields, *places]), self._full)

    @cached_property
    def rows(self) -> DataFrame:
        """All living rows with their ``cell``."""
        return self._living(self._all_rows()).drop("segment", "top")

    def cells(self, wanted: list[int]) -> DataFrame:
        """Living rows of some cells; other coarse cells are not listed, other cells skipped by their range."""
        tops = sorted({int(self.quantiser.parents[c]) for c in wanted})
        return self._living(self._all_rows().filter(F.col("top").isin(tops) & F.col("cell").isin([int(c) for c in wanted]))) \
            .drop("segment", "top")

    def _shard(self, column: str = "segment") -> Column:
        """Number of a shard over all segments."""
        first, entries = 0, []
        for s in self._full:
            entries += [F.lit(s.id), F.lit(first)]
            first += s.shards
        if not entries:
            return F.col("shard")
        return F.col("shard") + F.element_at(F.create_map(*entries), F.col(column))

    def keyword_top_k(self, queries: DataFrame, k: int, query_id: str = "query_id", query_text: str = "query") -> DataFrame:
        """BM25 from the blocks of the queries' terms: ``query_id, chunk_id, score, rank``."""
        blocks = self._read("blocks", block_postings._SCHEMA, self._full).withColumn("shard", self._shard()).drop("segment")
        numbers = self._read("numbers", _NUMBERS, self._full).withColumn("shard", self._shard()).select("shard", "number", KEY)
        dead = self._dead()
        if dead is not None:
            dead = dead.withColumn("shard", self._shard("target"))
        return block_postings.bm25_blocks(blocks, numbers, queries, self._lexicon(), self.size, k, KEY, query_id, query_text, dead,
                                          sum(s.shards for s in self._full))

    def near_cells(self, vectors: np.ndarray, probes: int) -> np.ndarray:
        """The ``probes`` cells nearest to each vector, by direction if the cells were trained so."""
        if probes >= len(self.centroids):
            return np.broadcast_to(np.arange(len(self.centroids)), (len(vectors), len(self.centroids)))
        wanted = unit(vectors) if len(self.quantiser.coarse) > 1 else vectors
        gaps = (self.centroids ** 2).sum(1)[None, :] - 2 * wanted @ self.centroids.T
        return np.argsort(gaps, axis=1, kind="stable")[:, :probes]

    def vector_top_k(self, queries: DataFrame, k: int, probes: int, metric: str = "cosine", query_id: str = "query_id",
                     query_vector: str = "query_vector") -> DataFrame:
        """Best rows in the ``probes`` cells nearest to each query: ``query_id, chunk_id, score, rank``; other cells are not read."""
        def answer(part: DataFrame) -> DataFrame:
            held = [r for r in part.select(query_id, query_vector).collect() if r[1] is not None]
            vectors = np.array([r[1] for r in held], float).reshape(len(held), -1)
            near = self.near_cells(vectors, probes) if held else np.zeros((0, probes), int)
            whole = held and near.shape[1] == len(self.centroids)
            used = None if whole else np.unique(near).tolist()
            rows = self.rows if whole or len(used) == len(self.centroids) else self.cells(used or [0])
            batch = VectorBatch([r[0] for r in held], part.schema[query_id].dataType, vectors, near)
            return cell_top_k(rows, batch, len(self.centroids), k, metric, KEY)

        return in_batches(queries, query_id, MAX_QUERY_ROWS, answer)

    def _lexicon(self) -> DataFrame:
        return self._read("lexicon", _LEXICON, self.segments)

    def describe(self) -> DataFrame:
        return describe_index(self.rows.drop("cell", "updated_at"))

    # -- writing --------------------------------------------------------------------------------

    def _path(self, kind: str, segment: str) -> str:
        return f"{self.path}/{kind}/segment={segment}"

    def _write_segment(self, rows: DataFrame) -> tuple[dict, dict]:
        """Write rows, numbers, blocks and lexicon of a new segment; returns it and its totals."""
        name = f"s-{uuid.uuid4().hex}"
        placed = self.quantiser.assign(rows.drop(*PLACES))
        placed.hint("rebalance", F.col("top")).sortWithinPartitions("top", "cell", KEY).write.partitionBy("top") \
            .parquet(self._path("rows", name))
        kept = self.spark.read.schema(T.StructType([*rows.drop(*PLACES).schema.fields, T.StructField("cell", T.IntegerType()),
                                                    T.StructField("top", T.IntegerType())])).parquet(self._path("rows", name))
        words = self.state["words"]
        count, tokens = kept.agg(F.count(F.lit(1)), F.sum(F.size("tokens")) if words else F.lit(0)).first()
        shards = block_postings.shard_count(count, self.spark.sparkContext.defaultParallelism)

        def write_numbers():
            block_postings.shard_numbers(kept, shards, KEY, ("top", "cell")).write.parquet(self._path("numbers", name))

        def write_words():
            block_postings.build_blocks(kept, shards, KEY).write.parquet(self._path("blocks", name))
            made = self.spark.read.schema(block_postings._SCHEMA).parquet(self._path("blocks", name))
            block_postings.lexicon_of(made).sortWithinPartitions("term").write.parquet(self._path("lexicon", name))

        together(write_numbers, *([write_words] if words else []))
        return ({"id": name, "base": self.path, "rows": count, "shards": shards},
                {"rows": count, "tokens": int(tokens or 0)})

    def _claim(self, changes: dict) -> bool:
        state = {**self.state, **changes, "version": self.version + 1}
        if not CommitLog(self.spark, f"{self.path}/commits").claim(state["version"], state):
            return False
        self._now(state)
        return True

    def _now(self, state: dict) -> None:
        self.state = state
        self.__dict__.pop("rows", None)

    def refresh(self) -> SegmentIndex:
        """Move on to the newest version."""
        self._now(CommitLog(self.spark, f"{self.path}/commits").latest())
        return self

    def clone(self, path: str) -> SegmentIndex:
        """An index of its own that begins as this version; no data is copied."""
        copy = SegmentIndex(self.spark, path, {**self.state, "version": -1})
        copy.__dict__["quantiser"] = self.quantiser
        if not copy._claim({"operation": "clone", "changes": []}):
            raise FileExistsError(path)
        return copy

    def _found(self, keys: DataFrame) -> DataFrame:
        """Where the living rows of some keys are: target, shard, number, key, top, cell."""
        numbers = self._read("numbers", _NUMBERS, self._full)
        return self._living(numbers.join(keys.select(KEY), KEY, "left_semi").select("segment", "shard", "number", KEY, "top", "cell")) \
            .withColumnRenamed("segment", "target")

    def _replaced(self, found: DataFrame) -> DataFrame:
        """The rows themselves; only their coarse cells are read."""
        tops = sorted(r[0] for r in found.select("top").distinct().collect())
        rows = self._all_rows().filter(F.col("top").isin(tops))
        return rows.join(found.select(F.col("target").alias("segment"), KEY), ["segment", KEY], "left_semi")

    def _commit(self, operation: str, keys: DataFrame, fresh: DataFrame | None, make: Callable[[], tuple[dict, dict]] | None) -> None:
        """Write what the keys replace, and take the next version; again on the newer state if that is gone."""
        image = F.struct(*self._schema().names)
        attempt, found, old = "", None, None

        def look_up():
            nonlocal attempt, found, old
            attempt = f"s-{uuid.uuid4().hex}"
            found = cut_lineage(self._found(keys), "replaced-places")
            old = cut_lineage(self._replaced(found), "replaced-rows")
            before = old.select(KEY, image.alias("before"))
            if fresh is None:
                both = before.withColumn("after", F.lit(None).cast(T.StructType(self._schema().fields)))
            else:
                both = before.join(fresh.select(KEY, image.alias("after")), KEY, "full")
            changes = both.select(KEY, F.when(F.col("before").isNull(), "insert").when(F.col("after").isNull(), "delete")
                                  .otherwise("update").alias("change_type"), "before", "after")
            return together(
                lambda: changes.write.parquet(self._path("changes", attempt)),
                lambda: found.select("target", "shard", "number", KEY).coalesce(1).write.parquet(self._path("dead", attempt)),
                lambda: old.agg(F.count(F.lit(1)), F.sum(F.size("tokens")) if self.state["words"] else F.lit(0)).first())[2]

        (segment, totals), (gone, lost) = together(make or (lambda: (None, {"rows": 0, "tokens": 0})), look_up)
        for _ in range(ATTEMPTS):
            added = [] if segment is None else [segment]
            if self.state["words"] and gone:
                # the counts of the replaced rows are taken off by a segment without rows
                old.select(F.explode(F.array_distinct("tokens")).alias("term")).groupBy("term") \
                    .agg((-F.count(F.lit(1))).alias("df")).write.parquet(self._path("lexicon", attempt))
                added = [*added, {"id": attempt, "base": self.path, "rows": 0, "shards": 0}]
            place = {"id": attempt, "base": self.path, "rows": 0, "shards": 0}
            if self._claim({"operation": operation, "segments": [*self.state["segments"], *added],
                            "dead": [*self.state["dead"], *([place] if gone else [])], "changes": [place],
                            "rows": self.state["rows"] + totals["rows"] - gone,
                            "tokens": self.state["tokens"] + totals["tokens"] - int(lost or 0)}):
                return
            self.refresh()
            gone, lost = look_up()
        raise WriteConflict(f"{ATTEMPTS} attempts at {self.path}")

    def upsert(self, batch: DataFrame, position: str | None = None, stamp: Column | None = None) -> tuple[DataFrame, DataFrame]:
        """Replace or add the valid rows of ``batch``; returns the report and the failed keys.

        One segment of the size of the batch is written. The written rows carry ``stamp`` as ISO
        text in ``updated_at``; of rows with one key the one with the least ``position`` counts.
        """
        checked = cut_lineage(check_rows(batch, self.settings["dimension"]), "upsert-batch")
        valid = checked.filter("valid").drop("valid")
        if position is not None:
            valid = earliest_per_key(valid, KEY, position)
        columns = [c for c in self._schema().names if c != "updated_at"]
        fresh = cut_lineage(_stamped(valid.select(*columns), stamp), "upsert-rows")
        self.quantiser  # loaded before the jobs that share it
        self._commit("upsert", fresh, fresh, lambda: self._write_segment(fresh))
        if sum(1 for s in self.segments if s.rows) > MERGE_FROM:
            self.merge()
        totals = checked.agg(F.count_if("valid").alias("success_row_count"),
                             F.count_if(~F.col("valid")).alias("failed_row_count"))
        status = F.when(F.col("failed_row_count") > 0, "FAILURE").otherwise("SUCCESS")
        return (totals.select(status.alias("status"), "success_row_count", "failed_row_count"),
                checked.filter("not valid").select(KEY))

    def delete(self, keys: DataFrame) -> None:
        """Remove the rows of some keys; unknown and null keys do nothing."""
        self._commit("delete", cut_lineage(keys.select(KEY).dropna().distinct(), "delete-keys"), None, None)

    def merge(self, share: float = MERGE_SHARE) -> bool:
        """Rewrite the segments below ``share`` of the largest as one, without dead rows; false if another
        writer was first (the next write merges then)."""
        segments = self.segments
        largest = max((s.rows for s in segments), default=0)
        small = [s for s in segments if s.rows <= share * largest]
        if len(small) < 2:
            return False
        part = SegmentIndex(self.spark, self.path, {**self.state, "segments": [vars(s) for s in small if s.rows]})
        rows = part._living(part._all_rows()).drop(*PLACES)
        made, _ = self._write_segment(rows)
        if self.state["words"]:
            # term counts of the merged segments, with what they took off from others
            extra = f"s-{uuid.uuid4().hex}"
            whole = self._read("lexicon", _LEXICON, small).groupBy("term").agg(F.sum("df").alias("df"))
            own = self._read("lexicon", _LEXICON, [Segment(**made)]).groupBy("term").agg(F.sum("df").alias("own"))
            whole.join(own, "term", "full").select("term", (F.coalesce("df", F.lit(0)) - F.coalesce("own", F.lit(0))).alias("df")) \
                .filter("df != 0").coalesce(1).write.parquet(self._path("lexicon", extra))
            rest = [{"id": extra, "base": self.path, "rows": 0, "shards": 0}]
        else:
            rest = []
        gone = {s.id for s in small}
        kept = [s for s in self.state["segments"] if s["id"] not in gone]
        return self._claim({"operation": "merge", "segments": [*kept, made, *rest], "changes": []})

    # -- changes --------------------------------------------------------------------------------

    def changes(self, after: int, up_to: int | None = None) -> DataFrame:
        """Images that the commits after version ``after`` wrote: ``version, chunk_id, change_type, before, after``."""
        log = CommitLog(self.spark, f"{self.path}/commits")
        last = self.version if up_to is None else up_to
        image = T.StructType(self._schema().fields)
        schema = T.StructType([T.StructField(KEY, T.StringType()), T.StructField("change_type", T.StringType()),
                               T.StructField("before", image), T.StructField("after", image)])
        places = {s["id"]: (v, Segment(**s)) for v in log.versions() if after < v <= last for s in log.read(v)["changes"]}
        rows = self._read("changes", schema, [s for _, s in places.values()])
        if not places:
            return rows.select(F.lit(0).alias("version"), KEY, "change_type", "before", "after")
        number = F.create_map(*(x for i, (v, _) in places.items() for x in (F.lit(i), F.lit(v))))
        return rows.select(F.element_at(number, F.col("segment")).alias("version"), KEY, "change_type", "before", "after")

    def net_changes(self, after: int, up_to: int | None = None, compare: list[str] | None = None) -> DataFrame:
        """What differs between two versions, from the change log alone: ``chunk_id, change_type`` and hashes."""
        compare = compare or [c for c in self._schema().names if c not in (KEY, "updated_at")]

        def digest(side: str) -> Column:
            return F.when(F.col(side).isNotNull(), row_hash([f"{side}.{c}" for c in compare]))

        hashed = self.changes(after, up_to).select(KEY, "version", digest("before").alias("old"), digest("after").alias("new"))
        ends = hashed.groupBy(KEY).agg(F.min_by(F.struct("old"), "version").alias("first"), F.max_by(F.struct("new"), "version").alias("last")) \
            .select(KEY, F.col("first.old").alias("old_hash"), F.col("last.new").alias("new_hash"))
        change = F.when(F.col("old_hash").isNull(), "insert").when(F.col("new_hash").isNull(), "delete").otherwise("update")
        return ends.filter(~F.col("old_hash").eqNullSafe(F.col("new_hash"))) \
            .select(KEY, change.alias("change_type"), "old_hash", "new_hash")
