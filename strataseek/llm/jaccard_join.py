"""Exact Jaccard join of documents on word shingles with a token-group matrix (operator 8).

Two documents link when the sets of their five-word shingles have a Jaccard similarity of at least
``PERCENT`` / 100. The steps, each of which can only drop what cannot link:

1. *Shared tokens.* Shingles are hashed into buckets, in proportion to the input. A bucket tells
   which of its tokens occur in more than one document. A document needs ``PERCENT`` of its tokens
   to be shared; in most corpora few documents have that. Each bucket gets a token once per batch of
   documents, however many of them hold it.
2. *Classes.* Equal sets become one class; its smallest doc_id stands for it from here on, or a negative
   number from its fingerprint when that doc_id has several texts and stands for another of them.
3. *Prefix.* A document's tokens are ordered by how many classes hold them; linked documents share
   one of their ``n - ceil(n * PERCENT / 100) + 1`` rarest.
4. *Stars.* Documents with one min-hash are compared with the most central of them, for two hash
   functions; found links give first components, so that a large group of near copies is joined with as
   many comparisons as it has members.
5. *Matrix.* Documents are partitioned into groups of similar ones: large components, and else by
   min-hash, split to at most ``GROUP_DOCS`` documents and ``GROUP_TOKENS`` tokens. The matrix
   (token, group) over prefix tokens gives each document the groups to ask. A group whose
   members all belong to the document's own component is not asked.
6. *Bound, then open.* A task holds one group's token union and a portion of the documents that ask
   it. A document with fewer than ``PERCENT`` of its tokens in the union cannot link in the group;
   otherwise the group is opened and the overlap with each member is counted. Links are
   returned as a spanning forest, so the output has at most one row per document and group.

Token comparisons use 64-bit hashes; step 1 uses 32 bits of them besides the bucket, and a collision
there only lets a document through to the next step.

Null and empty texts have an empty set and link with nothing. Rows without doc_id are left out.
Rows that repeat a doc_id give one row each; if their texts differ, each of its sets has its own links and
joins what they link. Empty tables give empty results. Only doc_id and
text are read, so other columns cannot clash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataseek.llm.common import (bucket_count, buffers, cut_lineage, free_name, runs_by, shingle_sets, slices,
                                   with_bytes, word_hashes)
from strataseek.llm.components import components
from strataseek.operators.skew import balanced_join
from strataseek.session import fits_broadcast

SHINGLE = 5
PERCENT = 75
CHUNK_BYTES = 2 << 20
GROUP_DOCS = 512
GROUP_TOKENS = 1 << 20
PORTION = 2048
LARGE_COMPONENT = 64


# -- 1. shared tokens -----------------------------------------------------------------------------

def _sets(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = buffers(batch.column("text"))
    words, rows = word_hashes(data, offsets)
    return shingle_sets(words, rows, batch.num_rows, SHINGLE)


def shared_counts(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, n_shared (upper bound of the shingles that another document has too)."""
    n_buckets = bucket_count(documents)

    def deal(batches):
        task, chunk = TaskContext.get().partitionId(), 0
        for batch in slices(batches, "text", CHUNK_BYTES):
            rows, tokens = _sets(batch)
            unique, first, count = np.unique(tokens, return_index=True, return_counts=True)
            alone = count == 1
            size = np.bincount(rows, minlength=batch.num_rows)
            here = size - np.bincount(rows[first[alone]], minlength=batch.num_rows)  # shared within the batch
            owner = np.where(alone, rows[first], -1)
            bucket = ((unique >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)
            order = np.lexsort((owner, bucket))
            short = unique[order].astype(np.uint32)
            owner, bucket = owner[order].astype(np.int32), bucket[order].astype(np.int64)
            ends = np.searchsorted(bucket, np.arange(n_buckets + 1))
            out = {"bucket": [], "tokens": [], "rows": [], "counts": []}
            for b in range(n_buckets):
                low, high = ends[b], ends[b + 1]
                if low < high:
                    begins, sizes = runs_by(owner[low:high])
                    out["bucket"].append(b)
                    out["tokens"].append(short[low:high].tobytes())
                    out["rows"].append(owner[low:high][begins].tobytes())
                    out["counts"].append(sizes.astype(np.int32).tobytes())
            n = len(out["bucket"])
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array([*out["bucket"], (task + chunk) % n_buckets], pa.int32()),
                "chunk": pa.array(np.full(n + 1, task << 24 | chunk)),
                "tokens": pa.array([*out["tokens"], None], pa.binary()),
                "rows": pa.array([*out["rows"], batch.column("doc_id").to_numpy().tobytes()], pa.binary()),
                "counts": pa.array([*out["counts"], np.stack([size, here]).astype(np.int32).tobytes()], pa.binary())})
            chunk += 1

    def compare(table: pa.Table) -> pa.Table:
        """The rows of a chunk come back with the number of shared tokens; the line with doc_ids passes."""
        table = table.combine_chunks()
        with_tokens = table.column("tokens").is_valid()
        passing, table = table.filter(pc.invert(with_tokens)), table.filter(with_tokens)
        out = [passing.select(["chunk", "rows", "counts"]).append_column("shared", pa.nulls(len(passing), pa.binary()))]
        if len(table):
            rows = [np.frombuffer(x, np.int32) for x in table.column("rows").to_pylist()]
            counts = [np.frombuffer(x, np.int32) for x in table.column("counts").to_pylist()]
            flat = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("tokens").to_pylist()])
            order = np.argsort(flat)
            begins, sizes = runs_by(flat[order])
            shared = np.empty(len(flat), bool)
            shared[order] = np.repeat(sizes > 1, sizes)
            lengths = np.concatenate(counts)
            sums = np.add.reduceat(shared, np.cumsum(lengths) - lengths, dtype=np.int32)
            edges = np.cumsum([0, *map(len, rows)])
            # tokens that a batch announces for all its documents (row -1) are counted there already
            out.append(pa.table({
                "chunk": table.column("chunk"),
                "rows": pa.array([r[r >= 0].tobytes() for r in rows], pa.binary()),
                "counts": pa.nulls(len(table), pa.binary()),
                "shared": pa.array([sums[a:b][r >= 0].tobytes() for a, b, r in zip(edges, edges[1:], rows)],
                                   pa.binary())}))
        return pa.concat_tables(out)

    def gather(table: pa.Table) -> pa.Table:
        total = ids = None
        later = []
        for row in table.to_pylist():
            if row["shared"] is None:
                ids = np.frombuffer(row["rows"], np.int64)
                total = np.frombuffer(row["counts"], np.int32).reshape(2, -1).copy()
            else:
                later.append((np.frombuffer(row["rows"], np.int32), np.frombuffer(row["shared"], np.int32)))
        for rows, shared in later:
            total[1][rows] += shared
        return pa.table({"doc_id": ids, "n_shingles": total[0].astype(np.int64), "n_shared": total[1].astype(np.int64)})

    dealt = documents.mapInArrow(deal, "bucket int, chunk long, tokens binary, rows binary, counts binary")
    told = dealt.groupBy("bucket").applyInArrow(compare, "chunk long, rows binary, counts binary, shared binary")
    return told.groupBy("chunk").applyInArrow(gather, "doc_id long, n_shingles long, n_shared long")


# -- 2. classes and 3. prefixes ---------------------------------------------------------------------

def _with_sets(documents: DataFrame) -> DataFrame:
    """doc_id, n, fingerprint and tokens (sorted) of the documents."""
    def run(batches):
        for batch in slices(batches, "text", CHUNK_BYTES):
            rows, tokens = _sets(batch)
            ends = np.searchsorted(rows, np.arange(batch.num_rows + 1))
            prints = [xxhash.xxh3_128_digest(tokens[a:b].tobytes()) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(np.diff(ends).astype(np.int64)), pa.array(prints, pa.binary()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tokens.astype(np.int64)))],
                names=["doc_id", "n", "print", "tokens"])

    return documents.mapInArrow(run, "doc_id long, n long, print binary, tokens array<long>")


def _needed(n: Column) -> Column:
    return F.ceil(n * PERCENT / F.lit(100.0))


def _prefixes(sets: DataFrame) -> DataFrame:
    """doc_id, n, t (prefix tokens that another class has), seeds (min-hashes), centre."""
    tokens = sets.select("doc_id", "n", F.explode("tokens").alias("t"))
    shared = tokens.groupBy("t").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    held = tokens.join(shared, "t").groupBy("doc_id", "n").agg(
        F.array_sort(F.collect_list(F.struct("df", "t"))).alias("held"),
        *[F.min(F.xxhash64("t", F.lit(h))).alias(f"m{i}") for i, h in enumerate((3, 17))],
        (F.sum(F.log("df")) / F.col("n")).alias("centre"))
    # tokens that nothing else has come first in the order and cannot be shared
    length = F.size("held") - _needed(F.col("n")) + 1
    return held.filter(length > 0).select("doc_id", "n", "m0", "m1", "centre", F.transform(
        F.slice("held", F.lit(1), length.cast("int")), lambda x: x["t"]).alias("prefix"))


# -- 6. bound and open ------------------------------------------------------------------------------

def _find_links(table: pa.Table) -> pa.Table:
    """Links between the askers and the members of one group, as a spanning forest."""
    table = table.combine_chunks()
    member = np.array(table.column("member").to_pylist(), bool)
    ids, size = table.column("doc_id").to_numpy(), table.column("n").to_numpy()
    lists = table.column("tokens").combine_chunks()
    flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
    spots = np.flatnonzero(member)
    none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    if not len(spots) or member.all():
        return none
    tokens = np.concatenate([flat[ends[i]:ends[i + 1]] for i in spots])
    owner = np.repeat(np.arange(len(spots)), size[spots])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    union, first = np.unique(tokens, return_index=True)
    last = np.append(first[1:], len(tokens))
    number = {int(d): k for k, d in enumerate(ids[spots])}
    root = np.arange(len(spots))
    found_a, found_b = [], []
    for i in np.flatnonzero(~member):
        mine, n = flat[ends[i]:ends[i + 1]], size[i]
        at = np.minimum(np.searchsorted(union, mine), len(union) - 1)
        at = at[union[at] == mine]
        if 100 * len(at) < PERCENT * n:
            continue  # the union lacks too many of its tokens
        lengths = last[at] - first[at]
        spread = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(first[at], lengths)
        both = np.bincount(owner[spread], minlength=len(spots))
        linked = np.flatnonzero(100 * both >= PERCENT * (n + size[spots] - both))
        linked = linked[ids[spots[linked]] != ids[i]]
        if not len(linked):
            continue
        roots, where = np.unique(root[linked], return_index=True)
        own = number.get(int(ids[i]))
        for r, k in zip(roots, linked[where]):
            if own is None or root[own] != r:
                found_a.append(int(ids[i]))
                found_b.append(int(ids[spots[k]]))
        target = roots[0] if own is None else root[own]
        root[np.isin(root, roots)] = target
    return pa.table({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})


def _verify(asks: DataFrame, members: DataFrame, sets: DataFrame, name: str) -> DataFrame:
    """Links between (doc_id, grp) and the members (grp, doc_id) of the groups asked.

    A group with many askers is answered by several tasks, each with all its members.
    """
    parts = asks.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / PORTION).cast("int").alias("parts"))
    columns = ["doc_id", "n", "tokens"]
    asking = (asks.join(parts, "grp").withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
              .select("grp", "part", "doc_id").join(sets.select(*columns), "doc_id")
              .select("grp", "part", F.lit(False).alias("member"), *columns))
    held = (members.join(parts, "grp").join(sets.select(*columns), "doc_id")
            .select("grp", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                    F.lit(True).alias("member"), *columns))
    links = asking.unionByName(held).groupBy("grp", "part").applyInArrow(_find_links, "a long, b long")
    return cut_lineage(links, name)


# -- 4. stars and 5. matrix -------------------------------------------------------------------------

def _star_links(docs: DataFrame, sets: DataFrame) -> DataFrame:
    seeds = docs.select("doc_id", "centre", F.explode(F.array("m0", "m1")).alias("seed"))
    heads = seeds.groupBy("seed").agg(F.max(F.struct("centre", -F.col("doc_id"))).alias("head"),
                                      F.count(F.lit(1)).alias("k")).filter("k > 1") \
        .select("seed", (-F.col("head").getField("col2")).alias("grp"))
    asks = seeds.join(heads, "seed").filter("doc_id != grp").select("doc_id", "grp").distinct()
    return _verify(asks, heads.select("grp", F.col("grp").alias("doc_id")).distinct(), sets, "star-links")


def _groups(docs: DataFrame) -> DataFrame:
    """doc_id, comp, grp: large components and documents of one min-hash, split to a bounded size."""
    sizes = docs.groupBy("comp").agg(F.count(F.lit(1)).alias("members"))
    keyed = docs.join(sizes, "comp").withColumn(
        "key", F.when(F.col("members") >= LARGE_COMPONENT, F.xxhash64("comp", F.lit(5))).otherwise(F.col("m0")))
    parts = keyed.groupBy("key").agg(F.greatest(F.ceil(F.count(F.lit(1)) / GROUP_DOCS),
                                                F.ceil(F.sum("n") / GROUP_TOKENS)).cast("int").alias("parts"))
    spread = F.pmod(F.xxhash64(F.when(F.col("members") >= LARGE_COMPONENT, F.col("doc_id")).otherwise(F.col("comp")),
                               F.lit(9)), F.col("parts"))
    return keyed.join(parts, "key").select("doc_id", "comp", "prefix", F.xxhash64("key", spread).alias("grp"))


def _matrix_links(docs: DataFrame, sets: DataFrame) -> DataFrame:
    grouped = cut_lineage(_groups(docs), "token-groups")
    # a group of one component needs no answer for that component's documents
    single = grouped.groupBy("grp").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    cells = grouped.join(single, "grp").select(
        "doc_id", "comp", "grp", "low", "high", F.explode("prefix").alias("t"))
    spread = cells.groupBy("t").agg(F.min("comp").alias("a"), F.max("comp").alias("z")).filter("a != z").select("t")
    cells = cut_lineage(cells.join(spread, "t"), "prefix-cells")
    matrix = cells.select("t", F.col("grp").alias("to"), "low", "high").distinct()
    pairs = balanced_join(cells.select("t", "doc_id", "comp", "grp"), matrix, ["t"], ["doc_id"], F.lit(40)) \
        .filter((F.col("grp") <= F.col("to")) & ~((F.col("low") == F.col("comp")) & (F.col("high") == F.col("comp"))))
    asks = cut_lineage(pairs.select("doc_id", F.col("to").alias("grp")).distinct(), "group-asks")
    return _verify(asks, grouped.select("grp", "doc_id"), sets, "matrix-links")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) of every document."""
    texts = with_bytes(documents).filter("doc_id is not null")
    counted = cut_lineage(shared_counts(texts), "shared-counts")
    likely = counted.filter(f"n_shingles > 0 and 100 * n_shared >= {PERCENT} * n_shingles").select("doc_id").distinct()
    likely = F.broadcast(likely) if fits_broadcast(likely, F.lit(24)) else likely
    sets = cut_lineage(_with_sets(texts.join(likely, "doc_id", "left_semi")).filter("n > 0"), "shingle-sets")
    prints = sets.groupBy("print").agg(F.min("doc_id").alias("first"))
    owners = prints.groupBy("first").agg(F.min("print").alias("own"))
    prints = cut_lineage(prints.join(owners, "first").select("print", "first", F.when(
        F.col("print") == F.col("own"), F.col("first")).otherwise(
        -1 - F.shiftrightunsigned(F.xxhash64("print"), 1)).alias("class")), "set-prints")
    classes = cut_lineage(balanced_join(sets.select("doc_id", "print"), prints.select("print", "class"), ["print"],
                                        ["doc_id"], F.lit(40)).select("doc_id", "class").distinct(), "set-classes")
    rep_sets = cut_lineage(sets.join(prints.withColumnRenamed("first", "doc_id"), ["print", "doc_id"])
                           .dropDuplicates(["print"]).select(F.col("class").alias("doc_id"), "n", "tokens"), "class-sets")
    docs = cut_lineage(_prefixes(rep_sets), "set-prefixes")
    stars = _star_links(docs, rep_sets)
    first = components(stars, "star-components")
    docs = docs.join(first, docs["doc_id"] == first["v"], "left").withColumn(
        "comp", F.coalesce("label", "doc_id")).drop("v", "label")
    # the texts of one doc_id belong together
    own = classes.groupBy("doc_id").agg(F.min("class").alias("a"), F.max("class").alias("z")).filter("a != z")
    own = own.join(classes, "doc_id").select("a", F.col("class").alias("b"))
    last = components(stars.unionAll(_matrix_links(docs, rep_sets)).unionAll(own), "link-components")
    labelled = classes.join(last, classes["class"] == last["v"], "left").select(
        "doc_id", F.coalesce("label", "class").alias("label")).distinct()
    smallest = labelled.groupBy("label").agg(F.min("doc_id").alias("component"))
    named = balanced_join(labelled, smallest, ["label"], ["doc_id"], F.lit(24)).select("doc_id", "component")
    return counted.select("doc_id", "n_shingles").join(named, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def keep_first(documents: DataFrame) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest doc_id.

    Rows without doc_id stay.
    """
    found = near_duplicates(documents.select("doc_id", "text"))
    key = free_name(documents, "__later")
    later = found.filter("component_id != doc_id").select(F.col("doc_id").alias(key)).distinct()
    return documents.join(later, F.col("doc_id").cast("long") == F.col(key), "left_anti")
