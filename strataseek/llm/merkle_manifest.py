"""A Merkle manifest of a table of documents (operator 11): postorder append log and proofs from it.

One binary tree per ``lang`` has the documents in ascending doc_id as leaves; a node without a
partner is hashed alone, so all leaves of a tree have one depth. The roots of these trees, in
ascending ``lang``, are the leaves of a last tree. H is the hex text of SHA-256.

Leaves get their number from a range partition (no global window). Aligned builders, each for
``2 ** bits`` neighbouring nodes of one tree, write nodes in the order in which they are complete,
and the nodes at their tops are the input of the next round. The position of a node in the postorder
log follows from the sizes of the subtrees before it: if ``e`` leaves stand up to its last one, the
log holds ``2 * (e - 1) - popcount(e - 1)`` nodes before that leaf, and a node of level k is k places
behind it. Proofs are taken from the log by such positions: a block of neighbouring leaves reads its
own stretch and one path from its top to the root.

Null values are hashed as ``-``; a null doc_id comes first, a null lang is a tree of its own before
the others. Rows that share a doc_id are ordered by their leaf; equal rows are separate leaves. An
empty table gives no row and an empty log. Only doc_id, source, lang, n_chars and text are read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataseek.llm.common import bucket_count, cut_lineage
from strataseek.session import work_path

BITS = 10
#: The tree of the roots.
TOP = -1
NO_SIBLING, LEFT, RIGHT = 0, 1, 2

_IS_ROOT = "node = 0 AND n <= (1L << level) AND (level = 0 OR n > (1L << (level - 1)))"
_LOG = "tree long, level int, node long, n long, position long, digest binary"
_PATH = "tree long, level int, node long, n long, subroot binary, root binary, siblings binary, sides binary"


def _piece(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """H (binary) of one document."""
    return F.unhex(F.sha2(F.concat(*map(_piece, (doc_id, source, lang, n_chars, text))), 256))


def number_rows(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with their place in the whole order (``place``, from 0) and the range they lie in (``part``).

    The ranges are written once. Equal rows may fall in different ranges, so no key makes one large.
    The number of rows of each range, one number a range, passes through the driver.
    """
    spark = rows.sparkSession
    parts = bucket_count(rows, per_split=1, least=spark.sparkContext.defaultParallelism)
    sorted_rows = rows.withColumn("__tie", F.monotonically_increasing_id()) \
        .repartitionByRange(parts, *order, "__tie").sortWithinPartitions(*order, "__tie").drop("__tie") \
        .withColumn("__at", F.monotonically_increasing_id())
    kept = cut_lineage(sorted_rows, name).withColumn("part", F.shiftright("__at", 33))
    sizes = sorted((r["part"], r["count"]) for r in kept.groupBy("part").count().toLocalIterator())
    before = np.cumsum([0, *(n for _, n in sizes)]).tolist()
    starts = spark.createDataFrame([(p, b) for (p, _), b in zip(sizes, before)], "part long, __start long")
    return kept.join(starts, "part").withColumn("place", F.expr("__start + (__at & ((1L << 33) - 1))")) \
        .drop("__at", "__start")


def position(level, node, n, bits=np.bitwise_count):
    """Place in the postorder log of a tree of ``n`` leaves (numpy arrays or numbers)."""
    last = np.minimum((np.asarray(node, np.int64) + 1) << np.asarray(level, np.int64), n) - 1
    return 2 * last - bits(last).astype(np.int64) + level


def depth(n: int) -> int:
    return int(n - 1).bit_length()


def _node(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(p.hex().encode() for p in parts)).digest()


def completed(digests: list[bytes], first: int, base: int, top: int, last: bool):
    """(level, node, digest) in the order of completion above consecutive nodes of level ``base``.

    ``first`` is the number of the first of them, ``last`` says that no node of that level follows.
    """
    waiting: list[bytes] = []
    level, node, digest = base, first, b""
    for node, digest in enumerate(digests, first):
        level = base
        yield level, node, digest
        while node & 1 and level < top:
            level, node, digest = level + 1, node >> 1, _node(waiting.pop(), digest)
            yield level, node, digest
        waiting.append(digest)
    if last:
        waiting.pop()
        while level < top:
            digest = _node(waiting.pop(), digest) if node & 1 else _node(digest)
            level, node = level + 1, node >> 1
            yield level, node, digest


def _builder(base: int, bits: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        tree, n = table["tree"][0].as_py(), table["n"][0].as_py()
        first, rows = table["node"][0].as_py(), table.num_rows
        there = -(-n >> base)
        made = list(completed(table["digest"].to_pylist(), first, base, min(base + bits, depth(n)),
                              first + rows == there))
        level = np.array([m[0] for m in made], np.int64)
        node = np.array([m[1] for m in made], np.int64)
        out = pa.table([pa.array(np.full(len(made), tree)), pa.array(level.astype(np.int32)), pa.array(node),
                        pa.array(np.full(len(made), n)), pa.array(position(level, node, n)),
                        pa.array([m[2] for m in made], pa.binary())],
                       names=["tree", "level", "node", "n", "position", "digest"])
        return out.filter(pa.array(level > base)) if base else out  # the round before wrote these already
    return run


@dataclass
class Manifest:
    """``log``: the nodes of all trees (tree, level, node, n, position, digest), tree ``TOP`` over the roots;
    ``trees``: (tree, lang, n); ``leaves``: the numbered documents; ``most``: leaves of the largest tree."""

    log: DataFrame
    trees: DataFrame
    leaves: DataFrame
    path: str
    most: int
    bits: int


def _append(leaves: DataFrame, path: str, most: int, bits: int) -> DataFrame:
    """Write the log of the trees whose leaves are (tree, node, n, digest); one folder a round."""
    spark = leaves.sparkSession
    base, rows = 0, leaves.select("tree", "node", "n", "digest")
    while True:
        target = f"{path}/round={base // bits}"
        rows.groupBy("tree", F.shiftright("node", bits).alias("block")).applyInArrow(_builder(base, bits), _LOG) \
            .write.mode("overwrite").parquet(target)
        base += bits
        if base >= depth(most):
            break
        rows = spark.read.schema(_LOG).parquet(target).filter((F.col("level") == base) & (F.col("n") > 1 << base)) \
            .select("tree", "node", "n", "digest")
    return spark.read.schema(_LOG).parquet(*(f"{path}/round={k}" for k in range(base // bits)))


def build(documents: DataFrame, bits: int = BITS, path: str | None = None, carry: dict[str, Column] | None = None) -> Manifest:
    """The log of ``documents`` below ``path`` (default: a new one in the shared folder).

    ``carry``: more columns of the leaves, by name, from columns of ``documents``.
    """
    spark = documents.sparkSession
    path = path or work_path(spark, "manifest")
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    leaves = cut_lineage(documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        leaf_digest(*columns).alias("digest"), *(c.alias(name) for name, c in (carry or {}).items())), "leaves")
    placed = number_rows(leaves, ["lang", "doc_id", "digest"], "numbered")
    langs = placed.groupBy("lang").agg(F.min("place").alias("start"), F.count(F.lit(1)).alias("n"))
    trees = cut_lineage(number_rows(langs, ["lang"], "langs").withColumnRenamed("place", "tree").drop("part"), "trees")
    # A range of one lang is one row here, so the numbered leaves meet it on a key of bounded size.
    runs = placed.groupBy("part", "lang").agg(F.lit(None).alias("none")).drop("none").alias("r") \
        .join(trees.alias("t"), F.col("r.lang").eqNullSafe(F.col("t.lang"))) \
        .select("r.part", F.col("r.lang").alias("run_lang"), "tree", "start", "n")
    numbered = placed.join(runs, (placed["part"] == runs["part"]) & placed["lang"].eqNullSafe(runs["run_lang"])) \
        .withColumn("node", F.col("place") - F.col("start"))
    numbered = numbered.select("tree", "node", "n", "digest", "doc_id", *(carry or {}))
    count, most = trees.agg(F.count(F.lit(1)), F.max("n")).first()
    below = _append(numbered, f"{path}/trees", most or 1, bits)
    above = _append(below.filter(_IS_ROOT).select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("node"),
                                 F.lit(count).cast("long").alias("n"), "digest"), f"{path}/top", count or 1, bits)
    return Manifest(below.unionByName(above), trees.select("tree", "lang", "n"), numbered, path, most or 1, bits)


def sibling_positions(node: Column, n: Column) -> Column:
    """array<struct<level, node, position, is_left>>: where the log of a tree of ``n`` leaves holds the siblings of a leaf."""
    levels = F.filter(F.sequence(F.lit(0), F.lit(61)), lambda k: F.call_function("shiftright", n - 1, k) > 0)
    pairs = F.transform(levels, lambda k: F.struct(
        k.alias("level"), F.call_function("shiftright", node, k).bitwiseXOR(F.lit(1).cast("long")).alias("node")))
    there = F.filter(pairs, lambda p: F.call_function("shiftleft", p["node"], p["level"]) < n)

    def place(p):
        last = F.least(F.call_function("shiftleft", p["node"] + 1, p["level"]), n) - 1
        return F.struct(p["level"].alias("level"), p["node"].alias("node"),
                        (2 * last - F.bit_count(last) + p["level"]).alias("position"),
                        (p["node"] % 2 == 0).alias("is_left"))

    return F.transform(there, place)


def siblings_of(manifest: Manifest, wanted: DataFrame) -> DataFrame:
    """(tree, node, level, is_left, digest): the siblings of chosen leaves (tree, node) within their trees.

    For a few leaves: one row a level, looked up by position.
    """
    sizes = manifest.log.filter("level = 0").select("tree", "node", "n")
    rows = wanted.select("tree", "node").join(sizes, ["tree", "node"]) \
        .select("tree", "node", F.explode(sibling_positions(F.col("node"), F.col("n"))).alias("s")) \
        .select("tree", "node", "s.level", "s.is_left", "s.position")
    return rows.join(manifest.log.select("tree", "position", "digest"), ["tree", "position"]).drop("position")


def _steps(nodes: pa.Table, asked: np.ndarray, n: int, base: int, top: int):
    """Siblings of the ``asked`` nodes of level ``base`` up to below ``top``: places in ``nodes`` and sides, by level."""
    positions = nodes["position"].to_numpy()
    places, sides = [], []
    for level in range(base, top):
        own = asked >> (level - base)
        sibling = own ^ 1
        there = sibling << level < n
        places.append(np.where(there, np.searchsorted(positions, position(level, sibling, n)), -1))
        sides.append(np.where(there, np.where(own & 1, LEFT, RIGHT), NO_SIBLING))
    shape = (0, len(asked))
    return (np.array(places) if places else np.zeros(shape, np.int64),
            np.array(sides, np.uint8) if sides else np.zeros(shape, np.uint8))


def _split(table: pa.Table):
    """The nodes of a block in the order of the log, and the path from its top."""
    is_path = pc.is_valid(table["siblings"])
    return table.filter(pc.invert(is_path)).sort_by("position"), table.filter(is_path)


def _paths(base: int, bits: int):
    """Paths of the nodes of level ``base`` of one block."""
    def run(table: pa.Table) -> pa.Table:
        nodes, path = _split(table)
        tree, n = path["tree"][0].as_py(), path["n"][0].as_py()
        bottom = nodes.filter(pc.equal(nodes["level"], base)) if nodes.num_rows else nodes
        asked = bottom["node"].to_numpy()
        places, sides = _steps(nodes, asked, n, base, min(base + bits, depth(n)))
        digests = nodes["digest"].to_pylist()
        rest, rest_sides = path["siblings"][0].as_py(), path["sides"][0].as_py()
        siblings = [b"".join([digests[p] for p in column if p >= 0]) + rest for column in places.T.tolist()]
        size = len(asked)
        return pa.table([pa.array(np.full(size, tree)), pa.array(np.full(size, base, np.int32)), pa.array(asked),
                         pa.array(np.full(size, n)), pa.array([path["subroot"][0].as_py()] * size, pa.binary()),
                         pa.array([path["root"][0].as_py()] * size, pa.binary()),
                         pa.array(siblings, pa.binary()),
                         pa.array([s.tobytes() + rest_sides for s in np.ascontiguousarray(sides.T)], pa.binary())],
                        names=["tree", "level", "node", "n", "subroot", "root", "siblings", "sides"])
    return run


def fold(digest: bytes, siblings: list[bytes], sides: bytes) -> bytes:
    """The root that a leaf and its proof give."""
    at = 0
    for side in sides:
        if side == NO_SIBLING:
            digest = _node(digest)
        else:
            digest = _node(siblings[at], digest) if side == LEFT else _node(digest, siblings[at])
            at += 1
    return digest


_PROOF = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
          "verified boolean, n_siblings int")


def _prove(bits: int, changed: str | None):
    def run(leaves: pa.Table, table: pa.Table) -> pa.Table:
        nodes, path = _split(table)
        leaves = leaves.sort_by("node")
        n = path["n"][0].as_py()
        places, sides = _steps(nodes, leaves["node"].to_numpy(), n, 0, min(bits, depth(n)))
        digests = nodes["digest"].to_pylist()
        rest = path["siblings"][0].as_py()
        above = [rest[k:k + 32] for k in range(0, len(rest), 32)]
        above_sides = path["sides"][0].as_py()
        subroot, root = path["subroot"][0].as_py(), path["root"][0].as_py()
        own = leaves["digest"].to_pylist()
        told = leaves[changed].to_pylist() if changed else [None] * len(own)
        proofs, folded, counts = [], [], []
        for digest, other, column, side in zip(own, told, places.T.tolist(), np.ascontiguousarray(sides.T)):
            siblings = [digests[p] for p in column if p >= 0] + above
            proofs.append(_node(*siblings).hex())
            folded.append(fold(digest if other is None else other, siblings, side.tobytes() + above_sides))
            counts.append(len(siblings))
        size = len(own)
        return pa.table([leaves["doc_id"].combine_chunks(), pa.array([d.hex() for d in own], pa.string()),
                         pa.array([subroot.hex()] * size, pa.string()), pa.array([root.hex()] * size, pa.string()),
                         pa.array(proofs, pa.string()), pa.array([f.hex() for f in folded], pa.string()),
                         pa.array([f == root for f in folded], pa.bool_()), pa.array(counts, pa.int32())],
                        names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified",
                               "n_siblings"])
    return run


def _blocks(log: DataFrame, paths: DataFrame, base: int, bits: int) -> DataFrame:
    """Nodes of the levels from ``base`` to below the top of a block, and the path of each top."""
    top = base + bits
    nodes = log.filter((F.col("level") >= base) & (F.col("level") < top)) \
        .filter(F.col("n") > (1 << base if base else 0)) \
        .withColumn("block", F.expr(f"node >> ({top} - level)"))
    above = paths.withColumn("block", F.col("node"))
    return nodes.unionByName(above, allowMissingColumns=True)


def _spread_paths(log: DataFrame, roots: DataFrame, most: int, bits: int, down_to: int) -> DataFrame:
    """Paths of the tops of the blocks of round ``down_to`` from those of the roots (level: that of the root)."""
    paths = None
    for turn in range(max(0, -(-depth(most) // bits) - 1), down_to - 1, -1):
        base = turn * bits
        # The root of a tree is the top of its only block of the round that made it.
        here = roots.filter((F.col("n") <= F.lit(1 << (base + bits))) & ((F.col("n") > 1 << base) | F.lit(turn == 0)))
        paths = here if paths is None else here.unionByName(paths)
        if turn == down_to:
            return paths
        paths = _blocks(log, paths, base, bits).groupBy("tree", "block").applyInArrow(_paths(base, bits), _PATH)
    return paths


def proofs(manifest: Manifest, changed: str | None = None) -> DataFrame:
    """Proof of every document, and the root recomputed from it (from the leaf ``changed`` where that is not null)."""
    bits, log = manifest.bits, manifest.log
    top = log.filter(F.col("tree") == TOP)
    below = log.filter(F.col("tree") != TOP)
    none = F.lit(b"")
    roots = top.filter(_IS_ROOT).select("tree", "level", F.lit(0).cast("long").alias("node"), "n",
                                       F.col("digest").alias("subroot"), F.col("digest").alias("root"),
                                       none.alias("siblings"), none.alias("sides"))
    langs = manifest.trees.count()
    of_trees = _blocks(top, _spread_paths(top, roots, langs, bits, 0), 0, bits) \
        .groupBy("tree", "block").applyInArrow(_paths(0, bits), _PATH)
    of_trees = of_trees.select(F.col("node").alias("tree"), "root", "siblings", "sides")
    roots = below.filter(_IS_ROOT).select("tree", "level", F.lit(0).cast("long").alias("node"), "n",
                                         F.col("digest").alias("subroot")).join(of_trees, "tree")
    tops = _spread_paths(below, roots.select("tree", "level", "node", "n", "subroot", "root", "siblings", "sides"),
                         manifest.most, bits, 0)
    leaves = manifest.leaves.withColumn("block", F.shiftright("node", bits))
    return leaves.groupBy("tree", "block").cogroup(_blocks(below, tops, 0, bits).groupBy("tree", "block")) \
        .applyInArrow(_prove(bits, changed), _PROOF)


def manifest_report(documents: DataFrame, bits: int = BITS) -> DataFrame:
    """Leaf, roots and proof of every document, and what the proof says of one whose n_chars was raised by one.

    That is done to the documents whose CRC-32 of the decimal doc_id is divisible by seven.
    """
    columns = {c: F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")}
    columns["n_chars"] = (F.col("n_chars").cast("decimal(38,0)") + 1).cast("decimal(38,0)")
    picked = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 7 == 0
    carry = {"changed": F.when(picked, leaf_digest(*columns.values()))}
    return proofs(build(documents, bits, carry=carry), "changed")


def _sql_leaf(n_chars: str) -> str:
    pieces = (f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
              for c in ("doc_id", "source", "lang", n_chars, "text"))
    return f"sha256({' || '.join(pieces)})"


def _sql_nodes(name: str, leaves: str) -> str:
    return f"""{name} AS (
        SELECT tree, n, 0 AS level, node, digest FROM {leaves}
        UNION ALL
        SELECT tree, n, level + 1, node // 2, sha256(string_agg(digest, '' ORDER BY node))
        FROM {name} WHERE (n - 1) >> level > 0 GROUP BY tree, n, level, node // 2)"""


def _sql_steps(leaves: str, nodes: str) -> str:
    """One row a level: L or R and the sibling, or N."""
    return f"""SELECT l.tree, l.node, k.level,
            CASE WHEN s.digest IS NULL THEN 'N' WHEN (l.node >> k.level) % 2 = 1 THEN 'L' || s.digest
                 ELSE 'R' || s.digest END AS step
        FROM {leaves} l JOIN (SELECT unnest(range(62)) AS level) k ON (l.n - 1) >> k.level > 0
        LEFT JOIN {nodes} s ON s.tree = l.tree AND s.level = k.level AND s.node = xor(l.node >> k.level, 1)"""


#: The CRC-32 is worked out bit by bit (polynomial EDB88320, reflected).
ORACLE = f"""WITH RECURSIVE
    docs AS MATERIALIZED (
        SELECT doc_id, lang, {_sql_leaf('n_chars')} AS digest, {_sql_leaf('(n_chars::HUGEINT + 1)')} AS raised,
            xor(list_reduce(list_prepend(4294967295::UBIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
                lambda c: [ascii(c)::UBIGINT, 0, 0, 0, 0, 0, 0, 0]))),
                lambda x, b: xor(xor(x, b) >> 1, 3988292384::UBIGINT * (xor(x, b) & 1))), 4294967295::UBIGINT) AS crc
        FROM documents),
    trees AS MATERIALIZED (
        SELECT lang, count(*) AS n, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
            count(*) OVER () AS n_trees FROM docs GROUP BY lang),
    leaves AS MATERIALIZED (
        SELECT t.tree, t.n, d.doc_id, d.digest, CASE WHEN crc % 7 = 0 THEN raised ELSE digest END AS told,
            row_number() OVER (PARTITION BY t.tree ORDER BY d.doc_id NULLS FIRST, d.digest) - 1 AS node
        FROM docs d JOIN trees t ON d.lang IS NOT DISTINCT FROM t.lang),
    {_sql_nodes('nodes', 'leaves')},
    roots AS MATERIALIZED (
        SELECT 0 AS tree, r.tree AS node, t.n_trees AS n, r.digest FROM nodes r JOIN trees t USING (tree)
        WHERE (r.n - 1) >> r.level = 0),
    {_sql_nodes('above', 'roots')},
    below_steps AS (SELECT tree, node, list(step ORDER BY level) AS steps
        FROM ({_sql_steps('leaves', 'nodes')}) GROUP BY ALL),
    top_steps AS (SELECT node AS tree, list(step ORDER BY level) AS steps
        FROM ({_sql_steps('roots', 'above')}) GROUP BY ALL),
    told AS (
        SELECT l.doc_id, l.digest AS leaf, r.digest AS subroot, a.digest AS root, l.told,
            coalesce(b.steps, []) || coalesce(s.steps, []) AS steps
        FROM leaves l JOIN roots r ON r.node = l.tree JOIN above a ON (a.n - 1) >> a.level = 0
        LEFT JOIN below_steps b ON b.tree = l.tree AND b.node = l.node LEFT JOIN top_steps s ON s.tree = l.tree),
    folded AS (
        SELECT *, list_reduce(list_prepend(told, steps), lambda x, s: CASE s[1] WHEN 'L' THEN sha256(s[2:] || x)
            WHEN 'R' THEN sha256(x || s[2:]) ELSE sha256(x) END) AS folded_root FROM told)
    SELECT doc_id, leaf, subroot, root,
        sha256(array_to_string(list_transform(list_filter(steps, lambda s: s <> 'N'), lambda s: s[2:]), '')) AS proof_sha256,
        folded_root, folded_root = root AS verified,
        len(list_filter(steps, lambda s: s <> 'N'))::INTEGER AS n_siblings
    FROM folded"""
