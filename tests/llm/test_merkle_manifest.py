"""Manifest trees and proofs against a plain tree of lists."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataseek.llm import merkle_manifest

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("source", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("n_chars", T.LongType()),
                       T.StructField("text", T.StringType())])


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(level):
    levels = [level]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][k:k + 2]) for k in range(0, len(levels[-1]), 2)])
    return levels


def siblings(levels, node):
    for level in levels[:-1]:
        yield (level[node ^ 1], node & 1) if node ^ 1 < len(level) else None
        node >>= 1


def brute(rows):
    by_lang = defaultdict(list)
    for row in rows:
        by_lang[row[2]].append(row)
    langs = sorted(by_lang, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = tree([leaf(r) for r in by_lang[lang]])
    top = tree([trees[lang][-1][0] for lang in langs])
    for number, lang in enumerate(langs):
        for node, row in enumerate(by_lang[lang]):
            proof = [*siblings(trees[lang], node), *siblings(top, number)]
            told = row
            if row[0] is not None and row[3] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0:
                told = (*row[:3], row[3] + 1, row[4])
            folded = leaf(told)
            for step in proof:
                folded = digest(folded) if step is None else digest(step[0], folded) if step[1] else digest(folded, step[0])
            yield (row[0], leaf(row), trees[lang][-1][0], top[-1][0], digest(*(s[0] for s in proof if s)), folded,
                   folded == top[-1][0])


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))


def report(spark, rows, bits):
    frame = spark.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit("x") for c in ("tree", "node", "digest", "part", "place", "__tie", "changed", "n")}).repartition(3)
    return order([tuple(r)[:7] for r in merkle_manifest.manifest_report(frame, bits).collect()])


ODD = [(k, f"s{k % 3}", ("de", "en", None, "", "é")[k % 7 % 5], k * 11, f"text {k} " * (k % 5)) for k in range(45)] + \
    [(3, "s", "en", None, None)] * 3 + [(None, None, None, None, None), (None, None, "en", 5, "a"), (50, "", "zz", 0, ""),
     (51, None, "en", 2 ** 63 - 1, "long " * 50000), (-7, "s", "en", 1, "below"), (52, "s", "en", None, "x")]


@pytest.mark.parametrize("bits", [1, 2, 10])
def test_odd_rows(spark, bits):
    assert report(spark, ODD, bits) == order(brute(ODD))


def test_one_document_and_none(spark):
    row = [(1, "s", "en", 3, "abc")]
    assert report(spark, row, 2) == order(brute(row))
    assert report(spark, [], 2) == []


def test_one_doc_id_in_most_rows(spark):
    rows = [(9, "s", "en", 4, "copy")] * 70 + [(k, "s", "en", 1, "a") for k in range(15)]
    assert report(spark, rows, 3) == order(brute(rows))


def test_tampered_rows_fail(spark):
    rows = [(k, "s", "en", k, "t") for k in range(60)]
    found = {r[0]: r[6] for r in report(spark, rows, 4)}
    assert found == {k: zlib.crc32(str(k).encode()) % 7 != 0 for k in range(60)}


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 13, 64, 77])
def test_positions_follow_the_order_of_completion(n):
    digests = [bytes([k]) * 32 for k in range(n)]
    made = list(merkle_manifest.completed(digests, 0, 0, merkle_manifest.depth(n), True))
    assert [int(merkle_manifest.position(level, node, n)) for level, node, _ in made] == list(range(len(made)))
    levels = tree([d.hex() for d in digests])
    assert all(d.hex() == levels[level][node] for level, node, d in made)
    assert len(made) == sum(map(len, levels))


def test_log_holds_every_position_once_and_gives_single_proofs(spark):
    rows = [(k, "s", "en" if k % 3 else "de", k, "t") for k in range(50)]
    manifest = merkle_manifest.build(spark.createDataFrame(rows, SCHEMA).repartition(3), 2)
    by_tree = defaultdict(list)
    for r in manifest.log.collect():
        by_tree[r.tree].append((r.position, r.level, r.node, r.digest))
    assert all(sorted(p for p, *_ in nodes) == list(range(len(nodes))) for nodes in by_tree.values())
    wanted = spark.createDataFrame([(1, 0), (1, 32), (0, 16)], "tree long, node long")
    there = {(t, level, node): d for t, nodes in by_tree.items() for _, level, node, d in nodes}
    found = merkle_manifest.siblings_of(manifest, wanted).collect()
    assert found and all(there[(r.tree, r.level, (r.node >> r.level) ^ 1)] == r.digest for r in found)
    assert all(r.is_left == bool((r.node >> r.level) & 1) for r in found)
    sizes = {0: 17, 1: 33}
    assert len(found) == sum(((node >> k) ^ 1) << k < sizes[t] for t, node in [(1, 0), (1, 32), (0, 16)] for k in range(7)
                             if (sizes[t] - 1) >> k)
