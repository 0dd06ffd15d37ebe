"""Fingerprints, edited texts and near fingerprints against plain versions."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from samples import sentence

from strataseek.llm import simhash
from strataseek.llm.common import buffers


def prints_of(texts):
    return simhash.fingerprints(*buffers(pa.array([(t or "").encode() for t in texts], pa.binary())))


def test_counters_are_those_of_single_bits():
    random = np.random.default_rng(3)
    hashes = random.integers(0, 1 << 63, 3000).astype(np.uint64) * np.uint64(2) + random.integers(0, 2, 3000).astype(np.uint64)
    begins = np.array([0, 1, 255, 511, 700, 2999])
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(int)
    assert (simhash._ones(hashes, begins) == np.add.reduceat(bits, begins, axis=0)).all()


def test_equal_texts_and_their_place_in_a_batch():
    texts = ["", " \n", sentence(1, 300), "one", "x" * 5000, sentence(1, 300), None, "One", "日本" * 40]
    together = prints_of(texts)
    assert all((prints_of([t])[0] == p).all() for t, p in zip(texts, together))
    assert (together[2] == together[5]).all() and (together[3] == together[7]).all()
    assert not together[0].any() and not together[6].any() and together[1].any() and together[8].any()


def test_likeness_follows_the_shared_part():
    base, other = sentence(5, 400).split(), sentence(6, 400).split()
    texts = [" ".join(base[:k] + other[k:]) for k in (400, 380, 300, 200, 100, 0)]
    found = prints_of(texts)
    values = [simhash.likeness(found[:1], found[k:k + 1])[0] for k in range(6)]
    assert values[0] == 1 and values == sorted(values, reverse=True)
    assert abs(values[3] - 0.5) < 0.2 and values[5] < 0.2


def plain(rows):
    """(doc_id, n_chars, hash of the edited text, fingerprint, its edited fingerprint) in order."""
    rows = sorted(((i, t or "") for i, t in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, np.uint64(xxhash.xxh64_intdigest(r[1].encode(), 42)).view(np.int64)))
    texts = [t for _, t in rows]
    following = texts[1:] + texts[:1]
    changed = [t[:len(t) - len(t) // 2] + n[:len(t) // 2] for t, n in zip(texts, following)]
    own, new, after = prints_of(texts), prints_of(changed), prints_of(following)
    for k, (i, t) in enumerate(rows):
        yield (i, len(t), hashlib.sha256(changed[k].encode()).hexdigest(), simhash.hex_text(own)[k], simhash.hex_text(new)[k],
               float(simhash.likeness(own, new)[k]), float(simhash.likeness(own, after)[k]))


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))


def test_odd_rows(spark, odd):
    rows, frame = odd
    frame = frame.withColumns({c: F.lit(1) for c in ("f0", "f1", "kind", "part", "tie", "row", "fingerprint", "n_near", "t")})
    got = [tuple(r)[:7] for r in simhash.fingerprint_report(frame).collect()]
    assert order(got) == order(plain(rows))


def test_one_row_no_row_and_many_equal_rows(spark, nothing):
    assert simhash.fingerprint_report(nothing).count() == 0
    one = spark.createDataFrame([(4, "a b")], "doc_id long, text string")
    assert [tuple(r)[:7] for r in simhash.fingerprint_report(one).collect()] == list(plain([(4, "a b")]))
    rows = [(3, sentence(2, 20))] * 60 + [(k, sentence(k, 9)) for k in range(10)]
    got = simhash.fingerprint_report(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    assert order(tuple(r)[:7] for r in got) == order(plain(rows))


@pytest.mark.parametrize("radius, blocks, hot_rows", [(7, 8, 50_000), (7, 8, 2), (3, 5, 4), (20, 21, 6), (0, 1, 2)])
def test_near_links_are_all_pairs(spark, radius, blocks, hot_rows):
    random = np.random.default_rng(radius)
    centres = random.integers(0, 1 << 62, (6, 4)).astype(np.uint64) * np.uint64(3)
    rows = [centres[k % 6].copy() for k in range(150)]
    for k, row in enumerate(rows):
        for bit in random.integers(0, 256, k % 13):
            row[bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
    table = spark.createDataFrame([(*map(int, r.view(np.int64)), 1) for r in rows] + [(None, 1, 1, 1, 2)],
                                  "f0 long, f1 long, f2 long, f3 long, t int")
    unique = np.unique(np.array(rows), axis=0)
    distance = np.bitwise_count(unique[:, None] ^ unique[None]).sum(-1)
    expected = {(frozenset((i, j)), int(distance[i, j])) for i in range(len(unique)) for j in range(i)
                if distance[i, j] <= radius}
    number = {tuple(map(int, r.view(np.int64))): k for k, r in enumerate(unique)}
    found = [(frozenset((number[tuple(r)[:4]], number[tuple(r)[4:8]])), r.distance)
             for r in simhash.near_links(table, radius, blocks, hot_rows).collect()]
    assert len(found) == len(set(found)) and set(found) == expected and (radius == 0 or expected)
