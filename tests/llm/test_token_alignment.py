"""Alignment of two tokenizers against the libraries and plain loops."""

import hashlib
from collections import Counter, defaultdict
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strataseek.llm import token_alignment
from strataseek.llm.byte_bpe import _byte_letters
from strataseek.llm.queries import tokenizer_file

A, B = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")


class Plain:
    """Ids and common ends of one text by the libraries alone."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        self.letter = {chr(c): b for b, c in enumerate(_byte_letters())}

    def __call__(self, text):
        text = text or ""
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        a_bytes = [bytes(self.letter[c] for c in self.a.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
                   else self.b.id_to_piece(i).replace("▁", " ").encode() for i in b]
        whole = (" " + text).encode()
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            return [], [], []
        a_ends = {e: k for k, e in enumerate(accumulate(map(len, a_bytes)))}
        b_ends = {e: k for k, e in enumerate(accumulate(map(len, b_bytes)))}
        return a, b, [(a_ends[e], b_ends[e], e) for e in sorted(a_ends.keys() & b_ends.keys())]


def group_text(a, b, ends):
    parts, i, j = [], 0, 0
    for p, q, _ in ends:
        parts.append(",".join(map(str, a[i:p + 1])) + "|" + ",".join(map(str, b[j:q + 1])))
        i, j = p + 1, q + 1
    return ";".join(parts)


def brute(rows):
    plain, counts, found = Plain(), Counter(), []
    for i, text in rows:
        a, b, ends = plain(text)
        links = [(a[p], b[q]) for p, q, _ in ends]
        counts.update(links)
        found.append((i, a, b, ends, links))
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    for i, a, b, ends, links in found:
        yield (i, len(a), len(b), len(ends), len(links), sum(counts[x] == most[x[1]] for x in links),
               sum(counts[x] for x in links), hashlib.sha256(group_text(a, b, ends).encode()).hexdigest() if a else "")


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, *r[1:]))


@pytest.mark.parametrize("batch_bytes", [32 << 20, 4000])
def test_odd_rows(spark, odd, batch_bytes):
    rows, frame = odd
    rows = rows + [(30, "a ▁ b"), (31, "<s> <0x41> <unk> <|endoftext|>"), (32, "  "), (33, "\n\n x\t"), (34, "مرحبا 東京 ñandú")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumns(
        {c: F.lit(2) for c in ("batch", "code", "a", "b", "count", "best", "n_a", "links", "wide")})
    assert order(tuple(r) for r in token_alignment.alignment_report(frame, A, B, batch_bytes).collect()) == order(brute(rows))


def test_numbers_of_four_bytes(spark, odd, monkeypatch):
    """More pairs in one slice than two bytes can number."""
    monkeypatch.setattr(token_alignment, "NARROW", 40)
    rows, frame = odd
    made = pa.concat_tables(pa.Table.from_batches([b]) for b in _encoded(rows))
    assert any(w for w in made["wide"].to_pylist())
    expected = Counter()
    plain = Plain()
    for _, text in rows:
        a, b, ends = plain(text)
        expected.update((a[p], b[q]) for p, q, _ in ends)
    seen = Counter()
    for pairs, counts in zip(made["pairs"].to_pylist(), made["counts"].to_pylist()):
        if pairs is not None:
            for pair, n in zip(np.frombuffer(pairs, np.int64).tolist(), np.frombuffer(counts, np.int64).tolist()):
                seen[(pair >> 32, pair & 0xFFFFFFFF)] += n
    assert seen == expected


def _encoded(rows):
    class Task:
        @staticmethod
        def get():
            return Task

        @staticmethod
        def partitionId():
            return 3

    token_alignment.TaskContext, real = Task, token_alignment.TaskContext
    try:
        batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()),
                                            pa.array([(r[1] or "").encode() for r in rows], pa.binary())],
                                           names=["doc_id", "text"])
        yield from token_alignment._encode(A, B, 1 << 30)(iter([batch]))
    finally:
        token_alignment.TaskContext = real


def test_groups_and_nothing(spark, odd, nothing):
    rows, frame = odd
    plain = Plain()
    got = {(r.doc_id, len(r.a_ids)): r for r in token_alignment.alignments(frame, A, B).collect()}
    for i, text in rows:
        a, b, ends = plain(text)
        r = got[(i, len(a))]
        assert r.a_ids == a and r.b_ids == b
        before = [(-1, -1, 0), *ends]
        assert [tuple(g) for g in r.groups] == [(e, p0 + 1, p + 1, q0 + 1, q + 1)
                                                for (p0, q0, _), (p, q, e) in zip(before, ends)]
    assert token_alignment.alignment_report(nothing, A, B).count() == 0
    assert token_alignment.alignments(nothing, A, B).count() == 0


def test_gallop_finds_what_a_plain_search_finds():
    random = np.random.default_rng(1)
    for size in (1, 2, 7, 300):
        ends = np.cumsum(random.integers(1, 9, size))
        values = np.sort(random.integers(0, ends[-1] + 1, 200))
        guess = random.integers(0, size, 200)
        low, high = np.zeros(200, np.int64), np.full(200, size)
        assert (token_alignment.gallop(values, ends, guess, low, high) == np.searchsorted(ends, values)).all()
