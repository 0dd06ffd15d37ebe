"""Operators 2, 3 and 5 against the libraries they stand for."""

import io
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer, models

from strataseek.llm import sentencepiece, sentencepiece_model, token_counts, token_files
from strataseek.llm.queries import tokenizer_file

BPE, PIECES = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_round_trip(odd):
    rows, documents = odd
    tokenizer = Tokenizer.from_file(BPE)
    found = sorted(tuple(r) for r in token_files.token_files_report(documents, BPE).collect())
    before, expected = 0, []
    for doc_id, text in sorted(((i, t or "") for i, t in rows if i is not None), key=lambda r: (r[0], r[1])):
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        expected.append((doc_id, before, len(ids), crc(ids)))
        before += len(ids)
    assert found == sorted(expected)


def test_token_files_read_single_documents(spark, odd, tmp_path):
    rows, documents = odd
    files = token_files.write_token_files(documents, BPE, folder=f"file://{tmp_path}").collect()
    tokenizer = Tokenizer.from_file(BPE)
    texts = dict(rows)
    for file in files:
        reader = token_files.open_reader(spark, file["path"], file["width"])
        for doc_id in {9, 12} & set(reader.doc_ids.tolist()):
            ids = reader.document(doc_id)[0].tolist()
            assert ids == tokenizer.encode(texts[doc_id], add_special_tokens=False).ids + [0]


def test_frames_are_read_apart_and_checked(monkeypatch):
    monkeypatch.setattr(token_files, "FRAME_IDS", 10)
    out = io.BytesIO()
    writer = token_files.FrameWriter(out, np.dtype("<u2"))
    counts = np.array([3, 25, 1, 0, 9, 2])
    ids = np.arange(counts.sum(), dtype="<u2")
    writer.add(np.arange(4), counts[:4], ids[:29])
    writer.add(np.arange(4, 6), counts[4:], ids[29:])
    assert writer.close() == (6, 40)
    assert len(writer.frames) > 3

    class Stream(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    reader = token_files.FrameReader(Stream(out.getvalue()), np.dtype("<u2"))
    edges = np.cumsum([0, *counts])
    for doc in range(6):
        assert reader.document(doc)[0].tolist() == ids[edges[doc]:edges[doc + 1]].tolist()
    broken = bytearray(out.getvalue())
    reader = token_files.FrameReader(Stream(bytes(broken)), np.dtype("<u2"))
    reader.checks = reader.checks + 1
    with pytest.raises(ValueError):
        reader.document(1)


def test_sentencepiece_parity_and_round_trip(odd):
    import sentencepiece as native

    rows, documents = odd
    processor = native.SentencePieceProcessor(model_file=PIECES)
    found = sentencepiece.encode_decode(documents, PIECES).collect()
    assert len(found) == len(rows)
    for row in found:
        if row["text"] is None:
            assert row["input_ids"] is None and row["n_tokens"] == 0
        else:
            assert row["input_ids"] == processor.encode(row["text"])
            assert row["ids_crc32"] == crc(row["input_ids"])
        assert row["parity"] and row["round_trip"]


def test_sentencepiece_runs_of_spaces_and_decoder():
    import sentencepiece as native

    processor = native.SentencePieceProcessor(model_file=PIECES)
    whole = sentencepiece_model.rebuild(sentencepiece_model.Model.parse(open(PIECES, "rb").read()))
    for n in range(1, 70):
        for text in (" " * n, "a" + " " * n + "b", "\n" + " " * n + "日"):
            ids = processor.encode(text)
            assert whole.encode(text, add_special_tokens=False).ids == ids
            assert whole.decode(ids) == text


def test_word_piece_counts(odd):
    rows, documents = odd
    first, later = token_counts.pieces_of(PIECES)
    vocabulary = {p: k for k, p in enumerate([*dict.fromkeys([*first, *("##" + p for p in later), "[UNK]"])])}
    model = models.WordPiece(vocab=vocabulary, unk_token="[UNK]", max_input_chars_per_word=10 ** 9)
    expected = []
    for doc_id, text in rows:
        pieces = [[t.value for t in model.tokenize(w.decode())] for w in (text or "").encode().split()]
        expected.append((doc_id if doc_id is not None else -1, len(pieces), sum(map(len, pieces)),
                         sum(p == ["[UNK]"] for p in pieces)))
    found = token_counts.word_piece_counts(documents, PIECES).collect()
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in found) == sorted(expected)


def test_longest_match_on_a_small_vocabulary():
    automaton = token_counts.LongestMatch(["a", "abcdx", "ab"], ["b", "c", "cdy", "dz", "d"])
    assert automaton.counts([b"abcdx", b"abcdz", b"abcdy", b"abcd", b"b", b"aq", b"a"]).tolist() == [1, 3, 2, 3, -1, -1, 1]


def test_empty_tables(nothing):
    assert token_files.token_files_report(nothing, BPE).count() == 0
    assert sentencepiece.token_report(nothing, PIECES).count() == 0
    assert token_counts.word_piece_counts(nothing, PIECES).count() == 0
