"""Ids of whole texts of both libraries, and of the registered query."""

import zlib

import duckdb
import numpy as np

from strataseek.llm import sentencepiece, sentencepiece_model
from strataseek.llm.queries import tokenizer_file

PIECES = tokenizer_file("piece_bpe_32k.model")
TABLE = "/root/testdata/sf0.01/documents.parquet"


def test_ids_of_whole_texts_agree(spark):
    import sentencepiece as native

    processor = native.SentencePieceProcessor(model_file=PIECES)
    whole = sentencepiece_model.rebuild(sentencepiece_model.Model.parse(open(PIECES, "rb").read()))
    rows = duckdb.execute(f"SELECT doc_id, text FROM '{TABLE}' WHERE text IS NOT NULL").fetchall()
    wanted = {i: processor.encode(t) for i, t in rows}
    assert all(whole.encode(t, add_special_tokens=False).ids == wanted[i] for i, t in rows)
    found = sentencepiece.encode_decode(spark.read.parquet(TABLE).filter("text is not null"), PIECES)
    got = {r["doc_id"]: (r["input_ids"], r["ids_crc32"]) for r in found.select("doc_id", "input_ids", "ids_crc32").collect()}
    assert got == {i: (ids, zlib.crc32(np.array(ids, "<u4").tobytes())) for i, ids in wanted.items()}
