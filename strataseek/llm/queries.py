"""Registered queries of the operators in this package, with production parameters."""

from __future__ import annotations

import os
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strataseek.llm import decontamination, hilbert_search, jaccard_join, line_dedup, lm_scoring, \
    merkle_manifest, repeated_spans, sentencepiece, simhash, \
    token_alignment, token_counts, token_files, toxicity
from strataseek.llm.common import read

TOKENIZERS = os.environ.get("TOKENIZER_FILES", "")


def tokenizer_file(name: str) -> str:
    """A vocabulary file in the folder ``TOKENIZER_FILES``, else of the installed package."""
    if TOKENIZERS:
        return os.path.join(TOKENIZERS, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files_report(read(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_report(read(spark, sf_dir, "documents"), lm_scoring.TRIGRAMS)


op1_lm_scoring_trigrams = op1_lm_scoring


def op1_lm_scoring_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_report(read(spark, sf_dir, "documents"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.token_report(read(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "n_shared", "n_shingles")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.word_piece_counts(read(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op6_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return hilbert_search.search(vectors, vectors.filter("vec_id % 100 = 0"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(read(spark, sf_dir, "documents"))


def op9_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans.span_report(read(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.runs_report(read(spark, sf_dir, "documents"))


op10_repeated_runs = op10_line_dedup


def op10_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(read(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest.manifest_report(read(spark, sf_dir, "documents"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprint_report(read(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment_report(read(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"),
                                            tokenizer_file("piece_bpe_32k.model"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if re.match(r"op\d+_", name)}


def llm_oracles() -> dict[str, str]:
    return {"op1_lm_scoring": lm_scoring.TRIGRAM_ORACLE, "op1_lm_scoring_trigrams": lm_scoring.TRIGRAM_ORACLE,
            "op1_lm_scoring_pairs": lm_scoring.ORACLE, "op4_decontamination": decontamination.ORACLE,
            "op10_line_dedup": line_dedup.RUNS_ORACLE, "op10_repeated_runs": line_dedup.RUNS_ORACLE,
            "op10_line_chunks": line_dedup.ORACLE, "op11_merkle_manifest": merkle_manifest.ORACLE}
