"""A training corpus from raw documents: each stage gets the documents that the one before it kept.

All but the last stage return the columns of ``documents``; each is written as Parquet and read
again by the next. Rows with null text or doc_id pass every filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataseek.llm.common import free_name
from strataseek.llm.decontamination import decontaminate
from strataseek.llm.jaccard_join import keep_first
from strataseek.llm.line_dedup import dedup_runs
from strataseek.llm.queries import tokenizer_file
from strataseek.llm.sentencepiece import encode_decode
from strataseek.llm.toxicity import THRESHOLD, score, train
from strataseek.session import cut_lineage, ship_package


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is scored below the threshold; learned from ``labels``."""
    ship_package(spark)
    model = cut_lineage(train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")), "toxicity-model")
    column = free_name(docs, "__score")
    return score(docs, model, column=column).filter(F.col(column) < THRESHOLD).drop(column)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the runs of two or more lines that stand earlier."""
    ship_package(spark)
    kept = dedup_runs(docs).select(*[f"`{c}`" for c in docs.columns])
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    ship_package(spark)
    return keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    ship_package(spark)
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their SentencePiece ids, and whether these decode to the text."""
    ship_package(spark)
    return encode_decode(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES = [("toxicity", toxicity), ("line dedup", line_dedup), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", decontamination), ("SentencePiece encoding", token_ids)]

#: Learned weights and token ids cannot be written in SQL; tests/llm compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
