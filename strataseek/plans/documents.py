"""Document pipeline: bronze papers, clean text, chunks, embeddings, index rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataseek.functions import text
from strataseek.operators.embed import embed_hashing
from strataseek.operators.fulltext import with_tokens

MIN_CONTENT_LENGTH = 100
CHUNK_SIZE = 500
CHUNK_OVERLAP = 50
EMBEDDING_COLUMNS = ["chunk_id", "file_name", "source_url", "chunk_text", "chunk_sequence",
                     "chunk_length", "embedding", "embedding_timestamp"]


def bronze_papers(files: DataFrame, source_url=None, ingested_at=None) -> DataFrame:
    """Landed files with their origin and load time (defaults: unknown, now)."""
    return files.select(
        "file_name", "file_path", "raw_content",
        (ingested_at if ingested_at is not None else F.current_timestamp())
        .alias("ingestion_timestamp"),
        (source_url if source_url is not None else F.lit(None).cast("string"))
        .alias("source_url"))


def silver_clean(bronze: DataFrame, content: str = "raw_content") -> DataFrame:
    """Cleaned documents that are longer than the minimum after cleaning.

    The length test runs inside the generator: as a plain filter it would be pushed below
    the projection and every text would be cleaned twice.
    """
    kept = F.filter(F.array(text.clean_text(content)),
                    lambda c: F.length(c) > MIN_CONTENT_LENGTH)
    return bronze.select("file_name", "source_url", "ingestion_timestamp",
                         F.explode(kept).alias("cleaned_content"))


def silver_chunks(clean: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
                  distinct: bool = False) -> DataFrame:
    """One row per chunk with id, length, reading position and sequence.

    ``chunk_sequence`` numbers the chunks of a document by chunk id, ``chunk_position``
    in reading order from 0. Both are made inside the document row (one row per file),
    so there is no shuffle and a long document is not a hot window key. ``distinct``
    keeps the first of equal chunks of a document, which share one id.
    """
    chunks = text.chunk_text("cleaned_content", size, overlap)
    made = F.transform(chunks, lambda c, i: F.struct(
        text.chunk_key(F.col("file_name"), c).alias("chunk_id"),
        i.alias("chunk_position"), c.alias("chunk_text")))
    ordered = F.array_sort(made)
    if distinct:  # equal ids stand side by side, the first in reading order comes first
        ordered = text.let(ordered, lambda all_: F.filter(all_, lambda m, i: (i == 0) | (
            F.get(all_, i - 1)["chunk_id"] != m["chunk_id"])))
    return (clean.select(*clean.columns, F.posexplode(ordered).alias("__i", "__c"))
            .select(*clean.columns,
                    F.col("__c.chunk_text").alias("chunk_text"),
                    F.col("__c.chunk_id").alias("chunk_id"),
                    F.length("__c.chunk_text").alias("chunk_length"),
                    (F.col("__i") + 1).alias("chunk_sequence"),
                    F.col("__c.chunk_position").alias("chunk_position")))


def chunk_stats(chunks: DataFrame) -> DataFrame:
    return chunks.agg(F.count(F.lit(1)).alias("total_chunks"),
                      F.avg("chunk_length").alias("avg_chunk_length"))


def silver_embeddings(chunks: DataFrame, embedded_at=None, embed=embed_hashing) -> DataFrame:
    """Chunks with vectors. ``embed`` adds ``embedding`` from ``chunk_text``; pass a
    function over :func:`strataseek.operators.embed.embed_with_model` for a model."""
    stamp = embedded_at if embedded_at is not None else F.current_timestamp()
    return (embed(chunks).withColumn("embedding_timestamp", stamp)
            .select(*EMBEDDING_COLUMNS))


def index_rows(bronze: DataFrame, embed=embed_hashing) -> DataFrame:
    """Search index straight from bronze: one row per chunk id with tokens and vector.

    A narrow map from document to chunks; equal chunks of one document collapse to the
    first, as the index key asks.
    """
    chunks = silver_chunks(silver_clean(bronze), distinct=True)
    return embed(with_tokens(chunks)).select(
        "chunk_id", "file_name", "chunk_text", "chunk_position", "chunk_length",
        "tokens", "embedding")
