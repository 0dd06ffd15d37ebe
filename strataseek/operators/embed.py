"""Embedding of a text column, natively or with a user model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf, pandas_udf

from strataseek.functions.vectors import hashing_embedding, is_zero_vector, token_embedding

# Texts per model call.
BATCH_TEXTS = 100


def embed_hashing(df: DataFrame, text: str = "chunk_text", out: str = "embedding",
                  dim: int = 64) -> DataFrame:
    """Hashed bag-of-words vectors; ``embedding_ok`` is false for a text without tokens.
    A ``tokens`` column is used when there is one."""
    vector = (token_embedding("tokens", dim) if "tokens" in df.columns
              else hashing_embedding(text, dim))
    return (df.withColumn(out, vector)
            .withColumn("embedding_ok", ~is_zero_vector(out)))


def embed_with_model(df: DataFrame, load_model: Callable[[], Callable[[list[str]], list]],
                     dim: int, text: str = "chunk_text", out: str = "embedding",
                     batch_texts: int = BATCH_TEXTS) -> DataFrame:
    """Embed with any model: ``load_model()`` runs once per task and returns a function
    from a list of texts to a list of vectors, called with ``batch_texts`` texts.

    A call that raises or returns vectors of another length gives zero vectors for its
    batch, marked by ``embedding_ok = false``, so the job goes on.
    """
    @pandas_udf("struct<vector: array<double>, ok: boolean>")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = load_model()
        for texts in batches:
            vectors, ok = [], []
            for start in range(0, len(texts), batch_texts):
                part = texts.iloc[start:start + batch_texts].fillna("").tolist()
                try:
                    made = [[float(v) for v in vector] for vector in model(part)]
                    fine = len(made) == len(part) and all(len(v) == dim for v in made)
                except Exception:
                    fine = False
                vectors += made if fine else [[0.0] * dim for _ in part]
                ok += [fine] * len(part)
            yield pd.DataFrame({"vector": vectors, "ok": ok})

    return (df.withColumn("__embedded", embed(F.col(text)))
            .withColumn(out, F.col("__embedded.vector"))
            .withColumn("embedding_ok", F.col("__embedded.ok")).drop("__embedded"))


def extract_with(df: DataFrame, load_model: Callable[[], Callable[[list[str]], list[str]]],
                 text: str, out: str, batch_texts: int = BATCH_TEXTS) -> DataFrame:
    """Text-to-text hook (for example abstract extraction by a hosted model);
    a failed call gives null for its batch."""
    @arrow_udf("string")
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = load_model()
        for texts in batches:
            # only the texts of one call are Python objects, however many rows a batch holds
            result = []
            for start in range(0, len(texts), batch_texts):
                part = [t or "" for t in texts.slice(start, batch_texts).to_pylist()]
                try:
                    answers = list(model(part))
                    if len(answers) != len(part):
                        answers = [None] * len(part)
                except Exception:
                    answers = [None] * len(part)
                result.append(pa.array(answers, pa.string()))
            yield pa.concat_arrays(result) if result else pa.array([], pa.string())

    return df.withColumn(out, extract(F.col(text)))
