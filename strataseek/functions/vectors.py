"""Vector expressions: the hashing embedder and similarity of two array columns."""

from __future__ import annotations

from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from strataseek.functions.geo import let
from strataseek.functions.text import tokens

METRICS = ("cosine", "dot", "l2")


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def token_bucket(token: Column | str, dim: int) -> Column:
    """Bucket of a token: the first 32 bits of its md5 modulo ``dim``."""
    head = F.conv(F.substring(F.md5(_column(token).cast("binary")), 1, 8), 16, 10)
    return (head.cast("bigint") % dim).cast("int")


def hashing_embedding(text: Column | str, dim: int = 64) -> Column:
    """Unit-length vector of token-bucket counts; the zero vector when no token exists."""
    return token_embedding(tokens(text), dim)


def token_embedding(token_list: Column | str, dim: int = 64) -> Column:
    """:func:`hashing_embedding` of text that is already split into tokens.

    The different tokens of an Arrow batch get their bucket once, and buckets are counted in one pass, whatever ``dim`` is.
    """
    @arrow_udf("array<double>")
    def unit_counts(lists: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        owner, held = np.repeat(np.arange(len(lists)), sizes), pc.list_flatten(lists)
        if held.null_count:
            owner, held = owner[held.is_valid().to_numpy(zero_copy_only=False)], held.drop_null()
        words = held.dictionary_encode()
        buckets = np.array([_bucket(w, dim) for w in words.dictionary.cast(pa.binary()).to_pylist()], np.int64)
        cells = owner * dim + buckets[words.indices.to_numpy()]
        counts = np.bincount(cells, minlength=len(lists) * dim).reshape(-1, dim).astype(np.float64)
        norm = np.sqrt(np.einsum("ij,ij->i", counts, counts))
        counts /= np.where(norm > 0, norm, 1.0)[:, None]
        return pa.ListArray.from_arrays(np.arange(0, counts.size + 1, dim, dtype=np.int32), counts.ravel())

    return unit_counts(_column(token_list))


def _bucket(token: bytes, dim: int) -> int:
    """:func:`token_bucket` in a task."""
    return int.from_bytes(md5(token, usedforsecurity=False).digest()[:4]) % dim


def is_zero_vector(vector: Column | str) -> Column:
    return F.forall(_column(vector), lambda v: v == 0)


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(_column(a), _column(b), lambda x, y: x.cast("double") * y),
                       F.lit(0.0), lambda s, v: s + v)


def norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def similarity(a: Column | str, b: Column | str, metric: str = "cosine") -> Column:
    """``cosine`` (null for a zero vector), ``dot``, or ``l2`` as 1 / (1 + distance squared)."""
    if metric == "dot":
        return dot(a, b)
    if metric == "cosine":
        return let(norm(a) * norm(b), lambda n: F.when(n > 0, dot(a, b) / n))
    if metric == "l2":
        gap = F.zip_with(_column(a), _column(b), lambda x, y: x.cast("double") - y)
        return F.lit(1.0) / (1.0 + F.aggregate(gap, F.lit(0.0), lambda s, v: s + v * v))
    raise ValueError(f"unknown metric {metric!r}, expected one of {METRICS}")
