"""Rows and reference functions for the tests of this folder."""

import random

from pyspark.sql import types as T

WORDS = [a + b for a in ("ka", "lo", "mi", "ter", "nus", "vel", "ran", "sto") for b in ("da", "ne", "rik", "so", "tam", "u")]

#: documents with columns whose names operators use inside
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("score", T.DoubleType()), T.StructField("n", T.LongType()),
    T.StructField("batch", T.StringType()), T.StructField("label", T.IntegerType()),
    T.StructField("key", T.StringType()), T.StructField("n_chars", T.LongType())])


def sentence(seed: int, n: int) -> str:
    chosen = random.Random(seed)
    return " ".join(chosen.choice(WORDS) for _ in range(n))


def frame(spark, rows):
    """A documents table of (doc_id, text); the other columns are filled with clashing values or null."""
    full = [(i, t, 0.5, k, None if k % 2 else "b", k % 2, "k", None if t is None else len(t))
            for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def odd_rows():
    """Nulls, empty and blank texts, very short and very long ones, ties and repeated rows."""
    base = sentence(1, 80)
    lines = "\n".join(sentence(k, 6) for k in range(12))
    return [(0, base), (1, base), (1, base), (2, base.replace("kada", "KADA")), (3, None), (4, ""), (5, "  \n\t "),
            (6, "one"), (7, "One"), (8, "a b c d"), (9, sentence(2, 4000) + "\n" + base), (10, lines),
            (11, "new first line\n" + lines + "\nlast line"), (12, "x" * 3000), (13, "ab " * 2000), (14, "ab " * 2001),
            (15, "é日本\U0001f600 ñ ▁  　 \x1c end"), (16, base + " " + sentence(3, 10)), (None, base),
            (17, sentence(4, 60)), (18, sentence(4, 60) + " kada"), (19, "<|endoftext|> <s> don't  stop")]


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, n=5):
    found = words(text)
    if len(found) < n:
        return {tuple(found)} if found else set()
    return {tuple(found[k:k + n]) for k in range(len(found) - n + 1)}
