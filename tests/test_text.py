import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataseek.functions import text


def plain_chunks(t, size=500, overlap=50):
    """The chunk rule stated in plain Python."""
    if not t:
        return []
    out, start, n = [], 0, len(t)
    while True:
        end = start + size
        if end < n:
            stops = [i for i in range(max(end - 100, start) + 1, end + 1) if t[i] in ".!?\n"]
            end = stops[-1] + 1 if stops else end
        if t[start:end].strip():
            out.append(t[start:end].strip())
        if end >= n:
            return out or [t]
        start = end - overlap


CASES = ["", "a", "x" * 500, "x" * 501, "x" * 502, "x" * 5000, "x" * 400 + "." + "y" * 400,
         "x" * 500 + "." + "y" * 10, "x" * 499 + "." + "y" * 600, ("word. " * 1000),
         " " * 700, "a" + " " * 1200 + "b", ("ab! cd? ef\n" * 500), "é." * 900,
         "sentence one. " * 700 + "z" * 9000]


@pytest.mark.parametrize("size, overlap", [(500, 50), (120, 20), (50, 1), (1000, 800), (300, 0)])
def test_chunks_follow_the_rule(spark, size, overlap):
    df = spark.createDataFrame(list(enumerate(CASES)), "id int, t string")
    for row in df.select("id", text.chunk_text("t", size, overlap).alias("c")).collect():
        assert row.c == plain_chunks(CASES[row.id], size, overlap), row.id


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab .!?\n\t\xa0\x1fé", max_size=2500), min_size=1, max_size=15))
def test_chunks_of_random_text(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = {r.id: r.c for r in df.select("id", text.chunk_text("t", 150, 30).alias("c")).collect()}
    assert got == {i: plain_chunks(t, 150, 30) for i, t in enumerate(texts)}


def test_null_text(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert df.select(text.chunk_text("t")).first()[0] == []


@pytest.mark.parametrize("size, overlap", [(500, 402), (100, 2), (0, 0), (500, -1)])
def test_overlap_that_never_ends_is_refused(size, overlap):
    with pytest.raises(ValueError):
        text.check_chunking(size, overlap)


def test_clean(spark):
    cases = {"a é b": "a  b", " x\n\n y\t\tz ": "x y z", "p\xa0q": "pq", "日本": "",
             "a \n b": "a b", "\x0ba\x0c": "a"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.c for r in df.select("t", text.clean_text("t").alias("c")).collect()} == cases


def test_labels_and_names(spark):
    row = spark.createDataFrame([("x" * 201, "short", "A/b c: d!é ")], "a string, b string, c string")
    got = row.select(text.preview("a"), text.preview("b"), text.label("b"),
                     text.safe_title("c"), text.safe_id("c")).first()
    assert got[0] == "x" * 200 + "..." and got[1] == "short" and got[2] == "short..."
    assert got[3] == "Ab_c_dé" and got[4] == "A_b_c:_d!é_"


def test_times(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05",), ("2024-01-02 03:04:05.5",)], "t string") \
        .select(F.col("t").cast("timestamp").alias("t"))
    got = [tuple(r) for r in df.select(text.iso_text("t"), text.run_stamp("t")).collect()]
    assert got == [("2024-01-02T03:04:05", "20240102_030405"),
                   ("2024-01-02T03:04:05.500000", "20240102_030405")]
