import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from strataseek.operators.dedupe import latest_per_key
from strataseek.plans import dashboards, documents, medallion
from strataseek.sinks import tables
from strataseek.sources import boundaries, events, files, papers
from strataseek.streaming import index_upkeep, monitor


# ---------------------------------------------------------------- sources

def test_geojson_events(spark, tmp_path):
    feature = {"type": "Feature", "id": "e1", "properties": {"time": 5, "mag": 3.1, "place": "p"},
               "geometry": {"type": "Point", "coordinates": [-1.5, 2.5, 7.0]}}
    flat = {"id": "e2", "properties": {}, "geometry": {"coordinates": [1, 2]}}
    (tmp_path / "a.json").write_text(json.dumps({"features": [feature, flat]}, indent=2))
    got = events.read_geojson_events(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == [
        ("e1", 5, 2.5, -1.5, 7.0, 3.1, "p"), ("e2", None, 2.0, 1.0, None, None, None)]
    assert [f.dataType.simpleString() for f in got.schema] == [
        "string", "bigint", "double", "double", "double", "double", "string"]


def test_time_filter_is_pushed_to_parquet(spark, tmp_path):
    path = str(tmp_path / "ev")
    spark.createDataFrame([("a", 1706000000000, 4.0), ("b", 1, 9.0)],
                          "event_id string, event_time long, magnitude double") \
        .write.parquet(path)
    recent = events.recent_events_filter(spark.read.parquet(path), date(2024, 1, 31))
    assert [r.event_id for r in recent.collect()] == ["a"]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(event_time" in plan


def test_boundaries(spark, tmp_path):
    shape = {"type": "MultiPolygon", "coordinates": [
        [[[0, 0], [1, 0], [1, 1], [0, 0]]], [[[5, 5], [6, 5], [6, 6], [5, 5]]]]}
    doc = {"features": [{"properties": {"STATEFP": "01", "NAME": "A", "X": 1}, "geometry": shape}]}
    (tmp_path / "s.json").write_text(json.dumps(doc, indent=1))
    got = boundaries.read_geojson_boundaries(
        spark, str(tmp_path), {"STATEFP": "state_fips", "NAME": "state_name"})
    assert got.columns == ["state_fips", "state_name", "geometry_wkt"]
    assert got.first().geometry_wkt == \
        "MULTIPOLYGON (((0 0,1 0,1 1,0 0)),((5 5,6 5,6 6,5 5)))"


def test_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("line one\nline two")
    (tmp_path / "b.pdf").write_bytes(b"%PDF" + bytes(2 << 20))
    assert [r.file_name for r in files.file_inventory(spark, str(tmp_path), (".pdf",)).collect()] \
        == ["b.pdf"]
    sizes = files.file_inventory(spark, str(tmp_path), (".txt", ".pdf"))
    assert {r.file_name: r.size_mb for r in sizes.collect()} == {"a.txt": 0.0, "b.pdf": 2.0}
    whole = files.read_whole_text(spark, str(tmp_path)).collect()
    assert [(r.file_name, r.raw_content) for r in whole] == [("a.txt", "line one\nline two")]
    binary = files.read_binary_files(spark, str(tmp_path), "*.pdf").first()
    assert bytes(binary.content[:4]) == b"%PDF"


def test_papers(spark, tmp_path):
    result = [{"pmcid": "PMC1", "title": "T" * 120, "abstractText": "A.\n\nB", "doi": "d"},
              {"pmid": "22"}, {}]
    (tmp_path / "one.json").write_text(json.dumps(
        {"hitCount": 40, "query": "q1", "resultList": {"result": result}}))
    (tmp_path / "two.json").write_text(json.dumps(
        {"hitCount": 1, "query": "q2", "resultList": {"result": [{"pmcid": "PMC9"}]}}))
    one, two = str(tmp_path / "one.json"), str(tmp_path / "two.json")
    read = papers.read_paper_json(spark, one, two)
    assert sorted(r.paper_id for r in read.collect()) == ["22", "PMC1", "PMC9", "paper_3"]
    capped = papers.read_paper_json(spark, one, max_papers=2)
    assert sorted(r.paper_id for r in capped.collect()) == ["22", "PMC1"]
    blank = read.filter("paper_id = 'paper_3'").first()
    assert (blank.title, blank.abstract, blank.authors, blank.pub_year) == (
        "No title", "", "Unknown", "Unknown")
    rendered = papers.render_paper(read).select(
        "paper_id", "content", papers.extract_abstract("content").alias("a"))
    by_id = {r.paper_id: r for r in rendered.collect()}
    assert by_id["PMC1"].content.startswith("PAPER ID: PMC1\nTITLE: TTT")
    assert by_id["PMC1"].a == "A.\n\nB" and by_id["22"].a == ""
    summary = {r.query: r for r in papers.ingest_summary(read, "s").collect()}
    assert (summary["q1"].total_available, summary["q1"].papers_downloaded) == (40, 3)
    assert summary["q1"].papers[1].title.endswith("...")


def test_atom(spark, tmp_path):
    (tmp_path / "feed.xml").write_text("""<?xml version="1.0"?>
<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>http://x.example/abs/1234v1</id>
<title>Two
lines</title><link href="http://x.example/abs/1234v1" rel="alternate"/>
<link title="pdf" href="http://x.example/pdf/1234v1"/></entry>
<entry><id>http://x.example/abs/math/9</id><title> Other </title>
<link href="http://x.example/abs/math/9"/></entry></feed>""")
    got = sorted(map(tuple, papers.read_atom_entries(spark, str(tmp_path)).collect()))
    assert got == [("1234v1", "Two lines", "http://x.example/pdf/1234v1"),
                   ("math/9", "Other", "http://x.example/pdf/math/9.pdf")]


def test_document_elements(spark):
    good = '{"document":{"elements":[{"type":"text","content":"a","extra":1}]}}'
    df = spark.createDataFrame([(good,), ("not json",), (None,)], "c string")
    got = [r[0] for r in df.select(papers.document_elements("c")).collect()]
    assert [(e.type, e.content) for e in got[0]] == [("text", "a")] and got[1:] == [None, None]


# ---------------------------------------------------------------- sinks

def test_sinks(spark, tmp_path):
    df = spark.range(10).select("id", (F.col("id") % 2).alias("part"))
    assert tables.write_parquet(df, str(tmp_path / "t"), partition_by="part") == 10
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if p.is_dir()) == ["part=0", "part=1"]
    assert tables.write_parquet(df.limit(3), str(tmp_path / "t")) == 3  # full overwrite
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    tables.write_parquet(df.select("id"), str(tmp_path / "m/v=1"))
    tables.write_parquet(df.withColumn("extra", F.lit("x")), str(tmp_path / "m/v=2"))
    merged = tables.read_merged(spark, str(tmp_path / "m"))
    assert merged.filter("extra is null").count() == 10 and merged.count() == 20
    tables.ensure_namespace(spark, "bronze_test", "bronze_test")
    tables.save_table(df, "bronze_test.t1", str(tmp_path / "t1"))
    tables.save_table(df.select("id"), "bronze_test.t1", str(tmp_path / "t1"))
    assert spark.table("bronze_test.t1").columns == ["id"]
    tables.create_table(spark, "bronze_test.t1", "other string")  # kept as it is
    assert spark.table("bronze_test.t1").columns == ["id"]
    tables.write_json(spark.createDataFrame([(1, None)], "a int, b string"), str(tmp_path / "j"))
    lines = [l for f in (tmp_path / "j").glob("part-*") for l in f.read_text().splitlines()]
    assert lines == ['{"a":1,"b":null}']


# ---------------------------------------------------------------- plans

def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", 1, None)],
                               "k string, t int, v string")
    assert sorted(map(tuple, latest_per_key(df, "k", ["t"]).collect())) == [
        ("a", 3, "y"), ("b", 1, None)]


def test_silver_rules(spark):
    raw = spark.createDataFrame(
        [("a", 1704067200123, 10.0, 20.0, None, 5.0, "p"), (None, 1, 1.0, 1.0, 1.0, 1.0, "p"),
         ("b", 1, 90.0, -180.0, 1.0, 1.0, "p"), ("c", 1, 90.1, 0.0, 1.0, 1.0, "p"),
         ("d", 1, None, 0.0, 1.0, 1.0, "p"), ("e", 1, 0.0, 180.5, 1.0, 1.0, "p")],
        events.EVENT_SCHEMA)
    got = {r.event_id: r for r in medallion.silver_events(raw).collect()}
    assert set(got) == {"a", "b"}
    assert got["a"].event_timestamp.microsecond == 123000
    assert str(got["a"].event_date) == "2024-01-01"
    assert got["a"].location_point == got["a"].location_geography == "POINT(20 10)"


def test_histogram_edges(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,)], "magnitude double")
    bins = dashboards.magnitude_histogram(df).collect()
    assert [(b.bin, b.event_count) for b in bins] == [(1, 1), (40, 1)]
    one = dashboards.magnitude_histogram(spark.createDataFrame([(3.0,)], "magnitude double"))
    assert [(b.bin, b.event_count) for b in one.collect()] == [(1, 1)]


def bronze(spark, docs):
    return spark.createDataFrame(
        [(n, n, t, None, None) for n, t in docs],
        "file_name string, file_path string, raw_content string, "
        "ingestion_timestamp timestamp, source_url string")


def test_chunk_table(spark):
    long = ("Same words here. " * 150).strip()
    rows = documents.silver_chunks(documents.silver_clean(
        bronze(spark, [("a", long), ("b", "x" * 100), ("c", "y" * 101)]))).collect()
    assert {r.file_name for r in rows} == {"a", "c"}  # longer than 100, strictly
    a = sorted((r for r in rows if r.file_name == "a"), key=lambda r: r.chunk_sequence)
    assert [r.chunk_sequence for r in a] == list(range(1, len(a) + 1))
    assert [(r.chunk_id, r.chunk_position) for r in a] == sorted(
        (r.chunk_id, r.chunk_position) for r in a)
    plan = documents.silver_chunks(documents.silver_clean(bronze(spark, [("a", long)])))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
    index = documents.index_rows(bronze(spark, [("a", long)])).collect()
    assert len({r.chunk_id for r in index}) == len(index) == len({r.chunk_id for r in a})


# ---------------------------------------------------------------- streaming

EVENTS = ("event_id string, event_time long, latitude double, longitude double, "
          "depth_km double, magnitude double, place string")
HOUR = 3_600_000


def land(spark, path, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(
        f"{path}/{name}")


def read_stream(spark, path, schema):
    return spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(path)


def test_stream_dedupe_and_late_data(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    day = 1704067200000

    def event(key, hours, x=1.0):
        return (key, day + int(hours * HOUR), 1.0, x, 1.0, 4.0, "p")

    polygons = spark.createDataFrame([("s", "POLYGON((0 0,2 0,2 2,0 2,0 0))")],
                                     "state_fips string, geometry string")

    def process():
        stream = monitor.clean_event_stream(read_stream(spark, source, EVENTS))
        counts = monitor.counts_by_polygon_day(stream, polygons, "geometry", "state_fips",
                                               watermark=None)
        monitor.run_available(counts, out, check, "update")
        return {str(r.event_day): r.event_count
                for r in monitor.latest_epoch(spark, out, ["state_fips", "event_day"]).collect()}

    land(spark, source, "1", [event("a", 1), event("b", 2), event("b", 2), event("far", 3, 9.0)],
         EVENTS)
    assert process() == {"2024-01-01": 2}
    land(spark, source, "2", [event("c", 30), event("a", 1)], EVENTS)
    process()
    land(spark, source, "3", [event("late", 1), event("d", 31)], EVENTS)  # day one is closed
    assert process() == {"2024-01-01": 2, "2024-01-02": 2}


def test_stream_index(spark, tmp_path):
    schema = ("file_name string, file_path string, raw_content string, "
              "ingestion_timestamp timestamp, source_url string")
    source, log, check = (str(tmp_path / n) for n in ("in", "log", "check"))
    docs = [("a", "First document text. " * 40), ("b", "Second one, shorter. " * 10)]

    def process():
        index_upkeep.upsert_stream(read_stream(spark, source, schema), log, check)
        return index_upkeep.current_index(spark, log)

    land(spark, source, "1", [(n, n, t, None, None) for n, t in docs], schema)
    first = process().count()
    land(spark, source, "2", [(n, n, t, None, None) for n, t in
                              [docs[0], ("c", "Third. " * 100)]], schema)
    index = process()
    want = documents.index_rows(bronze(spark, [*docs, ("c", "Third. " * 100)]))
    assert index.count() > first
    columns = ["chunk_id", "chunk_text", "chunk_position"]
    assert sorted(map(tuple, index.select(*columns).collect())) == sorted(
        map(tuple, want.select(*columns).collect()))
    snapshot = index_upkeep.compact_index(spark, log, str(tmp_path / "snapshot"))
    assert snapshot.count() == index.count()


def test_bad_query_vectors(spark):
    from strataseek.operators.vector_search import exact_top_k
    corpus = spark.createDataFrame([("a", [1.0])], "chunk_id string, embedding array<double>")
    mixed = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])],
                                  "query_id long, query_vector array<double>")
    with pytest.raises(ValueError):
        exact_top_k(corpus, mixed)
