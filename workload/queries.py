"""Every registered query: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import date

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataseek.functions import geo, text, wkb
from strataseek.functions.sql import register_sql_functions
from strataseek.operators import index_table, quantiser
from strataseek.operators.embed import embed_hashing, embed_with_model, extract_with
from strataseek.operators.fulltext import bm25_top_k, document_frequency, normalise_scores
from strataseek.operators.nearest_polygons import nearest_polygons
from strataseek.operators.segment_index import create_index, open_index
from strataseek.operators.spatial_join import (points_per_polygon, polygon_intersects_join,
                                               polygon_left_join, with_polygon_id,
                                               within_distance_join)
from strataseek.operators.vector_search import (assign_cells, exact_top_k, ivf_top_k, lsh_top_k,
                                                recall_at_k, with_buckets)
from strataseek.plans import dashboards, documents, medallion, searchbench
from strataseek.plans.retrieval import SearchIndex, embed_queries, search, search_all_methods
from strataseek.session import ship_package, work_path
from strataseek.sinks import tables as sinks
from strataseek.sources import boundaries, events as event_source, files, papers
from strataseek.streaming import index_upkeep, monitor
from workload import fixtures as fx
from workload import landing

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

SEARCH_K = 10
# Rows of a cell of the stored indexes, on average.
CELL_ROWS = 100
RADIUS_M = 150_000.0


def query(function: Query) -> Query:
    """Register a query under its function name (without a closing underscore)."""
    @functools.wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        ship_package(spark)
        return function(spark, sf_dir)

    _QUERIES[function.__name__.rstrip("_")] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def rounded(x: Column, digits: int) -> Column:
    """Half away from zero on the double itself, as SQL engines round a double; the built-in
    function rounds its shortest decimal text."""
    scaled = F.abs(x) * F.lit(10.0 ** digits)
    whole = F.signum(x) * F.floor(scaled + 0.5).cast("double") / F.lit(10.0 ** digits)
    return F.when(scaled < 9e15, whole).otherwise(x)


def flat(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Plain output types: bigint, double (rounded to ``digits``), text for dates and
    vectors."""
    columns: list[Column] = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)) and digits is not None:
            c = rounded(c.cast("double"), digits) + F.lit(0.0)
        elif isinstance(f.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.ArrayType) and isinstance(
                f.dataType.elementType, (T.DoubleType, T.FloatType)):
            c = vector_text(c)
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, "|")
        columns.append(c.alias(f.name))
    return df.select(*columns)


def vector_text(vector: Column) -> Column:
    return F.array_join(F.transform(vector, lambda v: F.format_string("%.5f", v + 0.0)), ",")


# ---------------------------------------------------------------- shared inputs

def silver_events_table(spark, sf_dir):
    return landing.shared(spark, sf_dir, "silver-events", lambda: medallion.silver_events(
        fx.earthquakes_raw(spark, sf_dir)))


def silver_states_table(spark, sf_dir):
    return landing.shared(spark, sf_dir, "silver-states", lambda: medallion.silver_states(
        fx.states_raw(spark, sf_dir)))


def silver_counties_table(spark, sf_dir):
    return landing.shared(spark, sf_dir, "silver-counties", lambda: medallion.silver_counties(
        fx.counties_raw(spark, sf_dir)))


def chunk_rows(spark, sf_dir):
    return documents.silver_chunks(documents.silver_clean(fx.bronze_papers(spark, sf_dir)))


def search_rows(spark, sf_dir):
    return landing.shared(spark, sf_dir, "search-index",
                          lambda: documents.index_rows(fx.bronze_papers(spark, sf_dir)))


def search_index(spark, sf_dir) -> SearchIndex:
    rows = search_rows(spark, sf_dir)
    lexicon = landing.shared(spark, sf_dir, "lexicon", lambda: document_frequency(rows))
    return SearchIndex(rows, lexicon)


def stored_search_index(spark, sf_dir):
    """The search index as files, in cells of a quantiser trained from its rows."""
    def write(path):
        rows = search_rows(spark, sf_dir)  # the index counts its own terms
        create_index(rows, path, quantiser.train(rows, CELL_ROWS))

    return open_index(spark, landing.landed(spark, sf_dir, "stored-index", write))


def vector_index(spark, sf_dir):
    """An index of the vectors alone; each caller works on a clone of its own."""
    def write(path):
        rows = fx.vector_rows(spark, sf_dir).select("chunk_id", "file_name", "embedding")
        create_index(rows, path, quantiser.train(rows, CELL_ROWS))

    base = open_index(spark, landing.landed(spark, sf_dir, "vector-index", write))
    return base.clone(work_path(spark, "vector-index-clone"))


def upserted_index(spark, sf_dir):
    """An index of the vectors after the upsert batch, and what the upsert reported."""
    stored = vector_index(spark, sf_dir)
    report, failed = stored.upsert(fx.upsert_batch(spark, sf_dir), position="position",
                                   stamp=F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return stored, report, failed


def search_queries(spark, sf_dir):
    return embed_queries(fx.query_set(spark, sf_dir))


def search_results(spark, sf_dir):
    return landing.shared(spark, sf_dir, "search-results", lambda: search_all_methods(
        search_index(spark, sf_dir), search_queries(spark, sf_dir), SEARCH_K))


def run_averages(spark, sf_dir):
    return searchbench.latency_per_query(fx.bench_runs(spark, sf_dir))


def run_queries(spark, sf_dir):
    return fx.bench_runs(spark, sf_dir).select("query_id", "category")


# ---------------------------------------------------------------- sources

@query
def src_geojson_features(spark, sf_dir):
    return flat(event_source.read_geojson_events(
        spark, landing.event_geojson(spark, sf_dir), multi_line=False))


@query
def src_boundary_wkt(spark, sf_dir):
    names = {"STATEFP": "state_fips", "STUSPS": "state_code", "NAME": "state_name"}
    shapes = boundaries.read_geojson_boundaries(
        spark, landing.state_geojson(spark, sf_dir), names, multi_line=False)
    lines = boundaries.read_wkt_boundaries(
        spark, landing.state_wkt(spark, sf_dir), names, geometry="WKT")
    both = shapes.withColumn("format", F.lit("geojson")).unionByName(
        lines.withColumn("format", F.lit("wkt")))
    return both.select("format", "state_fips", "state_code", "state_name",
                       geo.rings_wkt(geo.st_rings("geometry_wkt")).alias("geometry"))


def _landed_name(path: str) -> Column:
    return F.regexp_extract(path, r"file_name=([^/]*)\.txt$", 1).alias("file_name")


@query
def src_binary_files(spark, sf_dir):
    found = files.read_binary_files(spark, landing.paper_files(spark, sf_dir), "*.txt")
    return found.select(
        _landed_name("path"),
        F.col("length").alias("size_bytes"), F.sha2("content", 256).alias("content_hash"))


@query
def src_file_inventory(spark, sf_dir):
    found = files.file_inventory(spark, landing.paper_files(spark, sf_dir), (".txt", ".html"))
    return found.select(
        _landed_name("file_path"),
        "size_bytes", "size_mb")


@query
def src_wholetext(spark, sf_dir):
    read = files.read_whole_text(spark, landing.paper_files(spark, sf_dir))
    return read.select(
        _landed_name("file_path"),
        F.regexp_replace("raw_content", r"\n\z", "").alias("raw_content"))


def _papers(spark, sf_dir):
    return papers.read_paper_json(spark, landing.paper_responses(spark, sf_dir),
                                  multi_line=False)


@query
def src_paper_json(spark, sf_dir):
    return _papers(spark, sf_dir)


@query
def paper_render_text(spark, sf_dir):
    return papers.render_paper(_papers(spark, sf_dir)).select("query", "paper_id", "content")


@query
def extract_abstract(spark, sf_dir):
    rendered = papers.render_paper(_papers(spark, sf_dir))
    return rendered.select("query", "paper_id",
                           papers.extract_abstract("content").alias("abstract"))


@query
def extract_model_hook(spark, sf_dir):
    """The abstracts again, through the hook for a text-to-text model (Y4)."""
    def load_model():
        def model(contents):
            parts = (c.partition("\nABSTRACT:\n")[2].rpartition("\n\n---\n")[0] for c in contents)
            return list(parts)
        return model

    rendered = papers.render_paper(_papers(spark, sf_dir))
    return extract_with(rendered, load_model, "content", "abstract").select("query", "paper_id", "abstract")


@query
def ingest_summary(spark, sf_dir):
    summary = papers.ingest_summary(_papers(spark, sf_dir), "20240101_000000")
    return summary.select("query", "timestamp", "total_available", "papers_downloaded",
                          F.inline("papers"))


@query
def src_atom_xml(spark, sf_dir):
    return papers.read_atom_entries(spark, landing.atom_feed(spark, sf_dir))


@query
def scalar_safe_name(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "pages")
    return pages.select("page_id", text.safe_id("url").alias("safe_id"),
                        text.safe_title("url").alias("safe_title"))


@query
def ingest_time_filter(spark, sf_dir):
    recent = event_source.recent_events_filter(
        fx.earthquakes_raw(spark, sf_dir), date(2024, 1, 25), days_back=10, min_magnitude=4.0)
    return recent.select("event_id", "event_time", "magnitude")


@query
def json_path_elements(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents")

    def element(kind, content):
        return F.struct(F.lit(kind).alias("type"), content.alias("content"))

    parsed = F.to_json(F.struct(F.struct(F.array(
        element("title", F.col("source")), element("text", F.col("text"))).alias("elements"))
        .alias("document")))
    options = F.create_map(F.lit("version"), F.lit("2.0"))
    rows = docs.select("doc_id", parsed.alias("raw_content"), options.alias("options"))
    return (rows.select("doc_id", F.col("options")["version"].alias("version"),
                        F.posexplode(papers.document_elements("raw_content"))
                        .alias("position", "e"))
            .select("doc_id", "version", F.col("position").cast("bigint").alias("position"),
                    F.col("e.type").alias("type"), F.col("e.content").alias("content")))


# ---------------------------------------------------------------- sinks

@query
def sink_roundtrip(spark, sf_dir):
    path = work_path(spark, "table")
    name = "sink_roundtrip_events"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    sinks.create_table(spark, name, event_source.EVENT_SCHEMA, path)
    sinks.create_table(spark, name, event_source.EVENT_SCHEMA, path)  # kept: it exists
    fx.earthquakes_raw(spark, sf_dir).write.mode("overwrite").insertInto(name)
    return spark.table(name)


@query
def sink_partitioned_events(spark, sf_dir):
    path = work_path(spark, "silver-events")
    sinks.write_parquet(silver_events_table(spark, sf_dir), path, partition_by="event_date")
    back = spark.read.parquet(path)
    return flat(back.groupBy("event_date").agg(F.count(F.lit(1)).alias("n"),
                                               F.sum("magnitude").alias("total")))


@query
def sink_save_table(spark, sf_dir):
    """Gold metrics written as a table of a namespace, replaced once, and read back."""
    sinks.ensure_namespace(spark, "gold_layer")
    gold = flat(gold_by_state(spark, sf_dir).select("state_fips", "earthquake_count", "avg_magnitude"))
    path = work_path(spark, "gold-table")
    name = "gold_layer.by_state_" + path.rsplit("-", 1)[-1]
    sinks.save_table(gold, name, path)
    sinks.save_table(gold, name, path)
    return spark.table(name)


@query
def iso_stamps(spark, sf_dir):
    return silver_events_table(spark, sf_dir).select(
        "event_id", text.iso_text("event_timestamp").alias("iso"),
        text.run_stamp("event_timestamp").alias("stamp"))


@query
def embed_model_hook(spark, sf_dir):
    """A deterministic model: length, words and commas; it fails on texts with a digit."""
    def load():
        def model(texts):
            if any(c.isdigit() for t in texts for c in t):
                raise ValueError("digit")
            return [[float(len(t)), float(t.count(" ")), float(t.count(","))] for t in texts]

        return model

    rows = silver_clean(spark, sf_dir).select("file_name", "cleaned_content")
    made = embed_with_model(rows, load, 3, "cleaned_content", batch_texts=1)
    return made.select("file_name", F.col("embedding")[0].alias("a"), F.col("embedding")[1].alias("b"),
                       F.col("embedding")[2].alias("c"), "embedding_ok")


@query
def search_columns(spark, sf_dir):
    """Full-text search that ignores a vector and returns the columns asked for."""
    found = search(search_index(spark, sf_dir), search_queries(spark, sf_dir), "FULL_TEXT", SEARCH_K,
                   columns=("file_name",))
    return flat(found.select("query_id", "chunk_id", "rank", "file_name"))


@query
def sql_functions(spark, sf_dir):
    """The SQL functions on every event and the text of its own polygon."""
    register_sql_functions(spark)
    _own_cell(spark, sf_dir).createOrReplaceTempView("own_cell_events")
    return spark.sql("""
        SELECT event_id, st_contains(geometry_wkt, st_point(longitude, latitude)) AS contained,
               round(st_distance(st_point(longitude, latitude), st_centroid(geometry_wkt)), 6) AS distance
        FROM own_cell_events""")


@query
def index_failed_keys(spark, sf_dir):
    return upserted_index(spark, sf_dir)[2]


@query
def sink_merge_schema(spark, sf_dir):
    path = work_path(spark, "merged")
    states = silver_states_table(spark, sf_dir)
    sinks.write_parquet(states.select("state_fips", "state_name"), f"{path}/version=1")
    sinks.write_parquet(states.select("state_fips", "state_name", "geometry"),
                        f"{path}/version=2")
    return flat(sinks.read_merged(spark, path))


@query
def change_feed_diff(spark, sf_dir):
    before = fx.vector_rows(spark, sf_dir).select("chunk_id", "file_name", "embedding")
    after = index_table.upsert(before, fx.upsert_batch(spark, sf_dir), 64, position="position")
    kept = after.join(fx.vector_rows(spark, sf_dir).filter("label = 1").select("chunk_id"),
                      "chunk_id", "left_anti")
    return index_table.change_feed(before, kept).select("chunk_id", "change_type")


# ---------------------------------------------------------------- silver and gold

@query
def silver_events(spark, sf_dir):
    return flat(medallion.silver_events(fx.earthquakes_raw(spark, sf_dir)))


@query
def silver_states(spark, sf_dir):
    return flat(medallion.silver_states(fx.states_raw(spark, sf_dir)), 6)


@query
def silver_counties(spark, sf_dir):
    return flat(medallion.silver_counties(fx.counties_raw(spark, sf_dir)), 6)


@query
def spatial_left_join_state(spark, sf_dir):
    points = silver_events_table(spark, sf_dir).select("event_id", "longitude", "latitude")
    joined = polygon_left_join(points, silver_states_table(spark, sf_dir), "geometry",
                               ["state_fips", "state_name"])
    return joined.select("state_fips", "state_name", "event_id")


@query
def spatial_inner_join_state(spark, sf_dir):
    return points_per_polygon(
        silver_events_table(spark, sf_dir).select("event_id", "longitude", "latitude"),
        silver_states_table(spark, sf_dir), "geometry", ["state_name"],
        [F.count("event_id").alias("earthquake_count")], inner=True)


@query
def county_state_lookup(spark, sf_dir):
    return flat(medallion.county_state_lookup(
        silver_counties_table(spark, sf_dir), silver_states_table(spark, sf_dir)), 6)


@query
def gold_by_state(spark, sf_dir):
    return flat(medallion.gold_by_state(silver_states_table(spark, sf_dir),
                                        silver_events_table(spark, sf_dir)), 6)


@query
def gold_by_county(spark, sf_dir):
    return flat(medallion.gold_by_county(
        silver_counties_table(spark, sf_dir), silver_states_table(spark, sf_dir),
        silver_events_table(spark, sf_dir)), 6)


@query
def spatial_within_distance(spark, sf_dir):
    near = within_distance_join(
        silver_events_table(spark, sf_dir).select("event_id", "longitude", "latitude"),
        silver_states_table(spark, sf_dir), RADIUS_M, ["state_fips"])
    return near.select("event_id", "state_fips", F.round("distance_m", 3).alias("distance_m"))


# ---------------------------------------------------------------- dashboards

def _gold(spark, sf_dir):
    return medallion.gold_by_state(silver_states_table(spark, sf_dir),
                                   silver_events_table(spark, sf_dir))


@query
def top10_states(spark, sf_dir):
    return medallion.top_states_by_name(silver_states_table(spark, sf_dir),
                                        silver_events_table(spark, sf_dir), 10)


@query
def top15_states(spark, sf_dir):
    return flat(dashboards.top_regions(_gold(spark, sf_dir), 15).select(
        "state_fips", "state_name", "earthquake_count"))


@query
def recent_events(spark, sf_dir):
    return flat(dashboards.recent_events(silver_events_table(spark, sf_dir)).select(
        "event_id", "event_timestamp", "magnitude", "place"))


@query
def daily_series(spark, sf_dir):
    return flat(dashboards.daily_series(silver_events_table(spark, sf_dir)))


@query
def magnitude_histogram(spark, sf_dir):
    return flat(dashboards.magnitude_histogram(silver_events_table(spark, sf_dir)), 6)


@query
def kpi_overview(spark, sf_dir):
    return dashboards.kpi_overview(silver_events_table(spark, sf_dir))


@query
def viz_point_map(spark, sf_dir):
    return flat(dashboards.point_map(silver_events_table(spark, sf_dir)))


@query
def viz_state_choropleth(spark, sf_dir):
    return flat(dashboards.choropleth(_gold(spark, sf_dir)), 6)


@query
def viz_county_choropleth(spark, sf_dir):
    return flat(dashboards.choropleth(medallion.gold_by_county(
        silver_counties_table(spark, sf_dir), silver_states_table(spark, sf_dir),
        silver_events_table(spark, sf_dir))), 6)


@query
def stage_row_counts(spark, sf_dir):
    base = work_path(spark, "stages")
    counts = []

    def stage(name, df):
        counts.append((name, sinks.write_parquet(df, f"{base}/{name}")))
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")

    raw = stage("bronze_events", fx.earthquakes_raw(spark, sf_dir))
    stage("silver_events", medallion.silver_events(raw))
    stage("silver_states", silver_states_table(spark, sf_dir))
    stage("silver_counties", silver_counties_table(spark, sf_dir))
    stage("silver_chunks", chunk_rows(spark, sf_dir).select("chunk_id"))
    return spark.createDataFrame(counts, "stage string, row_count bigint")


@query
def sample_rows(spark, sf_dir):
    point = geo.st_point("longitude", "latitude")
    rows = dashboards.sample_rows(silver_events_table(spark, sf_dir), "event_id", 5)
    return flat(rows.select("event_id", "event_date", "location_point",
                            F.typeof(point).alias("point_type")))


# ---------------------------------------------------------------- geometry functions

@query
def geo_point_wkt(spark, sf_dir):
    raw = fx.earthquakes_raw(spark, sf_dir)
    point = geo.st_point("longitude", "latitude")
    return raw.select("event_id", "event_time",
                      geo.let(point, lambda p: geo.point_wkt(p["x"], p["y"])).alias("wkt"))


@query
def geo_geography_point(spark, sf_dir):
    raw = fx.earthquakes_raw(spark, sf_dir)
    made = F.concat(F.lit("POINT("), "longitude", F.lit(" "), "latitude", F.lit(")"))
    geography = geo.st_geography_from_text(made)
    return raw.select("event_id", "event_time", geography["x"].alias("lon"),
                      geography["y"].alias("lat"))


@query
def geo_wkt_edges(spark, sf_dir):
    states = fx.states_raw(spark, sf_dir)
    return (states.select("state_fips", F.posexplode(geo.st_edges(geo.st_rings("geometry_wkt")))
                          .alias("n", "e"))
            .select("state_fips", F.col("e.x1").alias("x1"), F.col("e.y1").alias("y1"),
                    F.col("e.x2").alias("x2"), F.col("e.y2").alias("y2")))


@query
def geo_try_parse(spark, sf_dir):
    rings = geo.st_rings("geometry_wkt")
    return flat(fx.states_raw(spark, sf_dir).select(
        "state_fips", rings.isNotNull().alias("valid"), F.size(rings).alias("rings")))


@query
def geo_polygon_normalize(spark, sf_dir):
    both = fx.states_raw(spark, sf_dir).select("state_fips", "geometry_wkt").unionByName(
        fx.counties_raw(spark, sf_dir).select("state_fips", "geometry_wkt"))
    return both.select("state_fips",
                       geo.rings_wkt(geo.st_rings("geometry_wkt")).alias("geometry"))


def _own_cell(spark, sf_dir):
    """Every event with the polygon of its own grid cell, an equi-join on the cell; events
    outside the grid have no polygon."""
    column, row = F.floor((F.col("longitude") + 125) / 12), F.floor((F.col("latitude") - 24) / 5)
    inside = (column >= 0) & (column < 5) & (row >= 0)
    events = (silver_events_table(spark, sf_dir).select("event_id", "longitude", "latitude")
              .withColumn("cell", F.when(inside, F.lpad((column + 5 * row).cast("string"), 2, "0"))))
    states = fx.states_raw(spark, sf_dir).select("state_fips", "geometry_wkt")
    return events.join(states, events["cell"] == states["state_fips"], "left").withColumn(
        "point", geo.st_point("longitude", "latitude"))


@query
def geo_contains(spark, sf_dir):
    return _own_cell(spark, sf_dir).select(
        "event_id", "state_fips", geo.st_contains("geometry_wkt", "point").alias("contained"))


@query
def geo_within(spark, sf_dir):
    return _own_cell(spark, sf_dir).select(
        "event_id", "state_fips", geo.st_within("point", "geometry_wkt").alias("is_within"))


@query
def geo_intersects(spark, sf_dir):
    """Counties that touch or overlap a state polygon."""
    keyed = with_polygon_id(fx.counties_raw(spark, sf_dir),
                            ["state_fips", "county_name", "geometry_wkt"])
    pairs = polygon_intersects_join(
        keyed.select("polygon_id", "geometry_wkt"),
        fx.states_raw(spark, sf_dir), "geometry_wkt", "geometry_wkt", "polygon_id",
        "state_fips")
    counties = keyed.select("polygon_id", F.col("state_fips").alias("county_fips"),
                            "county_name", geo.rings_wkt(geo.st_rings("geometry_wkt"))
                            .alias("county_geometry"))
    return pairs.join(counties, "polygon_id").drop("polygon_id")


def _centroids(spark, sf_dir):
    return (fx.states_raw(spark, sf_dir)
            .withColumn("centroid", geo.st_centroid("geometry_wkt"))
            .select("state_fips", "centroid"))


def _event_centroid(spark, sf_dir):
    events = _own_cell(spark, sf_dir).select("event_id", "state_fips", "point")
    return events.join(_centroids(spark, sf_dir), "state_fips", "left")


@query
def geo_distance_planar(spark, sf_dir):
    return _event_centroid(spark, sf_dir).select("event_id", F.round(
        geo.st_distance_planar("point", "centroid"), 6).alias("distance"))


@query
def geo_distance_polygon(spark, sf_dir):
    """Distance of every event from the state of its grid cell, which need not hold it."""
    states = fx.states_raw(spark, sf_dir).select("state_fips", "geometry_wkt")
    events = _own_cell(spark, sf_dir).select("event_id", "state_fips", "point").join(states, "state_fips")
    return events.select("event_id", F.round(geo.st_distance_polygon("geometry_wkt", "point"), 6).alias("distance"))


@query
def nearest_states(spark, sf_dir):
    """The three states nearest to every event."""
    found = nearest_polygons(silver_events_table(spark, sf_dir), fx.states_raw(spark, sf_dir), 3, "event_id", "state_fips")
    return flat(found, 6)


@query
def geo_distance_sphere(spark, sf_dir):
    return _event_centroid(spark, sf_dir).select("event_id", F.round(
        geo.st_distance_sphere("point", "centroid"), 3).alias("distance_m"))


@query
def geo_centroid(spark, sf_dir):
    return flat(_centroids(spark, sf_dir).select(
        "state_fips", geo.st_x("centroid").alias("x"), geo.st_y("centroid").alias("y")), 6)


@query
def geo_area(spark, sf_dir):
    return flat(fx.states_raw(spark, sf_dir).select(
        "state_fips", geo.st_area("geometry_wkt").alias("area")), 6)


@query
def geo_buffer_ngon(spark, sf_dir):
    zone = geo.st_buffer(geo.st_point("longitude", "latitude"), 0.25, sides=8, digits=4)
    ring = geo.st_rings(zone)
    rows = silver_events_table(spark, sf_dir).select(
        "event_id", F.posexplode(F.get(ring, F.lit(0))["points"]).alias("corner", "p"))
    return flat(rows.select("event_id", "corner", F.col("p.x").alias("x"),
                            F.col("p.y").alias("y")), 4)


@query
def geo_wkb_roundtrip(spark, sf_dir):
    points = silver_events_table(spark, sf_dir).select(
        F.col("event_id").alias("id"), wkb.point_wkb("longitude", "latitude").alias("wkb"))
    points = points.select("id", F.length("wkb").alias("wkb_bytes"),
                           wkb.point_from_wkb("wkb").alias("p")) \
        .select("id", "wkb_bytes", geo.point_wkt("p.x", "p.y").alias("wkt"))
    shapes = fx.states_raw(spark, sf_dir).select(
        F.col("state_fips").alias("id"), wkb.wkt_to_wkb("geometry_wkt").alias("wkb"))
    shapes = shapes.select("id", F.length("wkb").alias("wkb_bytes"),
                           wkb.wkb_to_wkt("wkb").alias("wkt"))
    return flat(points.unionByName(shapes))


# ---------------------------------------------------------------- text

@query
def bronze_papers(spark, sf_dir):
    landed = fx.bronze_papers(spark, sf_dir)
    return flat(documents.bronze_papers(landed, F.col("source_url"), F.col("ingestion_timestamp")))


@query
def silver_clean(spark, sf_dir):
    return flat(documents.silver_clean(fx.bronze_papers(spark, sf_dir)))


@query
def silver_chunks(spark, sf_dir):
    return flat(chunk_rows(spark, sf_dir))


@query
def chunk_stats(spark, sf_dir):
    return flat(documents.chunk_stats(chunk_rows(spark, sf_dir)), 6)


# ---------------------------------------------------------------- vectors and index

@query
def embed_hashing_(spark, sf_dir):
    rows = embed_hashing(fx.bronze_papers(spark, sf_dir).select("file_name", "raw_content"),
                         text="raw_content")
    return flat(rows.select("file_name", "embedding_ok", "embedding"))


@query
def silver_embeddings(spark, sf_dir):
    return flat(documents.silver_embeddings(chunk_rows(spark, sf_dir), fx.ingested_at()))


@query
def index_build(spark, sf_dir):
    rows = stored_search_index(spark, sf_dir).rows
    return flat(rows.select("chunk_id", "file_name", "chunk_position", "chunk_length",
                            F.size("tokens").alias("token_count")))


@query
def index_describe(spark, sf_dir):
    rows = documents.silver_embeddings(chunk_rows(spark, sf_dir), fx.ingested_at())
    return flat(index_table.describe_index(rows))


@query
def index_upsert(spark, sf_dir):
    stored, _, _ = upserted_index(spark, sf_dir)
    return flat(open_index(spark, stored.path).rows.select("chunk_id", "file_name", "embedding"))


@query
def index_upsert_stamps(spark, sf_dir):
    """ISO time of the upsert on the rows that it wrote; the others have none."""
    return upserted_index(spark, sf_dir)[0].rows.select("chunk_id", "updated_at")


@query
def index_upsert_report(spark, sf_dir):
    return upserted_index(spark, sf_dir)[1]


@query
def change_feed_log(spark, sf_dir):
    """The changes of ``change_feed_diff``, from what the upsert and a delete wrote to the change log."""
    stored, _, _ = upserted_index(spark, sf_dir)
    stored.delete(fx.vector_rows(spark, sf_dir).filter("label = 1").select("chunk_id"))
    return stored.net_changes(0).select("chunk_id", "change_type")


@query
def index_after_merge(spark, sf_dir):
    """The index after the upsert and a delete, with its small segments merged."""
    stored, _, _ = upserted_index(spark, sf_dir)
    stored.delete(fx.vector_rows(spark, sf_dir).filter("label = 1").select("chunk_id"))
    stored.merge(share=1.0)
    return flat(stored.rows.select("chunk_id", "file_name", "embedding"))


@query
def vector_topk_exact(spark, sf_dir):
    found = exact_top_k(fx.vector_rows(spark, sf_dir), fx.label_queries(spark, sf_dir),
                        SEARCH_K)
    return flat(found, 6)


@query
def vector_topk_dot(spark, sf_dir):
    found = exact_top_k(fx.vector_rows(spark, sf_dir), fx.label_queries(spark, sf_dir),
                        SEARCH_K, metric="dot")
    return flat(found, 6)


@query
def vector_topk_l2(spark, sf_dir):
    found = exact_top_k(fx.vector_rows(spark, sf_dir), fx.label_queries(spark, sf_dir),
                        SEARCH_K, metric="l2")
    return flat(found, 6)


@query
def vector_topk_l2_far(spark, sf_dir):
    def far(df, column):
        return df.withColumn(column, F.transform(column, lambda x: x * 1e5))

    found = exact_top_k(far(fx.vector_rows(spark, sf_dir), "embedding"),
                        far(fx.label_queries(spark, sf_dir), "query_vector"), SEARCH_K, metric="l2")
    return flat(found, 6)


def _ivf(spark, sf_dir, probes):
    """Cells around the label means: one short row per label."""
    queries = fx.label_queries(spark, sf_dir)
    centres = np.array([r.query_vector for r in queries.orderBy("query_id").collect()])
    rows = fx.vector_rows(spark, sf_dir).select("chunk_id", "embedding")
    return ivf_top_k(assign_cells(rows, centres), centres, queries, probes or len(centres), SEARCH_K)


@query
def vector_topk_ivf(spark, sf_dir):
    return flat(_ivf(spark, sf_dir, probes=4), 6)


@query
def vector_topk_ivf_all_cells(spark, sf_dir):
    return flat(_ivf(spark, sf_dir, probes=None), 6)


@query
def vector_topk_lsh(spark, sf_dir):
    rows = with_buckets(fx.vector_rows(spark, sf_dir).select("chunk_id", "embedding"), 64)
    return flat(lsh_top_k(rows, fx.label_queries(spark, sf_dir), SEARCH_K), 6)


@query
def ann_recall(spark, sf_dir):
    exact = exact_top_k(fx.vector_rows(spark, sf_dir), fx.label_queries(spark, sf_dir),
                        SEARCH_K)
    return flat(recall_at_k(_ivf(spark, sf_dir, probes=4), exact, SEARCH_K), 6)


@query
def lsh_recall(spark, sf_dir):
    exact = exact_top_k(fx.vector_rows(spark, sf_dir), fx.label_queries(spark, sf_dir), SEARCH_K)
    rows = with_buckets(fx.vector_rows(spark, sf_dir).select("chunk_id", "embedding"), 64)
    return flat(recall_at_k(lsh_top_k(rows, fx.label_queries(spark, sf_dir), SEARCH_K), exact, SEARCH_K), 6)


# ---------------------------------------------------------------- search

@query
def query_set(spark, sf_dir):
    return flat(fx.query_set(spark, sf_dir))


@query
def search_ann(spark, sf_dir):
    index = SearchIndex.of(stored_search_index(spark, sf_dir))
    found = search(index, search_queries(spark, sf_dir), "ANN", SEARCH_K)
    return flat(found, 6)


@query
def fulltext_bm25(spark, sf_dir):
    index = search_index(spark, sf_dir)
    return flat(bm25_top_k(index.rows, fx.query_set(spark, sf_dir), SEARCH_K,
                           lexicon=index.lexicon), 6)


@query
def fulltext_postings(spark, sf_dir):
    index = SearchIndex.of(stored_search_index(spark, sf_dir))
    found = search(index, search_queries(spark, sf_dir), "FULL_TEXT", SEARCH_K, columns=())
    return flat(found.select("query_id", "chunk_id", "score", "rank"), 6)


@query
def fulltext_normalized(spark, sf_dir):
    index = search_index(spark, sf_dir)
    return flat(normalise_scores(bm25_top_k(
        index.rows, fx.query_set(spark, sf_dir), SEARCH_K, lexicon=index.lexicon)), 6)


@query
def fulltext_with_vector(spark, sf_dir):
    """A full-text call that also carries a vector: the vector is ignored (V15)."""
    found = search(search_index(spark, sf_dir), search_queries(spark, sf_dir), "FULL_TEXT", SEARCH_K, columns=())
    return flat(found, 6)


@query
def hybrid_rrf(spark, sf_dir):
    found = search(search_index(spark, sf_dir), search_queries(spark, sf_dir), "HYBRID",
                   SEARCH_K, columns=())
    return flat(found, 6)


@query
def hybrid_rrf_deep(spark, sf_dir):
    found = search(search_index(spark, sf_dir), search_queries(spark, sf_dir), "HYBRID",
                   500, columns=())
    return flat(found.select("query_id", "chunk_id", "score", "rank"), 6)


@query
def search_all_methods_(spark, sf_dir):
    return flat(search_results(spark, sf_dir), 6)


# ---------------------------------------------------------------- benchmark analysis

@query
def bench_latency_per_query(spark, sf_dir):
    return flat(run_averages(spark, sf_dir), 6)


@query
def bench_latency_summary(spark, sf_dir):
    return flat(searchbench.latency_summary(run_averages(spark, sf_dir)), 6)


@query
def bench_score_summary(spark, sf_dir):
    return flat(searchbench.score_summary(search_results(spark, sf_dir)), 5)


@query
def bench_latency_pivot(spark, sf_dir):
    return flat(searchbench.latency_pivot(run_averages(spark, sf_dir)), 6)


@query
def bench_score_pivot(spark, sf_dir):
    return flat(searchbench.score_pivot(search_results(spark, sf_dir),
                                        fx.query_set(spark, sf_dir)), 5)


@query
def bench_box_stats(spark, sf_dir):
    latency = searchbench.box_stats(run_averages(spark, sf_dir), "avg_latency_ms", "latency")
    score = searchbench.box_stats(search_results(spark, sf_dir), "score", "score")
    return flat(latency.unionByName(score), 5)


@query
def bench_report(spark, sf_dir):
    return flat(searchbench.report(run_averages(spark, sf_dir), run_queries(spark, sf_dir)), 6)


def _overlap(spark, sf_dir):
    return searchbench.overlap(search_results(spark, sf_dir), fx.query_set(spark, sf_dir))


@query
def bench_overlap(spark, sf_dir):
    return flat(_overlap(spark, sf_dir))


@query
def bench_overlap_mean(spark, sf_dir):
    return flat(searchbench.overlap_mean(_overlap(spark, sf_dir)), 6)


@query
def bench_keyword_hit_rate(spark, sf_dir):
    return flat(searchbench.keyword_hit_rate(
        search_results(spark, sf_dir), fx.query_set(spark, sf_dir),
        search_index(spark, sf_dir).rows), 6)


@query
def bench_side_by_side(spark, sf_dir):
    hybrid = search(search_index(spark, sf_dir), search_queries(spark, sf_dir), "HYBRID",
                    SEARCH_K, columns=())
    return flat(searchbench.side_by_side(search_results(spark, sf_dir), hybrid), 6)


@query
def bench_results_json(spark, sf_dir):
    """The result lists as JSON, written with the JSON sink and read back."""
    path = work_path(spark, "results-json")
    results = search_results(spark, sf_dir)
    figures = results.join(fx.query_set(spark, sf_dir).select("query_id", "category"),
                           "query_id").groupBy("query_id", "method", "category").agg(
        F.lit(0.0).alias("avg_latency_ms"), F.count(F.lit(1)).alias("num_results"))
    sinks.write_json(searchbench.results_json(figures, results), path)
    back = spark.read.schema("query_id bigint, method string, json string").json(path)
    listed = F.from_json("json", "category string, num_results bigint, "
                                 "results array<struct<rank: bigint, chunk_id: string>>")
    return (back.withColumn("j", listed)
            .select("query_id", "method", F.col("j.category").alias("category"),
                    F.col("j.num_results").alias("num_results"),
                    F.array_join(F.transform("j.results", lambda r: r["chunk_id"]), "|")
                    .alias("chunk_ids")))


# ---------------------------------------------------------------- streaming

def _stream(spark, sf_dir, name):
    """A table as a stream, whether it is one file or a folder of part files; a stream takes a
    plain path for a folder, so the path is a pattern."""
    schema = fx.table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


@query
def stream_events_by_state_day(spark, sf_dir):
    out, checkpoint = work_path(spark, "state-day"), work_path(spark, "state-day-checkpoint")
    events = monitor.clean_event_stream(fx.event_rows(_stream(spark, sf_dir, "events")))
    counts = monitor.counts_by_polygon_day(events, silver_states_table(spark, sf_dir),
                                           "geometry", "state_fips", watermark=None)
    monitor.run_available(counts, out, checkpoint, "update")
    return flat(monitor.latest_epoch(spark, out, ["state_fips", "event_day"]))


@query
def stream_dedupe(spark, sf_dir):
    out, checkpoint = work_path(spark, "dedupe"), work_path(spark, "dedupe-checkpoint")
    events = monitor.clean_event_stream(fx.event_rows(_stream(spark, sf_dir, "events")))
    monitor.run_available(events.select("event_id", "longitude", "latitude", "magnitude"),
                          out, checkpoint)
    return spark.read.option("basePath", out).parquet(out).drop("epoch")


@query
def stream_index_upsert(spark, sf_dir):
    log, checkpoint = work_path(spark, "index-log"), work_path(spark, "index-checkpoint")
    index_upkeep.upsert_stream(fx.bronze_rows(_stream(spark, sf_dir, "documents")), log,
                               checkpoint)
    rows = index_upkeep.current_index(spark, log)
    return flat(rows.select("chunk_id", "file_name", "chunk_position", "chunk_length"))
