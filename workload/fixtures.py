"""Pipeline inputs derived from the given tables by formula (see FIXTURES.md).

No given table holds events with coordinates, polygons or papers, so each input is
computed from a whole given table. The same formulas are written in SQL in
``workload/oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataseek.session import spread_rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ingested_at():
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


# ---------------------------------------------------------------- events

def event_rows(events: DataFrame, *keep) -> DataFrame:
    """Earthquake-like rows; a batch table or a stream of ``events``. ``keep`` adds
    further columns of ``events``."""
    i = F.col("event_id")
    base = events.select(
        F.when(i % 103 != 0, F.concat(F.lit("ev"), i.cast("string"))).alias("event_id"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("event_time"),
        F.when(i % 97 == 0, F.lit(95.0)).otherwise(
            ((i * 104729) % 2600).cast("double") / 100.0 + 24.0 + 0.005).alias("latitude"),
        F.when(i % 101 != 0,
               ((i * 7919) % 5900).cast("double") / 100.0 - 125.0 + 0.005).alias("longitude"),
        F.when(i % 13 != 0, F.col("value")).alias("depth_km"),
        (F.lit(2.5) + ((i * 31) % 50).cast("double") / 8.0).alias("magnitude"),
        F.concat("event_type", F.lit(" near "), F.col("user_id").cast("string")).alias("place"),
        F.when(i % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        .alias("versions"), *keep)
    return base.withColumn("version", F.explode("versions")).select(
        "event_id", (F.col("event_time") + F.col("version")).alias("event_time"), "latitude",
        "longitude", "depth_km", "magnitude", "place", *base.columns[8:])


def earthquakes_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_rows(table(spark, sf_dir, "events"))


# ---------------------------------------------------------------- polygons

def _ring(x0, y0, corners):
    """Closed ring text through ``corners`` relative to (x0, y0)."""
    points = [F.concat((x0 + x).cast("string"), F.lit(" "), (y0 + y).cast("string"))
              for x, y in [*corners, corners[0]]]
    return F.concat(F.lit("("), F.concat_ws(", ", *points), F.lit(")"))


def _box(x, y, w, h):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]


def states_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One polygon per nation in a 5 x 5 grid of 12 x 5 cells, four shapes in turn; one
    malformed text and one far-away polygon."""
    k = F.col("n_nationkey")
    x0 = F.lit(-125.0) + 12.0 * (k % 5)
    y0 = F.lit(24.0) + 5.0 * F.floor(k / 5)
    full = F.concat(F.lit("POLYGON ("), _ring(x0, y0, _box(0.0, 0.0, 12.0, 5.0)), F.lit(")"))
    bent = F.concat(F.lit("POLYGON ("), _ring(x0, y0, [
        (0.0, 0.0), (12.0, 0.0), (12.0, 2.5), (6.0, 2.5), (6.0, 5.0), (0.0, 5.0)]), F.lit(")"))
    holed = F.concat(F.lit("POLYGON ("), _ring(x0, y0, _box(0.0, 0.0, 12.0, 5.0)), F.lit(", "),
                     _ring(x0, y0, _box(4.0, 1.5, 4.0, 2.0)), F.lit(")"))
    parts = F.concat(F.lit("MULTIPOLYGON (("), _ring(x0, y0, _box(0.0, 0.0, 4.0, 5.0)),
                     F.lit("), ("), _ring(x0, y0, _box(8.0, 0.0, 4.0, 5.0)), F.lit("))"))
    shape = (F.when(k == 24, F.lit("POLYGON ((bad")).when(k % 4 == 0, full)
             .when(k % 4 == 1, bent).when(k % 4 == 2, holed).otherwise(parts))
    nations = table(spark, sf_dir, "nation").select(
        F.lpad(k.cast("string"), 2, "0").alias("state_fips"),
        F.concat(F.lit("S"), k.cast("string")).alias("state_code"),
        F.col("n_name").alias("state_name"), shape.alias("geometry_wkt"))
    far = spark.range(1).select(
        F.lit("98").alias("state_fips"), F.lit("SX").alias("state_code"),
        F.lit("FAR").alias("state_name"),
        F.lit("POLYGON ((100.0 -50.0, 101.0 -50.0, 101.0 -49.0, 100.0 -49.0, 100.0 -50.0))")
        .alias("geometry_wkt"))
    return nations.unionByName(far)


def counties_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four quadrants per nation cell (names repeat) and one with an unknown state."""
    k = F.col("n_nationkey")
    quarter = table(spark, sf_dir, "nation").select(
        k, F.explode(F.sequence(F.lit(0), F.lit(3))).alias("q"))
    q = F.col("q")
    x0 = F.lit(-125.0) + 12.0 * (k % 5) + 6.0 * (q % 2)
    y0 = F.lit(24.0) + 5.0 * F.floor(k / 5) + 2.5 * F.floor(q / 2)
    rows = quarter.select(
        F.lpad(k.cast("string"), 2, "0").alias("state_fips"),
        F.concat(F.lit("County_"), (q % 3).cast("string")).alias("county_name"),
        F.concat(F.lit("POLYGON ("), _ring(x0, y0, _box(0.0, 0.0, 6.0, 2.5)), F.lit(")"))
        .alias("geometry_wkt"))
    stray = spark.range(1).select(
        F.lit("99").alias("state_fips"), F.lit("County_0").alias("county_name"),
        F.lit("POLYGON ((-120.0 30.0, -119.0 30.0, -119.0 31.0, -120.0 31.0, -120.0 30.0))")
        .alias("geometry_wkt"))
    return rows.unionByName(stray)


# ---------------------------------------------------------------- documents

def bronze_rows(documents: DataFrame) -> DataFrame:
    """Landed text papers; a batch table or a stream of ``documents``."""
    name = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return documents.select(
        name.alias("file_name"), F.concat(F.lit("papers/"), name).alias("file_path"),
        F.col("text").alias("raw_content"), ingested_at().alias("ingestion_timestamp"),
        F.col("source").alias("source_url"))


def bronze_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_rows(spread_rows(table(spark, sf_dir, "documents"), "doc_id"))


def query_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark passage as a query; its long words are the expected keywords."""
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query"),
        F.array_sort(F.array_distinct(F.filter(words, lambda w: F.length(w) > 7)))
        .alias("keywords"),
        F.concat(F.lit("cat_"), (F.col("item_id") % 5).cast("string")).alias("category"))


# ---------------------------------------------------------------- vectors

def vector_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.sha2(F.col("vec_id").cast("string"), 256).alias("chunk_id"),
        F.concat(F.lit("vec_"), F.col("vec_id").cast("string")).alias("file_name"),
        F.col("label"), F.col("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"))


def label_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query per label: the mean vector of the label, rounded to 6 decimals."""
    parts = table(spark, sf_dir, "embeddings").select(
        "label", F.posexplode("embedding").alias("d", "v"))
    means = parts.groupBy("label", "d").agg(F.round(F.avg("v"), 6).alias("m"))
    # 64 values per label, whatever the size of the table
    return (means.groupBy("label")
            .agg(F.array_sort(F.collect_list(F.struct("d", "m"))).alias("p"))
            .select(F.col("label").cast("long").alias("query_id"),
                    F.transform("p", lambda x: x["m"]).alias("query_vector")))


def upsert_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One upsert row or two per vector, by label: even labels update with the negated
    vector, odd labels insert a new key; label 0 sends its key twice, label 3 no key,
    label 7 a vector of length 3."""
    label, v = F.col("label"), F.col("vec_id")
    versions = F.when(label == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    key = (F.when(label == 3, F.lit(None).cast("string"))
           .when(label % 2 == 0, F.col("chunk_id"))
           .otherwise(F.sha2((v + 1000000).cast("string"), 256)))
    negated = F.transform("embedding", lambda x: -x)
    vector = (F.when(label == 7, F.slice("embedding", 1, 3))
              .when((label % 2 == 0) & (F.col("version") == 0), negated)
              .otherwise(F.col("embedding")))
    return (vector_rows(spark, sf_dir).withColumn("version", F.explode(versions))
            .select(key.alias("chunk_id"), "file_name", vector.alias("embedding"),
                    (v + F.col("version")).alias("position")))


# ---------------------------------------------------------------- benchmark runs

def bench_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search runs read from the event log: the user is the query, the value the latency,
    an error event a failed run. No clock is involved."""
    i = F.col("event_id")
    methods = F.array(F.lit("ANN"), F.lit("Full-Text"), F.lit("Hybrid"))
    good = F.col("event_type") != "error"
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("query_id"),
        F.concat(F.lit("cat_"), (F.col("user_id") % 5).cast("string")).alias("category"),
        F.get(methods, (i % 3).cast("int")).alias("method"),
        i.alias("iteration"), good.alias("success"),
        (F.lit(10.0) + F.col("value")).alias("latency_ms"),
        F.when(good, F.get_json_object("props", "$.k").cast("int") % 11).otherwise(0)
        .alias("num_results"))
