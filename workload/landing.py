"""Files and tables that queries read back: landed once per application, with Spark."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataseek.session import cut_lineage, work_path
from strataseek.sources.boundaries import wkt_to_geojson
from workload import fixtures as fx

_landed: dict[tuple[str, str, str], str] = {}
_tables: dict[tuple[str, str, str], DataFrame] = {}

# Features, papers and feed entries per landed file record.
PAGE_ROWS = 500
# Landed paper files of one folder, on average, and folders whose rows one task writes.
FOLDER_FILES, TASK_FOLDERS = 1000, 8


def landed(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Path of landed files, written on first use by this application."""
    at = (spark.sparkContext.applicationId, sf_dir, name)
    if at not in _landed:
        path = work_path(spark, name)
        write(path)
        _landed[at] = path
    return _landed[at]


def shared(spark: SparkSession, sf_dir: str, name: str,
           build: Callable[[], DataFrame]) -> DataFrame:
    """A table that several queries read, written on first use by this application."""
    at = (spark.sparkContext.applicationId, sf_dir, name)
    if at not in _tables:
        _tables[at] = cut_lineage(build(), name)
    return _tables[at]


def event_geojson(spark: SparkSession, sf_dir: str) -> str:
    """Events as feature collections of bounded size, one per line."""
    def write(path: str) -> None:
        feature = F.struct(
            F.lit("Feature").alias("type"),
            F.struct(F.col("event_time").alias("time"), F.col("magnitude").alias("mag"),
                     F.col("place")).alias("properties"),
            F.struct(F.lit("Point").alias("type"), F.when(
                F.col("depth_km").isNotNull(), F.array("longitude", "latitude", "depth_km"))
                .otherwise(F.array("longitude", "latitude")).alias("coordinates"))
            .alias("geometry"), F.col("event_id").alias("id"))
        page = F.floor(F.col("event_id") / PAGE_ROWS).alias("page")
        raw = fx.event_rows(fx.table(spark, sf_dir, "events"), page)
        pages = (raw.select("page", feature.alias("f"))
                 .groupBy("page").agg(F.collect_list("f").alias("features")))
        pages.select(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features"),
                               {"ignoreNullFields": "false"})).write.text(path)

    return landed(spark, sf_dir, "event-geojson", write)


def state_geojson(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        collection = F.concat(
            F.lit('{"type":"FeatureCollection","features":[{"type":"Feature","properties":'),
            F.to_json(F.struct(F.col("state_fips").alias("STATEFP"),
                               F.col("state_code").alias("STUSPS"),
                               F.col("state_name").alias("NAME"))),
            F.lit(',"geometry":'), F.when(F.col("geometry_wkt").endswith("))"),
                                          wkt_to_geojson("geometry_wkt")).otherwise("null"), F.lit("}]}"))
        fx.states_raw(spark, sf_dir).select(collection).write.text(path)

    return landed(spark, sf_dir, "state-geojson", write)


def state_wkt(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        (fx.states_raw(spark, sf_dir)
         .select(F.col("state_fips").alias("STATEFP"), F.col("state_code").alias("STUSPS"),
                 F.col("state_name").alias("NAME"), F.col("geometry_wkt").alias("WKT"))
         .write.option("header", True).option("sep", "\t").csv(path))

    return landed(spark, sf_dir, "state-wkt", write)


def paper_files(spark: SparkSession, sf_dir: str) -> str:
    """One text file per document, called ``file_name=<its name>.txt``.

    Files are written by the tasks that hold their rows, in folders of about ``FOLDER_FILES``, so
    listing them takes a task a folder, not a task a file. Rows of one name share a file.
    """
    def write(path: str) -> None:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        uri = target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toUri().toString()
        name = F.coalesce("file_name", F.lit("__HIVE_DEFAULT_PARTITION__"))
        docs = fx.bronze_papers(spark, sf_dir).select(name.alias("file_name"), "raw_content")
        folders = max(1, -(-docs.count() // FOLDER_FILES))
        folder = F.pmod(F.xxhash64("file_name"), F.lit(folders)).cast("int")
        # a fixed number of tasks: few bytes are many files, and adaptive execution counts bytes
        tasks = max(spark.sparkContext.defaultParallelism, -(-folders // TASK_FOLDERS))
        (docs.withColumn("folder", folder).repartition(tasks, "file_name")
         .sortWithinPartitions("file_name").mapInArrow(_write_files(uri), "files long").agg(F.sum("files")).collect())

    return landed(spark, sf_dir, "paper-files", write)


def _write_files(uri: str):
    """Write the rows of each name, which follow one another, as the lines of one file."""
    def run(batches):
        system, root = pa.fs.FileSystem.from_uri(uri)
        made, last, out, folders = 0, None, None, set()
        for batch in batches:
            names, texts, places = (batch.column(c).to_pylist() for c in ("file_name", "raw_content", "folder"))
            for name, text, place in zip(names, texts, places):
                if name != last:
                    if out is not None:
                        out.close()
                    if place not in folders:
                        system.create_dir(f"{root}/{place:06d}")
                        folders.add(place)
                    out = system.open_output_stream(f"{root}/{place:06d}/file_name={name}.txt")
                    made, last = made + 1, name
                out.write(((text or "") + "\n").encode())
        if out is not None:
            out.close()
        yield pa.RecordBatch.from_pydict({"files": [made]})

    return run


def paper_responses(spark: SparkSession, sf_dir: str) -> str:
    """Documents as search responses of PAGE_ROWS papers, some fields missing."""
    def write(path: str) -> None:
        i = F.col("doc_id")
        page = F.floor(i / PAGE_ROWS)
        paper = F.struct(
            i.alias("n"),
            F.when(i % 3 != 0, F.concat(F.lit("PMC"), i.cast("string"))).alias("pmcid"),
            F.when(i % 2 != 0, i.cast("string")).alias("pmid"),
            F.when(i % 5 != 0, F.concat(F.lit("Paper / "), F.col("source"), F.lit(" "),
                                        i.cast("string"))).alias("title"),
            F.when(i % 7 != 0, F.col("text")).alias("abstractText"),
            F.when(i % 4 != 0, F.concat(F.lit("Author "), i.cast("string")))
            .alias("authorString"),
            F.when(i % 6 != 0, F.col("source")).alias("journalTitle"),
            F.when(i % 8 != 0, F.lit("2024")).alias("pubYear"),
            F.when(i % 9 != 0, F.concat(F.lit("10.1/"), i.cast("string"))).alias("doi"))
        pages = (fx.table(spark, sf_dir, "documents").groupBy(page.alias("page"))
                 .agg(F.array_sort(F.collect_list(paper)).alias("result"),
                      F.count(F.lit(1)).alias("hitCount")))
        (pages.select("hitCount", F.concat(F.lit("query "), F.col("page").cast("string"))
                      .alias("query"), F.struct("result").alias("resultList"))
         .write.json(path))

    return landed(spark, sf_dir, "paper-responses", write)


def atom_feed(spark: SparkSession, sf_dir: str) -> str:
    """Pages as feed entries; every second one has a link titled pdf."""
    def write(path: str) -> None:
        i = F.col("page_id").cast("string")

        def link(title, href):
            return F.struct(title.alias("_title"), href.alias("_href"))

        page = link(F.lit(None).cast("string"), F.lit("http://papers.example/abs/"))
        pdf = link(F.lit("pdf"), F.concat(F.lit("http://papers.example/files/"), i,
                                          F.lit(".pdf")))
        entry = fx.table(spark, sf_dir, "pages").select(
            F.concat(F.lit("http://papers.example/abs/"), i, F.lit("v1")).alias("id"),
            F.concat(F.lit("  Page\n"), "url", F.lit("\n")).alias("title"),
            F.when(F.col("page_id") % 2 == 0, F.array(page, pdf)).otherwise(F.array(page))
            .alias("link"))
        (entry.write.format("xml").option("rootTag", "feed").option("rowTag", "entry")
         .save(path))

    return landed(spark, sf_dir, "atom-feed", write)
