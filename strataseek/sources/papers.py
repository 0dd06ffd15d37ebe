"""Paper metadata: search-response JSON, Atom feeds, text rendering, abstracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataseek.functions.text import preview, safe_id

_RESPONSE = """hitCount bigint, query string, resultList struct<result: array<struct<
    pmcid: string, pmid: string, title: string, abstractText: string, authorString: string,
    journalTitle: string, pubYear: string, doi: string>>>"""

# Fixed value: layout of a landed paper text file.
PAPER_TEMPLATE = ("PAPER ID: %s\nTITLE: %s\nAUTHORS: %s\nJOURNAL: %s\nYEAR: %s\nDOI: %s\n\n"
                  "ABSTRACT:\n%s\n\n---\nFull metadata available in JSON file.\n")


def read_paper_json(spark: SparkSession, *paths: str, max_papers: int | None = None,
                    multi_line: bool = True) -> DataFrame:
    """One row per paper of each search response, with defaults for missing fields.

    ``max_papers`` keeps the first papers of every response. Several paths (one per
    ingest query) are read as one table.
    """
    pages = (spark.read.schema(_RESPONSE).option("multiLine", multi_line).json(list(paths))
             .select("hitCount", "query", F.col("resultList.result").alias("papers")))
    if max_papers is not None:
        pages = pages.withColumn("papers", F.slice("papers", 1, max_papers))
    paper = pages.select("hitCount", "query", F.posexplode("papers").alias("i", "p"))

    def given(field: str, default: str) -> Column:
        return F.coalesce(F.col(f"p.{field}"), F.lit(default)).alias(field)

    number = F.concat(F.lit("paper_"), (F.col("i") + 1).cast("string"))
    return paper.select(
        F.coalesce("p.pmcid", "p.pmid", number).alias("paper_id"),
        given("title", "No title").alias("title"),
        given("abstractText", "").alias("abstract"),
        given("authorString", "Unknown").alias("authors"),
        given("journalTitle", "Unknown").alias("journal"),
        given("pubYear", "Unknown").alias("pub_year"),
        given("doi", "").alias("doi"),
        F.col("query"), F.col("hitCount").alias("hit_count"))


def render_paper(papers: DataFrame, out: str = "content") -> DataFrame:
    """Add the text form of a paper."""
    return papers.withColumn(out, F.format_string(
        PAPER_TEMPLATE, "paper_id", "title", "authors", "journal", "pub_year", "doi",
        "abstract"))


def extract_abstract(content: Column | str) -> Column:
    """The abstract section of a rendered paper; empty when there is none."""
    c = F.col(content) if isinstance(content, str) else content
    return F.regexp_extract(c, r"(?s)\nABSTRACT:\n(.*)\n\n---\n[^\n]*\n?$", 1)


def ingest_summary(papers: DataFrame, run_stamp: str) -> DataFrame:
    """One row per ingest query: totals and the list of saved records.

    The list belongs to one search response, whose size the service bounds.
    """
    record = F.struct(
        "paper_id", preview("title", 100).alias("title"),
        *[F.concat(F.lit("paper_"), safe_id("paper_id"), F.lit(f"_{run_stamp}.{kind}"))
          .alias(name) for name, kind in (("text_file", "txt"), ("json_file", "json"))])
    return papers.groupBy("query").agg(
        F.lit(run_stamp).alias("timestamp"),
        F.max("hit_count").alias("total_available"),
        F.count(F.lit(1)).alias("papers_downloaded"),
        F.array_sort(F.collect_list(record)).alias("papers"))


def read_atom_entries(spark: SparkSession, path: str, row_tag: str = "entry") -> DataFrame:
    """``paper_id, title, pdf_url`` per feed entry.

    The id is the part after the last ``/abs/``; the link titled ``pdf`` is used when
    there is one, else it is built from the id.
    """
    schema = "id string, title string, link array<struct<_title: string, _href: string>>"
    entry = spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)
    paper_id = F.element_at(F.split("id", "/abs/"), -1)
    listed = F.get(F.filter("link", lambda x: x["_title"] == "pdf"), F.lit(0))["_href"]
    base = F.element_at(F.split("id", "/abs/"), 1)
    return entry.select(
        paper_id.alias("paper_id"),
        F.replace(F.btrim("title", F.lit(" \n\t")), F.lit("\n"), F.lit(" "))
        .alias("title"),
        F.coalesce(listed, F.concat(base, F.lit("/pdf/"), paper_id, F.lit(".pdf")))
        .alias("pdf_url"))


def document_elements(content: Column | str) -> Column:
    """``document.elements`` of parsed-document JSON; null for text that is not JSON."""
    c = F.col(content) if isinstance(content, str) else content
    return F.try_variant_get(F.try_parse_json(c), "$.document.elements",
                             "array<struct<type: string, content: string>>")
