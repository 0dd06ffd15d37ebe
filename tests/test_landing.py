"""Queries over tables that are folders of part files, and over many landed files."""

import os

from strataseek.sources import files
from tests.helpers import plan_of
from workload import landing, queries as q

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, path, rows):
    (spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCUMENTS)
     .repartition(3).write.parquet(f"{path}/documents.parquet"))
    return str(path)


def test_stream_reads_a_folder_of_part_files(spark, tmp_path):
    sf = documents(spark, tmp_path, [(i, f"Sentence {i} about rivers. " * 8) for i in range(20)])
    found = q.all_queries()["stream_index_upsert"](spark, sf)
    assert {r.file_name for r in found.select("file_name").collect()} == {f"doc_{i}.txt" for i in range(20)}


def test_landed_files_share_folders_and_are_read_in_few_tasks(spark, tmp_path):
    rows = [(i, f"text {i}") for i in range(300)] + [(7, "again"), (8, None), (None, "no id")]
    sf = documents(spark, tmp_path, rows)
    path = landing.paper_files(spark, sf)
    assert len(os.listdir(path)) == 1  # not a folder a file
    found = q.all_queries()["src_wholetext"](spark, sf)
    assert found.rdd.getNumPartitions() <= files.TASKS_A_CORE * 8
    texts = {r.file_name: r.raw_content for r in found.collect()}
    assert len(texts) == 301 and texts["doc_9.txt"] == "text 9" and texts["__HIVE_DEFAULT_PARTITION__"] == "no id"
    assert sorted(texts["doc_7.txt"].split("\n")) == ["again", "text 7"]
    sizes = {r.file_name: r.size_bytes for r in q.all_queries()["src_file_inventory"](spark, sf).collect()}
    assert sizes["doc_9.txt"] == 7 and sizes["doc_8.txt"] == 8
    assert q.all_queries()["src_binary_files"](spark, sf).count() == 301
    assert "content" not in plan_of(files.file_inventory(spark, path)).split("ReadSchema")[-1]
