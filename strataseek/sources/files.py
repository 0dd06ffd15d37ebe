"""Landed files: binary scan, directory inventory, whole-file text.

Files are listed by tasks, a folder at a time and one level of folders after the other, and the list is a
table: the driver holds neither names nor sizes, however many files there are. Spark's own readers, which list
on the driver, are used for what the tasks cannot list: a path with wildcards, a single file, a store that
Arrow does not know, and a session without a shared folder. Both give the same rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataseek.session import cut_lineage, has_work_folder

# Read tasks for each core, and splits of a task at most, when there are many small files.
TASKS_A_CORE, TASK_SPLITS = 8, 16
# Folders that one task lists, and files and bytes that one task reads, on average.
TASK_FOLDERS, TASK_FILES, TASK_BYTES = 8, 10_000, 128 << 20
# Rows of a batch of the list, and bytes of file content that a task holds before it hands them on.
_LIST_ROWS, _HELD_BYTES = 10_000, 8 << 20
# Whole-text files with these endings are decompressed by Spark's reader.
_CODECS = (".gz", ".bz2", ".deflate", ".snappy", ".lz4", ".zst")
_LISTED = "place string, path string, uri string, modificationTime timestamp, length long, folder boolean"


def few_tasks(files: DataFrame) -> DataFrame:
    """Many small files in fewer tasks: Spark counts megabytes for opening a file, so it deals
    small ones a few to a task. Nothing is shuffled."""
    splits = files.rdd.getNumPartitions()
    least = TASKS_A_CORE * files.sparkSession.sparkContext.defaultParallelism
    return files.coalesce(max(least, -(-splits // TASK_SPLITS))) if splits > least else files


def _uri_part(name: str) -> str:
    """The name as Java writes it in a URI path."""
    def plain(c: str) -> bool:
        return re.match(r"[A-Za-z0-9\-_.!~*'():@&=+$,;]", c) is not None if c < "\x80" \
            else unicodedata.category(c) not in ("Cc", "Zs", "Zl", "Zp")

    return "".join(c if plain(c) else "".join(f"%{b:02X}" for b in c.encode()) for c in name)


def _hidden(name: str, folder: bool) -> bool:
    """Names that Spark passes over."""
    if folder and name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _list_folders(uri: str):
    """The entries of each folder, without hidden and empty ones; deeper folders are entries."""
    def run(batches):
        system, _ = pa.fs.FileSystem.from_uri(uri)
        schema = pa.schema([("place", pa.string()), ("path", pa.string()), ("uri", pa.string()),
                            ("modificationTime", pa.timestamp("us", "UTC")), ("length", pa.int64()), ("folder", pa.bool_())])
        for batch in batches:
            for place, path, at in zip(*(batch.column(c).to_pylist() for c in ("place", "path", "uri"))):
                found = system.get_file_info(pa.fs.FileSelector(place))
                for start in range(0, len(found), _LIST_ROWS):
                    rows = []
                    for info in found[start:start + _LIST_ROWS]:
                        folder, name = info.type == pa.fs.FileType.Directory, info.base_name
                        if not _hidden(name, folder) and (folder or info.size):
                            stamp = None if info.mtime_ns is None else info.mtime_ns // 1_000_000 * 1000
                            rows.append((f"{place.rstrip('/')}/{name}", f"{path.rstrip('/')}/{name}",
                                         f"{at.rstrip('/')}/{_uri_part(name)}", stamp, info.size or 0, folder))
                    columns = list(zip(*rows)) or [[]] * len(schema)
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def _root(spark: SparkSession, path: str) -> tuple[str, str, str] | None:
    """Place, path and URI of a folder that tasks can list."""
    if set("{}[]*?\\") & set(path) or not has_work_folder(spark):
        return None
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(hadoop) or not store.getFileStatus(hadoop).isDirectory():
        return None
    whole = store.makeQualified(hadoop)
    try:
        place = pa.fs.FileSystem.from_uri(whole.toUri().toString())[1]
    except (pa.ArrowException, OSError, ValueError):
        return None
    # Spark shows the URI of a path that was read from text once more
    return place, whole.toString(), spark._jvm.org.apache.hadoop.fs.Path(whole.toString()).toUri().toString()


def _name_matches(spark: SparkSession, glob: str) -> Column:
    """Whether the file name matches, by Hadoop's rules."""
    pattern = spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
    return F.element_at(F.split("path", "/"), -1).rlike(rf"(?s)\A(?:{pattern})\z")


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame | None:
    """``place, path, uri, modificationTime, length`` of the files below a folder whose names match ``glob``.

    None if the tasks cannot list it.
    """
    root = _root(spark, path)
    if root is None:
        return None
    folders, count, levels = spark.createDataFrame([root], "place string, path string, uri string"), 1, []
    while count:
        tasks = min(count, max(spark.sparkContext.defaultParallelism, -(-count // TASK_FOLDERS)))
        level = cut_lineage(folders.repartition(tasks, "place").mapInArrow(_list_folders(root[2]), _LISTED), "file-list")
        folders = level.filter("folder").select("place", "path", "uri")
        count = folders.count()
        levels.append(level)
    return reduce(DataFrame.unionByName, levels).filter(~F.col("folder") & _name_matches(spark, glob)).drop("folder")


def _with_content(files: DataFrame, root: str) -> DataFrame:
    """The bytes of each file as ``content``, read only where that column is used."""
    @F.arrow_udf("binary")
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        system, _ = pa.fs.FileSystem.from_uri(root)
        for places in batches:
            held, size = [], 0
            for place in places.to_pylist():
                with system.open_input_stream(place) as stream:
                    held.append(stream.read())
                size += len(held[-1])
                if size >= _HELD_BYTES:
                    yield pa.array(held, pa.binary())
                    held, size = [], 0
            if held:
                yield pa.array(held, pa.binary())

    count, size = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    cores = files.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, -(-size // TASK_BYTES), -(-count // TASK_FILES), min(count, TASKS_A_CORE * cores))
    return files.repartition(tasks, "place").withColumn("content", read("place"))


def read_binary_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``path, modificationTime, length, content`` of the files matching ``glob``."""
    listed = list_files(spark, path, glob)
    if listed is None:
        return few_tasks(spark.read.format("binaryFile").option("pathGlobFilter", glob)
                         .option("recursiveFileLookup", True).load(path))
    return _with_content(listed, _root(spark, path)[2]).select("path", "modificationTime", "length", "content")


def file_inventory(spark: SparkSession, path: str,
                   suffixes: tuple[str, ...] = (".txt",)) -> DataFrame:
    """Name, path and size of the files that end in one of ``suffixes``.

    Files are listed and not opened.
    """
    wanted = F.lit(False)
    for suffix in suffixes:
        wanted = wanted | F.col("path").endswith(suffix)
    listed = list_files(spark, path)
    return ((read_binary_files(spark, path) if listed is None else listed).filter(wanted)
            .select(F.element_at(F.split("path", "/"), -1).alias("file_name"),
                    F.col("path").alias("file_path"), F.col("length").alias("size_bytes"),
                    F.round(F.col("length") / 1048576, 2).alias("size_mb")))


def read_whole_text(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """``file_name, file_path, raw_content`` with one row per file."""
    listed = list_files(spark, path, glob)
    if listed is None or _compressed(listed):
        return few_tasks(spark.read.option("pathGlobFilter", glob)
                         .option("recursiveFileLookup", True).text(path, wholetext=True)
                         .select(F.col("_metadata.file_name").alias("file_name"),
                                 F.col("_metadata.file_path").alias("file_path"),
                                 F.col("value").alias("raw_content")))
    uri = F.coalesce("uri", F.lit(""))  # never null, and the schema says so
    return _with_content(listed, _root(spark, path)[2]).select(
        F.coalesce(F.element_at(F.split(uri, "/"), -1), F.lit("")).alias("file_name"), uri.alias("file_path"),
        F.col("content").cast("string").alias("raw_content"))


def _compressed(files: DataFrame) -> bool:
    return not files.filter(reduce(Column.__or__, (F.col("path").endswith(end) for end in _CODECS))).isEmpty()
