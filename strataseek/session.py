"""Session settings, the shared work folder and size checks used before a broadcast."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A side is broadcast only when its measured size stays below this many bytes.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024

_local_work_dirs: dict[str, str] = {}
_shipped: set[str] = set()


def build_session(app_name: str, cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g") -> SparkSession:
    """A local session with the settings the operators expect (UTC, AQE, Arrow)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Needed for the few operators that run Python in tasks when the package is not
    installed on the cluster.
    """
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        here = os.path.dirname(os.path.abspath(__file__))
        target = os.path.join(tempfile.mkdtemp(prefix="strataseek-package-"), "strataseek")
        spark.sparkContext.addPyFile(shutil.make_archive(
            target, "zip", os.path.dirname(here), os.path.basename(here)))
        _shipped.add(app)


def has_work_folder(spark: SparkSession) -> bool:
    """Whether a shared folder is named, or the session is a local one."""
    return bool(_named_folder(spark)) or spark.sparkContext.master.startswith("local")


def _named_folder(spark: SparkSession) -> str | None:
    conf = spark.sparkContext.getConf()
    return spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)


def _shared_folder(spark: SparkSession) -> str:
    named = _named_folder(spark)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_work_dirs:
        _local_work_dirs[app] = tempfile.mkdtemp(prefix="strataseek-")
    return _local_work_dirs[app]


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder named by ``spark.checkpoint.dir``."""
    return f"{_shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Iterative jobs and results that several queries share use this in place of
    a cache, so a lost executor costs no recomputation.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def together(*jobs: Callable):
    """Results of independent Spark jobs that run at the same time."""
    if len(jobs) == 1:
        return [jobs[0]()]
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


def spread_rows(df: DataFrame, key: str) -> DataFrame:
    """Hash a table that Spark reads in fewer splits than cores over all cores.

    For CPU-heavy steps on small inputs; a table with more splits than cores, so any
    large one, is left as it is and not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() <= cores else df


def held_locally(df: DataFrame, max_rows: int) -> DataFrame | None:
    """The rows of ``df`` as a local table, or None when there are more than ``max_rows``.

    Planning a bounded query batch several times then needs no job for its rows.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return None
    return df.sparkSession.createDataFrame(rows, df.schema)


def measured_bytes(df: DataFrame, row_bytes: Column) -> int:
    """Total of ``row_bytes`` over the rows, computed on the cluster."""
    return int(df.agg(F.coalesce(F.sum(row_bytes), F.lit(0))).first()[0])


def fits_broadcast(df: DataFrame, row_bytes: Column,
                   limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    return measured_bytes(df, row_bytes) <= limit
