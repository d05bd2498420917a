"""Shared helpers: tables of a directory, written steps, the worker's import path."""

from __future__ import annotations

import ctypes
import ctypes.util
import os
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from paritas.session import ensure_checkpoint_dir


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new path below the cluster's shared ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame, partition_by: tuple[str, ...] = (), **options: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: the lineage ends there,
    so a lost executor costs no recomputation of what was written, and the shuffle files that
    led to it are removed with the write instead of staying until the driver collects garbage."""
    spark = df.sparkSession
    path = scratch(spark)
    writer = df.write.options(**options)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def python_path(spark: SparkSession) -> None:
    """Before a Python step: batches of 250 rows unless the session says otherwise (rows are whole
    texts, some very long, and two tasks share an executor), and let Python workers on this machine import the package when it was found through
    ``sys.path`` alone. On a cluster the package comes by ``--py-files`` or the image."""
    if spark.conf.get(BATCH_ROWS) == "10000":  # Spark's default
        spark.conf.set(BATCH_ROWS, "250")
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if root not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, have) if x)


def free_name(name: str, columns) -> str:
    """``name``, longer by underscores until no column has it (Spark's names ignore case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def trim() -> None:
    """Give memory that this process freed back to the system."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.util.find_library("c")
    if libc and hasattr(c := ctypes.CDLL(libc), "malloc_trim"):
        c.malloc_trim(0)


def tidy(work: Callable) -> Callable:
    """``work`` for ``mapInArrow``, giving the memory it freed back to the system when its task ends: workers
    live on for later stages, and what they keep would add up beside the JVM."""
    def run(batches):
        try:
            yield from work(batches)
        finally:
            trim()

    return run
