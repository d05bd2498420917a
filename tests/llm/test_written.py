"""A written step leaves its rows and no shuffle files."""

import time

from pyspark.sql import functions as F

from paritas.llm.common import SHUFFLE_CLEANUP, written


def _shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in files.split("\n") if "/shuffle_" in f}


def test_shuffle_files_go_with_the_write(spark):
    grouped = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).agg(F.sum("id").alias("s"))
    before = _shuffle_files(spark)
    rows = written(grouped)
    until = time.time() + 10  # executors remove them in the background
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert rows.count() == 100 and rows.agg(F.sum("s")).first()[0] == 49_995_000


def test_the_sessions_own_setting_stays(spark):
    written(spark.range(3))
    assert spark.conf.get(SHUFFLE_CLEANUP, None) is None
    spark.conf.set(SHUFFLE_CLEANUP, "false")
    try:
        written(spark.range(3))
        assert spark.conf.get(SHUFFLE_CLEANUP) == "false"
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP)
