"""Sinks (A10, A11): labelled report datasets and the partitioned result table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _flat_text(df: DataFrame) -> DataFrame:
    """Arrays, structs and maps as JSON text (CSV holds only flat values)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            c = F.to_json(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def write_report(frames: Mapping[str, DataFrame], path: str, fmt: str = "parquet", mode: str = "overwrite") -> list[str]:
    """One dataset per label under ``path`` (the workbook-with-sheets of the reference, as files)."""
    written = []
    for label, df in frames.items():
        out = f"{path.rstrip('/')}/{label}"
        (_flat_text(df) if fmt == "csv" else df).write.mode(mode).format(fmt).option("header", "true").save(out)
        written.append(out)
    return written


def write_results(results: DataFrame, path: str, mode: str = "append") -> None:
    """Append suite result rows, partitioned by database and table for cheap per-table reads."""
    results.write.mode(mode).partitionBy("database_name", "table_name").parquet(path)


#: Written beside a table's results when its checks are complete (the writer's own marker says only that the files are).
DONE = "_COMPLETE"


def _table_path(path: str, pairing: str, database: str, table: str) -> str:
    return f"{path.rstrip('/')}/pairing={quote(pairing, safe='')}/database_name={quote(database, safe='')}/table_name={quote(table, safe='')}"


def _file(spark: SparkSession, path: str):
    """The Hadoop file system of a path, so that any store Spark reads will do, and the path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def finished(spark: SparkSession, path: str, pairing: str, database: str, table: str) -> bool:
    fs, at = _file(spark, f"{_table_path(path, pairing, database, table)}/{DONE}")
    return fs.exists(at)


def write_scope(rows: DataFrame, path: str, pairing: str, database: str, table: str, complete: bool) -> None:
    """The results of one table and layer hop, replacing what an earlier unfinished run left; marked when complete."""
    at = _table_path(path, pairing, database, table)
    rows.drop("database_name", "table_name").write.mode("overwrite").parquet(at)
    if complete:
        fs, marker = _file(rows.sparkSession, f"{at}/{DONE}")
        fs.create(marker, True).close()


def read_scope(spark: SparkSession, path: str, items: Iterable[tuple[str, str, str]]) -> DataFrame:
    """The kept results of the named (pairing, database, table), with those as columns."""
    found = spark.read.option("basePath", path).schema(
        "check string, column_name string, metric string, source_value string, target_value string, passed boolean, status string, detail string, "
        "pairing string, database_name string, table_name string").parquet(*[_table_path(path, *i) for i in items])
    return found.select("pairing", "database_name", "table_name", *[c for c in found.columns if c not in ("pairing", "database_name", "table_name")])
