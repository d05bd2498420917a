"""Token-id output: Parquet files of whole documents' token ids, for selective reads.

``write_tokens`` range-partitions documents by ``doc_id`` (ties by a hash of the text, so a
repeated id is split too), sorts inside each partition, encodes whole texts and writes
``doc_id, part, local_start, n_tokens, ids`` with Spark's Parquet writer:

* ``ids`` is a list column, dictionary-encoded (``encoding="dictionary"``) or with
  ``DELTA_BINARY_PACKED`` pages (``"delta"``);
* ``row_group_mb`` and ``page_kb`` fix row groups and pages; the writer adds column and
  offset indexes, so a filter on the sorted ``doc_id`` reads only the pages it needs;
* metadata reads (``read_metadata``) touch no page of ``ids``.

``part`` is the number of the file in ``doc_id`` order and ``local_start`` the ids before a
document in its file; ``read_metadata`` turns both into ``start``, the ids of all documents
before it, from one total per file.

Defined cases: a null text is an empty text (only the end id); a null ``doc_id`` sorts
first; rows that repeat a ``doc_id`` stay separate documents, ordered by a hash of their
text; an empty table gives no rows; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paritas.llm.common import python_path, tidy
from paritas.llm.tokens import encoder, gathered, in_slices

FILE_SCHEMA = "doc_id long, part int, local_start long, n_tokens int, ids array<int>"


def _encode(path: str, end_id: int):
    def run(batches):
        enc, part, at = encoder(path), TaskContext.get().partitionId(), 0
        for b in gathered(batches):
            ids = enc.encode_array(b.column("text"), end_id)
            ends = ids.offsets.to_numpy().astype(np.int64)[1:]
            n = np.diff(ends, prepend=0)
            yield from in_slices([pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.full(len(n), part, np.int32)), pa.array(at + ends - n), pa.array(n.astype(np.int32)), ids],
                ["doc_id", "part", "local_start", "n_tokens", "ids"])])
            at += int(n.sum())

    return tidy(run)


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int = 0, encoding: str = "dictionary",
                 row_group_mb: int = 32, page_kb: int = 256) -> None:
    """Encode ``docs(doc_id, text)`` and write the files in ascending ``doc_id`` order."""
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"encoding is 'dictionary' or 'delta', not {encoding!r}")
    python_path(docs.sparkSession)
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
               .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text"))
    (ordered.mapInArrow(_encode(vocabulary, end_id), FILE_SCHEMA).write
     .option("compression", "snappy").option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.enable.dictionary", str(encoding == "dictionary").lower())
     .option("parquet.block.size", row_group_mb << 20).option("parquet.page.size", page_kb << 10)
     .parquet(path))


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Documents with ids ``first`` to ``last``: row groups and pages outside are not read."""
    df = spark.read.schema(FILE_SCHEMA).parquet(path)
    if first is not None:
        df = df.filter(F.col("doc_id") >= first)
    return df if last is None else df.filter(F.col("doc_id") <= last)


def with_start(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """``rows`` of the files with ``start``, from one total per file."""
    totals = spark.read.schema(FILE_SCHEMA).parquet(path).groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return rows.join(base, "part").withColumn("start", F.col("base") + F.col("local_start")).drop("base")


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens`` of every document; no page of ``ids`` is read."""
    rows = spark.read.schema(FILE_SCHEMA).parquet(path).select("doc_id", "part", "local_start", "n_tokens")
    return with_start(spark, path, rows).select("doc_id", "start", F.col("n_tokens").cast("long").alias("n_tokens"))


def _crc(batches):
    for b in batches:
        ids = b.column("ids")
        flat, at = ids.flatten().to_numpy(), ids.offsets.to_numpy()
        at = at - at[0]
        crc = [zlib.crc32(flat[i:j].tobytes()) for i, j in zip(at[:-1], at[1:])]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("part"), b.column("local_start"), b.column("n_tokens"), pa.array(crc, pa.int64())],
            ["doc_id", "part", "local_start", "n_tokens", "ids_crc32"])


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files."""
    rows = read_tokens(spark, path).mapInArrow(_crc, "doc_id long, part int, local_start long, n_tokens int, ids_crc32 long")
    return with_start(spark, path, rows).select("doc_id", "start", F.col("n_tokens").cast("long").alias("n_tokens"), "ids_crc32")
